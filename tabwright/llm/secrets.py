"""Secrets: three fixed kinds, and strings that look random to two character Markov models.

DataFrame operations only. ``train`` counts character pairs in labelled samples,
random strings and ordinary identifiers, and keeps for each pair the difference
of its log-probabilities under the two first-order models. A candidate is a run
of identifier characters; its log-likelihood ratio is the sum over its pairs.
It is a secret when the mean per pair reaches ``threshold``. The ordinary samples
may hold the unlabelled secrets that are looked for, so the models are fitted
again without ordinary samples that look random, and the threshold never lies
above the low tail of the random samples.

Positions are code points, the end exclusive. They come from the texts between
the matches of a pattern: each match starts where the matches and gaps before it
end, so nothing but built-in functions is needed.

Decisions: a missing text is empty; matches of one kind do not overlap, those of
different kinds may; a candidate that overlaps a span of a fixed kind adds
nothing; letters of the assignment keywords match in either ASCII case.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import text_of
from tabwright.session import written

# Fixed by the contract of the base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

IDENTIFIER = "A-Za-z0-9+/_.=-"
LEAST = 20  # characters of a candidate
CANDIDATE = f"(?<![{IDENTIFIER}])[{IDENTIFIER}]{{{LEAST},}}"
WORD = f"(?<![{IDENTIFIER}])[{IDENTIFIER}]{{8,}}"
SAMPLE_ROWS = 20_000  # rows that the labelled samples come from, about
FITS = 4  # of the models, each but the first without the ordinary samples that the one before finds random
CODES = 128
REDACTED = "<SECRET>"


@dataclass
class MarkovModels:
    """Log-likelihood ratio of each pair of ASCII characters, and the mean from which a string is a secret."""

    ratios: list[float]
    threshold: float

    def mean_ratio(self, string: Column) -> Column:
        """Mean log-likelihood ratio per pair of a string of identifier characters."""
        table = F.split(F.lit(",".join(f"{x:.6g}" for x in self.ratios)), ",").cast("array<double>")
        pairs = F.length(string) - 1
        total = F.aggregate(
            F.sequence(F.lit(1), F.greatest(pairs, F.lit(1))),
            F.lit(0.0),
            lambda acc, i: acc
            + F.element_at(
                table, F.ascii(F.substring(string, i, F.lit(1))) * CODES + F.ascii(F.substring(string, i + 1, F.lit(1))) + 1
            ),
        )
        return total / pairs


def labelled_samples(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Samples (string, random) from about ``rows`` rows, drawn by a hash.

    Ordinary identifiers are the strings of the texts once the fixed kinds are
    taken out. Random ones are the values of those kinds, and digests of the
    rows' keys and texts spelled in hexadecimal, base64 and capitals.
    """
    total = docs.count()
    draw = F.pmod(F.xxhash64(F.lit("secret sample"), F.col(key), F.octet_length(text_of(text))), F.lit(1 << 30))
    drawn = docs.filter(draw < int(min(1.0, rows / max(total, 1)) * (1 << 30))).select(
        F.col(key).cast("string").alias("k"), text_of(text).alias("t")
    )
    plain = reduce(lambda t, p: F.regexp_replace(t, p, " "), (ASSIGN, ACCESS, HEX), F.col("t"))
    ordinary = drawn.select(F.explode(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("string"))
    digest = F.sha2(F.concat_ws(":", "k", "t"), 256)
    spelled = F.regexp_replace(F.base64(F.unhex(digest)), "=+$", "")
    drawn_random = F.array(
        F.substring(digest, 1, 40), spelled, F.translate(F.upper(spelled), "+/", "XY"), F.translate(spelled, "+/", "-_")
    )
    known = F.concat(
        F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(1)),
        F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("t", F.lit(HEX), F.lit(0)),
    )
    random = drawn.select(F.explode(F.concat(drawn_random, F.filter(known, lambda s: F.length(s) >= LEAST))).alias("string"))
    return ordinary.withColumn("random", F.lit(False)).unionByName(random.withColumn("random", F.lit(True)))


def train(samples: DataFrame) -> MarkovModels:
    """First-order models of both labels, fitted ``FITS`` times, and the threshold between them.

    Ordinary samples as long as a candidate that are likelier random are left out
    of the next fit.
    """
    samples = written(samples.groupBy("random", "string").agg(F.count(F.lit(1)).alias("n")), "secret-samples")
    models = _fit(samples)
    for _ in range(FITS - 1):
        ordinary = F.col("random") | (F.length("string") < LEAST)
        kept = F.when(ordinary, True).otherwise(models.mean_ratio(F.col("string")) < 0)
        models = _fit(samples.filter(kept))
    return models


def _fit(samples: DataFrame) -> MarkovModels:
    """First-order models of both labels, add-half smoothed over the characters seen, and the threshold between them.

    The driver sees at most one row per label and pair of ASCII characters.
    """
    pairs = (
        samples.select(
            "random", "n", "string", F.explode(F.sequence(F.lit(1), F.length("string") - 1)).alias("i")
        )
        .filter(F.length("string") > 1)
        .groupBy("random", F.substring("string", F.col("i"), F.lit(2)).alias("pair"))
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = {label: [[0.0] * CODES for _ in range(CODES)] for label in (False, True)}
    for r in pairs:
        a, b = map(ord, r["pair"])
        counts[r["random"]][a][b] += r["n"]
    used = [c for c in range(CODES) if chr(c).isalnum() or chr(c) in "+/_.=-"]
    ratios = [0.0] * (CODES * CODES)
    for a in used:
        sums = {label: sum(counts[label][a]) + 0.5 * len(used) for label in counts}
        for b in used:
            log = {label: math.log((counts[label][a][b] + 0.5) / sums[label]) for label in counts}
            ratios[a * CODES + b] = log[True] - log[False]
    models = MarkovModels(ratios, 0.0)
    scored = samples.filter(F.length("string") >= LEAST).select(
        "random", "n", models.mean_ratio(F.col("string")).alias("score")
    )
    tails = {
        r["random"]: (r["low"], r["high"])
        for r in scored.groupBy("random")
        .agg(
            F.percentile_approx("score", 0.001, 10_000).alias("low"),
            F.percentile_approx("score", 0.9999, 10_000).alias("high"),
        )
        .collect()
    }
    low, high = tails.get(True, (0.0, 0.0))[0], tails.get(False, (0.0, 0.0))[1]
    models.threshold = max(min((low + high) / 2, low), 0.0) or 0.5
    return models


def spans_of(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Array of (start, end, kind) of a pattern's matches; those with a shorter group are dropped."""
    empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length).alias("inner"),
    )
    walked = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["size"]).cast("int").alias("at"),
            F.when(
                p["inner"] >= least,
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + p["gap"]).cast("int").alias("start"),
                            (acc["at"] + p["gap"] + p["size"]).cast("int").alias("end"),
                            F.lit(kind).alias("kind"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )["spans"]
    return F.when(F.regexp_like(text, F.lit(pattern)), walked).otherwise(empty)


def find(docs: DataFrame, models: MarkovModels, columns: list[str], text: str = "text") -> DataFrame:
    """The named columns of every row with ``_llm_text``, ``_llm_base`` and ``_llm_spans``, each span (start, end, kind)."""
    t = F.col("_llm_text")
    base = F.array_sort(
        F.concat(spans_of(t, ASSIGN, 0, 1, ASSIGN_LEAST), spans_of(t, ACCESS, 1), spans_of(t, HEX, 2))
    )
    rows = docs.select(*columns, text_of(text).alias("_llm_text"))
    rows = rows.withColumn("_llm_base", _sorted(base)).withColumn("_llm_runs", spans_of(t, CANDIDATE, 3))
    added = F.filter(
        F.col("_llm_runs"),
        lambda s: ~F.exists(F.col("_llm_base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        & (models.mean_ratio(F.substring(t, s["start"] + 1, s["end"] - s["start"])) >= models.threshold),
    )
    return rows.withColumn("_llm_spans", _sorted(F.concat("_llm_base", added))).drop("_llm_runs")


def _sorted(spans: Column) -> Column:
    """Spans by start, then kind."""
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.transform(keyed, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def spelled(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, models: MarkovModels, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All rows, with ``REDACTED`` in place of every span and ``length`` counted anew; rows without a span are unchanged."""
    found = find(docs, models, docs.columns, text)
    t = F.col("_llm_text")
    cut = F.aggregate(
        F.col("_llm_spans"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])
            .otherwise(
                F.concat(
                    acc["out"],
                    F.array(F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit(REDACTED)),
                )
            )
            .alias("out"),
        ),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(t, acc["at"] + 1, F.length(t))),
    )
    any_span = F.size("_llm_spans") > 0
    changed = {text: F.when(any_span, cut).otherwise(F.col(text))}
    out = found.withColumn("_llm_cut", changed[text])
    if length is not None and length in docs.columns:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(any_span, F.length("_llm_cut").cast(kind)).otherwise(F.col(length)))
    return out.withColumn(text, F.col("_llm_cut")).select(*docs.columns)
