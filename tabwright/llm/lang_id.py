"""Language identification with interpolated Kneser-Ney character models.

One model per language over normalised characters (lower case, each run of
other characters than letters is one space). Probabilities are interpolated
Kneser-Ney: discounted counts of four-character grams at the top, continuation
counts below, a uniform share of the alphabet at the bottom. For every gram seen
in any language the finished log-probability of each language stands in one row,
and rows are found by a 64-bit hash in a sorted array. A gram that is not there
takes the row of its shorter gram plus the logarithm of its context's free mass.

A text gets the language with the lowest cross-entropy per character. ``score``
is the softmax of the cross-entropies, with a temperature fitted on documents
kept out of the models. A text is ``rejected`` when its cross-entropy lies
further above the mean of its language than any of those documents did, by a
margin; short texts are given more room.

The models learn from a bounded sample: about ``SAMPLE_DOCS`` documents of each
language, taken whole by a hash of their key, so their size does not follow the
table and they may be sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices, text_of

SAMPLE_DOCS = 1_500  # learning documents of each language, about
CALIBRATION_SHARE = 4  # one in so many of them calibrates
ORDER = 4
SLICE_BYTES = 1 << 18
FIT_CHARS = 1 << 20  # characters counted at once while learning
UNKNOWN = "und"
ROOM = 1.5  # times the largest deviation of the calibration documents
SURE_CHARS = 200  # characters beyond which a text gets no more room


def _letter_table():
    """For each code point below 2**16: its number if it is a letter, else 0; letters above share their low bits."""
    import numpy as np

    table = np.zeros(0x110000, np.uint16)
    letters = np.array([c for c in range(0x110000) if chr(c).isalpha()], np.int64)
    table[letters] = np.maximum(letters & 0xFFFF, 1)
    return table


_TABLES: dict = {}


def coded(texts: list[str]):
    """Characters of all texts, each text led by a space, and where each text starts."""
    import numpy as np

    if "letters" not in _TABLES:
        _TABLES["letters"] = _letter_table()
    joined = " ".join(["", *(t.lower() for t in texts)])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t.lower()) + 1 for t in texts], np.int64)
    starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
    codes = _TABLES["letters"][points]
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0  # the first of a run of others
    keep[starts] = True
    place = np.cumsum(keep) - keep
    return codes[keep], place[starts]


def gram_keys(codes, starts, n: int):
    """64-bit keys of the n characters that end at each position; those before a text's start are spaces."""
    import numpy as np

    since = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
    key = np.full(len(codes), n, np.uint64)
    for back in range(n - 1, -1, -1):
        c = np.zeros(len(codes), np.uint64)
        c[back:] = codes[: max(len(codes) - back, 0)]
        c[since < back] = 0
        key = (key ^ c) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key


@dataclass
class Models:
    """Sorted gram hashes with a row of log-probabilities, and context hashes with a row of log free mass."""

    languages: list[str]
    grams: list
    probs: list
    contexts: list
    masses: list
    floor: float
    temperature: float = 1.0
    mean: object = None
    limit: object = None

    def log_probs(self, codes, starts):
        """Natural log-probability of each character under each language."""
        import numpy as np

        size = (len(codes), len(self.languages))
        out = np.zeros(size, np.float32)
        open_ = np.arange(len(codes))
        for n in range(ORDER, 0, -1):
            row, hit = found(self.grams[n - 1], gram_keys(codes, starts, n)[open_])
            out[open_[hit]] += self.probs[n - 1][row[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return out
            row, hit = found(self.contexts[n - 1], context_keys(codes, starts, n)[open_])
            out[open_[hit]] += self.masses[n - 1][row[hit]]
        out[open_] += self.floor
        return out

    def entropies(self, texts: list[str]):
        """Cross-entropy per character of each text under each language, and its number of letters and spaces."""
        import numpy as np

        codes, starts = coded(texts)
        sums = np.add.reduceat(self.log_probs(codes, starts).astype(np.float64), starts, axis=0)
        n = np.diff(np.r_[starts, len(codes)])
        letters = np.add.reduceat((codes > 0).astype(np.int64), starts)
        return -sums / n[:, None], n, letters

    def predict(self, texts: list[str]):
        """Language number (-1 without a letter), score in 0..1, and whether it is rejected."""
        import numpy as np

        ce, n, letters = self.entropies(texts)
        best = ce.argmin(axis=1)
        gap = (ce - ce.min(axis=1, keepdims=True)) * np.minimum(n, SURE_CHARS)[:, None]
        score = 1.0 / np.exp(-gap / self.temperature).sum(axis=1)
        off = (ce.min(axis=1) - self.mean[best]) * np.sqrt(np.minimum(n, SURE_CHARS))
        rejected = (off > self.limit[best]) | (letters == 0)
        best[letters == 0], score[letters == 0] = -1, 0.0
        return best, score, rejected


def context_keys(codes, starts, n: int):
    """Keys of the n-1 characters before each position."""
    import numpy as np

    since = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
    key = np.full(len(codes), n, np.uint64)
    for back in range(n - 1, 0, -1):
        c = np.zeros(len(codes), np.uint64)
        c[back:] = codes[: max(len(codes) - back, 0)]
        c[since < back] = 0
        key = (key ^ c) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key


def found(sorted_keys, keys):
    """Row of each key in a sorted array, and whether it is there."""
    import numpy as np

    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    row = np.searchsorted(sorted_keys, keys)
    row[row == len(sorted_keys)] = 0
    return row, sorted_keys[row] == keys


def distinct_grams(texts: list[str]):
    """For each distinct gram of the full order its shorter endings, their contexts, and how often it occurs.

    Texts are taken a few at a time, so only distinct grams are held.
    """
    import numpy as np

    parts, start = [], 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= FIT_CHARS):
            size += len(texts[end])
            end += 1
        codes, starts = coded(texts[start:end])
        columns = [gram_keys(codes, starts, n) for n in range(1, ORDER + 1)]
        _, first, count = np.unique(columns[-1], return_index=True, return_counts=True)
        columns = [c[first] for c in columns]
        columns += [context_keys(codes, starts, n)[first] for n in range(1, ORDER + 1)]
        parts.append((columns, count))
        start = end
    columns = [np.concatenate([c[i] for c, _ in parts]) for i in range(2 * ORDER)]
    _, first, inverse = np.unique(columns[ORDER - 1], return_index=True, return_inverse=True)
    count = np.bincount(inverse, weights=np.concatenate([n for _, n in parts]))
    columns = [c[first] for c in columns]
    return columns[:ORDER], columns[ORDER:], count


def fit_models(texts: dict[str, list[str]]) -> Models:
    """Interpolated Kneser-Ney models, one per language, finished for all grams that any of them has seen."""
    import numpy as np

    languages = sorted(texts)
    seen: list[list] = [[] for _ in range(ORDER)]
    for language in languages:
        grams_of, contexts_of, held = distinct_grams(texts[language])
        at = np.arange(len(held))
        for n in range(ORDER, 0, -1):
            gram = grams_of[n - 1][at]
            if n == ORDER:
                first, count = at, held
            else:
                # continuation count: distinct longer grams that end in this one
                gram, first, count = np.unique(gram, return_index=True, return_counts=True)
            at = at[first]
            shorter = grams_of[n - 2][at] if n > 1 else np.zeros(len(at), np.uint64)
            seen[n - 1].append((gram, contexts_of[n - 1][at], shorter, count.astype(np.float64)))
    alphabet = len(np.unique(np.concatenate([s[0] for s in seen[0]]))) if seen[0] else 1
    floor = float(-np.log(alphabet + 1))
    grams, probs, contexts, masses = [], [], [], []
    for n in range(1, ORDER + 1):
        every = np.unique(np.concatenate([s[0] for s in seen[n - 1]]))
        parents = np.zeros(len(every), np.uint64)
        context_of = np.zeros(len(every), np.uint64)
        for key, context, shorter, _ in seen[n - 1]:
            at = np.searchsorted(every, key)
            parents[at], context_of[at] = shorter, context
        all_contexts = np.unique(np.concatenate([s[1] for s in seen[n - 1]]))
        prob = np.zeros((len(every), len(languages)))
        mass = np.zeros((len(all_contexts), len(languages)))
        row_of = np.searchsorted(all_contexts, context_of)
        if n == 1:
            lower = np.full((len(every), len(languages)), np.exp(floor))
        else:
            row, hit = found(grams[n - 2], parents)
            lower = np.where(hit[:, None], np.exp(probs[n - 2][row]), np.exp(floor))
        for j, (key, context, _, count) in enumerate(seen[n - 1]):
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            at = np.searchsorted(all_contexts, context)
            total = np.bincount(at, weights=count, minlength=len(all_contexts))
            kinds = np.bincount(at, minlength=len(all_contexts))
            free = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            mass[:, j] = free
            prob[np.searchsorted(every, key), j] = (count - discount) / total[at]
            prob[:, j] += free[row_of] * lower[:, j]
        grams.append(every)
        probs.append(np.log(np.maximum(prob, 1e-30)).astype(np.float32))
        contexts.append(all_contexts)
        masses.append(np.log(np.maximum(mass, 1e-30)).astype(np.float32))
    return Models(languages, grams, probs, contexts, masses, floor)


def calibrate(models: Models, texts: dict[str, list[str]]) -> Models:
    """Fit the temperature of the score and the limits of rejection on texts the models have not learned."""
    import numpy as np

    size = len(models.languages)
    models.mean, models.limit = np.full(size, 3.0), np.full(size, np.inf)
    gaps, right = [], []
    for j, language in enumerate(models.languages):
        own = [t for t in texts.get(language, []) if any(c.isalpha() for c in t)]
        if not own:
            continue
        parts = [models.entropies(own[i : i + 50])[:2] for i in range(0, len(own), 50)]
        ce, n = (np.concatenate(x) for x in zip(*parts))
        models.mean[j] = np.median(ce[:, j])
        off = (ce[:, j] - models.mean[j]) * np.sqrt(np.minimum(n, SURE_CHARS))
        models.limit[j] = ROOM * max(off.max(), 1.0) + 1.0
        gaps.append((ce - ce.min(axis=1, keepdims=True)) * np.minimum(n, SURE_CHARS)[:, None])
        right.append(np.full(len(own), j))
    if gaps:
        gap, label = np.concatenate(gaps), np.concatenate(right)
        grid = np.geomspace(0.5, 64, 22)
        loss = [
            float(np.mean(gap[np.arange(len(label)), label] / t + np.log(np.exp(-gap / t).sum(axis=1)))) for t in grid
        ]
        models.temperature = float(grid[int(np.argmin(loss))])
    return models


def held_out(key: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept out of learning: crc32 of its key as text, modulo the folds."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))


def learn(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    learned: Column | None = None,
    sample_docs: int = SAMPLE_DOCS,
) -> Models | None:
    """Models from a bounded sample of the labelled rows; ``learned`` limits which rows may be learned from.

    None where no row has a language and a text.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    if learned is not None:
        known = known.filter(learned)
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key), F.octet_length(F.col(text))), F.lit(1 << 30))
    counts = known.groupBy(F.col(lang).cast("string").alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per language
    if not counts:
        return None
    chosen = F.lit(False)
    for r in counts:
        share = min(1.0, sample_docs / r["n"])
        chosen = chosen | ((F.col(lang).cast("string") == r["l"]) & (draw < int(share * (1 << 30))))
    rows = known.filter(chosen).select(
        F.col(lang).cast("string").alias("l"), F.col(text).alias("t"), (draw % CALIBRATION_SHARE == 0).alias("c")
    )
    fit: dict[str, list[str]] = {}
    check: dict[str, list[str]] = {}
    for batch in [rows.toArrow()]:  # about sample_docs texts of each language
        for l, t, c in zip(*(batch[name].to_pylist() for name in ("l", "t", "c"))):
            (check if c else fit).setdefault(l, []).append(t)
    for l, texts in check.items():
        fit.setdefault(l, texts)  # a language with a few rows learns from them all
    return calibrate(fit_models({l: sorted(t) for l, t in fit.items()}), check)


def _predict(handle):
    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        models = handle.value
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "_llm_text"):
                best, score, rejected = models.predict(part["_llm_text"].to_pylist())
                names = np.array([*models.languages, UNKNOWN], object)[best]
                rest = [c for c in part.schema.names if c != "_llm_text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in rest), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    names=[*rest, "_llm_lang", "_llm_score", "_llm_rejected"],
                )

    return kernel


def identify(docs: DataFrame, models: Models | None, columns: list[str], text: str = "text") -> DataFrame:
    """The named columns of every row with ``_llm_lang``, ``_llm_score``, ``_llm_rejected``.

    A missing text, or one without a letter, is ``und`` with score 0 and
    rejected; so is every text where there are no models.
    """
    if models is None:
        return docs.select(*columns).withColumns(
            {"_llm_lang": F.lit(UNKNOWN), "_llm_score": F.lit(0.0), "_llm_rejected": F.lit(True)}
        )
    rows = docs.select(*columns, text_of(text).alias("_llm_text"))
    handle = docs.sparkSession.sparkContext.broadcast(models)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_llm_text")
    schema = f"{kinds}, _llm_lang string, _llm_score double, _llm_rejected boolean"
    return rows.mapInArrow(_predict(handle), schema)


def accepted(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose language is recognised, with all their columns; all rows where none has a language to learn from."""
    models = learn(docs, key, text, lang)
    if models is None:
        return docs
    return identify(docs, models, docs.columns, text).filter(~F.col("_llm_rejected")).select(*docs.columns)
