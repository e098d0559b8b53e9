"""Quality rules over a text's own repeats, found with a suffix array over its words.

Words are runs of characters other than ASCII white space. The suffixes of a
text are sorted by prefix doubling, the longest common prefixes of neighbours
are read off the ranks of each doubling, and the intervals of equal prefixes
are walked for maximal repeats: sequences of words that occur twice or more
and cannot grow to either side without losing an occurrence. The spans of
those of ``LEAST`` words or more are united; the share of the words they cover,
the share of characters they cover and the longest of them decide.

Decisions: a missing text has no words and fails the base rules, as does any
text below ``MIN_WORDS``. Repeats may overlap themselves. A covered span counts
once, all its occurrences included. Rows with equal keys are judged each by
itself, missing keys too; other columns stay out of the result, so names
cannot clash. An empty table gives no rows. A text is held whole by one task,
with some 60 bytes a word beside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices, text_of

LEAST = 8  # words of a repeat that counts
MIN_WORDS = 20
BASE_PERCENT = 30  # repeated words of the base rule
MAX_COVERED = 30  # percent of the characters in words that repeats may cover
MAX_LONGEST = 50  # words of the longest repeat
SYMBOLS = "#*$%&|<>"
SLICE_BYTES = 1 << 20

WORD = re.compile(r"[^\x20\x09-\x0D]+")

RULE_COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_chars long, longest_repeat long"
)


def suffix_ranks(ids, doc):
    """(order, levels): suffixes in order, and the rank of each by its first 1, 2, 4, ... words.

    ``ids`` numbers the words of several texts in a row and ``doc`` their text,
    ascending; a suffix ends with its text. Only suffixes that share a rank are
    sorted again, so a text without repeats costs two rounds.
    """
    import numpy as np

    n = len(ids)
    _, first = np.unique(doc.astype(np.int64) * (int(ids.max()) + 1) + ids, return_inverse=True)
    # the rank of a group is the place of its first member, so ranks stay when a group splits
    counts = np.bincount(first)
    rank = (np.cumsum(counts) - counts)[first].astype(np.int32)
    ends = np.r_[np.flatnonzero(np.diff(doc)) + 1, n].astype(np.int64)
    end = np.repeat(ends, np.diff(np.r_[0, ends]))
    levels, order, width = [rank], np.argsort(rank, kind="stable"), 1
    while True:
        sorted_ranks = rank[order]
        shared = np.zeros(n, bool)
        same = sorted_ranks[1:] == sorted_ranks[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        places = np.flatnonzero(shared)
        if not len(places):
            return order, levels
        members = order[places]
        after = members + width
        inside = after < end[members]
        follow = np.where(inside, rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        head = rank[members].astype(np.int64)
        key = head * (n + 1) + follow
        within = np.argsort(key, kind="stable")
        members, key = members[within], key[within]
        order[places] = members
        fresh = np.r_[True, key[1:] != key[:-1]]
        rank = rank.copy()
        rank[members] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))]
        levels.append(rank)
        width *= 2


def common_prefixes(order, levels, end):
    """Words that each suffix in order shares with the one before it; the first shares none."""
    import numpy as np

    n = len(order)
    a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    out = np.zeros(n, np.int64)
    live = np.arange(n - 1)
    for level in range(len(levels) - 1, -1, -1):
        rank, width = levels[level], 1 << level
        i, j = a[live] + out[live + 1], b[live] + out[live + 1]
        fits = (i + width <= end[a[live]]) & (j + width <= end[b[live]])
        fits[fits] = rank[i[fits]] == rank[j[fits]]
        out[live[fits] + 1] += width
    return out


def lcp_intervals(lcp, least: int):
    """(length, first, last, parent) of every interval of common prefixes of ``least`` words or more, and each place's deepest one.

    An interval is a range of suffixes in order that share ``length`` words and
    no wider range does; the parent is the next interval around it, or -1.
    """
    import numpy as np

    length: list[int] = []
    left: list[int] = []
    right: list[int] = []
    parent: list[int] = []
    top = np.full(len(lcp) + 1, -1, np.int64)  # the interval whose length is the prefix at each place
    hot = np.flatnonzero(lcp >= least)
    for run in np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1) if len(hot) else ():
        stack: list[int] = []
        for place, value in zip(run.tolist(), lcp[run].tolist()):
            begin, last = place - 1, -1
            while stack and length[stack[-1]] > value:
                last = stack.pop()
                right[last], begin = place - 1, left[last]
                parent[last] = stack[-1] if stack else -1
            if not stack or length[stack[-1]] < value:
                if last >= 0:
                    parent[last] = len(length)
                parent.append(stack[-1] if stack else -1)
                stack.append(len(length))
                length.append(value)
                left.append(begin)
                right.append(-1)
            top[place] = stack[-1]
        for k in stack:
            right[k] = int(run[-1])
    # a suffix lies deepest in the interval of the longer prefix it shares with a neighbour
    deepest = np.where(lcp >= np.r_[lcp[1:], 0], top[:-1], top[1:])
    return length, left, right, parent, deepest


def repeat_lengths(ids, doc, least: int = LEAST):
    """Words of the longest maximal repeat that starts at each word; 0 where none of ``least`` words does."""
    import numpy as np

    n = len(ids)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    order, levels = suffix_ranks(ids, doc)
    ends = np.r_[np.flatnonzero(np.diff(doc)) + 1, n].astype(np.int64)
    end = np.repeat(ends, np.diff(np.r_[0, ends]))
    lcp = common_prefixes(order, levels, end)
    length, left, right, parent, deepest = lcp_intervals(lcp, least)
    if not length:
        return out
    # an interval grows to the left unless the words before its suffixes differ
    starts = np.r_[True, doc[1:] != doc[:-1]]
    before = np.where(starts, -1 - np.arange(n), np.r_[0, ids[:-1]])
    row = before[order]
    changes = np.r_[0, np.cumsum(row[1:] != row[:-1])]
    maximal = changes[np.asarray(right)] > changes[np.asarray(left)]
    best = np.zeros(len(length), np.int64)
    for k in sorted(range(len(length)), key=length.__getitem__):  # parents are shorter
        best[k] = length[k] if maximal[k] else (best[parent[k]] if parent[k] >= 0 else 0)
    place = np.flatnonzero(deepest >= 0)
    out[order[place]] = best[deepest[place]]
    return out


def _covered(spans):
    """Which words the spans that start at each word cover."""
    import numpy as np

    n = len(spans)
    held = np.flatnonzero(spans)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, held, 1)
    np.add.at(steps, held + spans[held], -1)
    return np.cumsum(steps[:-1]) > 0


def _judged(texts: list[str]) -> list[list]:
    """The columns of the rules for each text."""
    import numpy as np

    words, doc, sizes = [], [], []
    for k, text in enumerate(texts):
        found = WORD.findall(text)
        numbers: dict[str, int] = {}
        words.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found)))
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        doc.append(np.full(len(found), k, np.int64))
    ids, doc, chars = np.concatenate(words), np.concatenate(doc), np.concatenate(sizes)
    spans = repeat_lengths(ids, doc)
    covered = _covered(spans)
    k = len(texts)
    n_words = np.bincount(doc, minlength=k)
    word_chars = np.bincount(doc, weights=chars, minlength=k).astype(np.int64)
    repeated = np.bincount(doc[covered], minlength=k)
    covered_chars = np.bincount(doc[covered], weights=chars[covered], minlength=k).astype(np.int64)
    longest = np.zeros(k, np.int64)
    np.maximum.at(longest, doc, spans)
    symbols = [sum(map(text.count, SYMBOLS)) for text in texts]
    dup_lines = []
    for text in texts:
        lines = [line for line in text.split("\n") if WORD.search(line)]
        dup_lines.append(len(lines) - len(set(lines)))
    failed = (n_words < MIN_WORDS) | (100 * repeated > BASE_PERCENT * n_words)
    kept = ~failed & (100 * covered_chars <= MAX_COVERED * word_chars) & (longest <= MAX_LONGEST)
    return [
        n_words.tolist(),
        word_chars.tolist(),
        symbols,
        dup_lines,
        repeated.tolist(),
        failed.tolist(),
        kept.tolist(),
        covered_chars.tolist(),
        longest.tolist(),
    ]


def judge(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys`` with the columns of the rules: base figures, the base verdict, and ``kept``.

    One pass over the table, without a shuffle: a text is judged by itself.
    ``n_repeat_words`` are the words that the united repeats cover, which are
    those in windows of ``LEAST`` words found twice or more. ``kept`` also asks
    that repeats cover at most ``MAX_COVERED`` percent of the characters and
    that none has over ``MAX_LONGEST`` words.
    """
    shown = [f"_key{i}" for i in range(len(keys))]
    rows = docs.select(*[F.col(k).alias(s) for k, s in zip(keys, shown)], text_of(text).alias("_text"))
    fields = ", ".join(f"{s} {rows.schema[s].dataType.simpleString()}" for s in shown)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2
        names = [*shown, *[c.split(" ")[0] for c in RULE_COLUMNS.split(", ")]]
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "_text"):
                found = _judged(part["_text"].to_pylist())
                columns = [pa.array(v, t) for v, t in zip(found, types)]
                yield pa.RecordBatch.from_arrays([*[part[s] for s in shown], *columns], names)

    found = rows.mapInArrow(work, f"{fields}, {RULE_COLUMNS}")
    return found.toDF(*keys, *found.columns[len(keys) :])
