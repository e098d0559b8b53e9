"""Small helpers that the operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = "\x20\t\n\x0b\x0c\r"


def text_of(column: str = "text") -> Column:
    """The text of a row; a missing one is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts: one scan, one row to the driver."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text))).alias("n")).first()["n"] or 0)


def parts_for(size: int, each: int) -> int:
    """Number of parts of about ``each`` units that hold ``size`` units."""
    return max(1, math.ceil(size / each))


def slices(batch, limit: int, column: str) -> Iterator:
    """Consecutive slices of an Arrow batch whose texts hold about ``limit`` bytes; a longer text is alone."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(np.asarray(sizes).tolist()):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def groups(batches: Iterator, keys: list[str]) -> Iterator:
    """Tables of consecutive rows with equal integer keys; a group may go on in later batches."""
    import numpy as np
    import pyarrow as pa

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(int(v[start]) for v in values)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


CHUNK_BYTES = 1 << 20
_WHITE_BYTES = frozenset(WHITE.encode())
_POWERS: dict = {}


def _powers(n: int):
    import numpy as np

    if len(_POWERS.get("up", ())) < max(n, 1):
        size = max(n, 2 * CHUNK_BYTES)
        base = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS.update(up=np.cumprod(up), down=np.cumprod(down))
        rng = np.random.default_rng(12345)
        _POWERS["bytes"] = rng.integers(1, 1 << 63, 256, np.uint64)
        white = np.zeros(256, bool)
        white[list(_WHITE_BYTES)] = True
        _POWERS["white"] = white
    return _POWERS["up"], _POWERS["down"], _POWERS["bytes"], _POWERS["white"]


def finished(h):
    """Spread the bits of 64-bit hashes."""
    import numpy as np

    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _chunk_hashes(data: bytes):
    import numpy as np

    raw = np.frombuffer(data, np.uint8)
    up, down, value, white = _powers(len(raw))
    word = np.r_[False, ~white[raw], False]
    starts = np.flatnonzero(word[1:] & ~word[:-1])
    ends = np.flatnonzero(word[:-1] & ~word[1:])
    sums = np.r_[np.uint64(0), np.cumsum(value[raw] * up[: len(raw)])]
    return finished((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def word_hashes(data: bytes):
    """64-bit hash, start and end of each run of bytes other than ASCII white space."""
    import numpy as np

    if len(data) <= 2 * CHUNK_BYTES:
        return _chunk_hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        while end < len(data) and data[end] not in _WHITE_BYTES:
            end += 1
        h, s, e = _chunk_hashes(data[at:end])
        parts.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))
