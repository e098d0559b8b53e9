"""Byte-pair encoding with forced boundaries, and its decoding.

A merge can only join what stands side by side inside some vocabulary token. A
pair of bytes that no token holds side by side is therefore a certain cut: the
fragments on either side are encoded on their own and their ids put in a row.
Fragments are short and recur, so each distinct one is merged once. All new
fragments of a slice are merged together in arrays: in every step each fragment
joins its pair of lowest rank, the leftmost of equals, until none is left.
Fragments too long for that go through a heap.

Text is normalised and cut into words as the tokenizer file says; units between
spaces that are plain printable text take a short way with the same result, all
others go through the library's own normaliser and pre-tokenizer. The file must
be a BPE model with or without an end-of-word suffix, whose normaliser and
pre-tokenizer treat each unit between spaces alone.

Decisions: a missing text is empty and has no ids; special tokens in a text
become their ids, as the library does; a row with the same text gets the same
ids; ids come as little-endian unsigned 32-bit integers in one binary value.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices, text_of
from tabwright.llm.unit_encoder import byte_letters

CACHE_UNITS = 200_000  # of each of two generations
SLICE_BYTES = 2 << 20
ROW_LENGTHS = (8, 16, 32)  # widths of the merge arrays
# Fixed by the tokenizer file that the short way serves.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
NEVER = 1 << 30
_OPEN: dict[str, "ForcedBpe"] = {}


class ForcedBpe:
    def __init__(self, path: str):
        import numpy as np
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        tokenizer = Tokenizer.from_file(path)
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else (lambda text: text)
        self.pre_tokenize = tokenizer.pre_tokenizer.pre_tokenize_str
        letters = byte_letters()
        self.byte_of = {c: b for b, c in letters.items()}
        names = (spec.get("normalizer") or {}).get("normalizers", [])
        self.short_way = [n["type"] for n in names] == NORMALIZERS and WORDS in json.dumps(
            spec["pre_tokenizer"], ensure_ascii=False
        ).replace("\\\\", "\\")
        self.find_words = regex.compile(WORDS).findall
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys, first = np.unique(left << 32 | right, return_index=True)
        self.pair_keys, self.pair_ranks, self.pair_made = keys, first.astype(np.int64), made[first]
        # bytes that stand side by side inside a token; the last pair of a word by itself
        self.joined = np.zeros((2, 256, 256), bool)
        for token in vocab:
            ends = bool(suffix) and token.endswith(suffix)
            spelled = [self.byte_of.get(c) for c in (token[: -len(suffix)] if ends else token)]
            for i, (a, b) in enumerate(zip(spelled, spelled[1:])):
                if a is not None and b is not None:
                    self.joined[int(ends and i == len(spelled) - 2), a, b] = True
        if not suffix:
            self.joined[1] = self.joined[0]
        added = spec.get("added_tokens", [])
        self.special = {t["content"]: t["id"] for t in added}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if added else None
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.tokens: list[bytes] = [b""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token.encode()
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fragments: dict[bytes, bytes] = {}

    def words(self, unit: str) -> list[bytes]:
        """Words of a unit, in bytes."""
        if self.short_way and unit.isprintable() and "Σ" not in unit and unicodedata.is_normalized("NFC", unit):
            return [w.encode() for w in self.find_words(unit.lower())]
        pieces = self.pre_tokenize(self.normalize(unit))
        return [bytes(self.byte_of[c] for c in piece) for piece, _ in pieces]

    def cut(self, words: list[bytes]) -> list[list[bytes]]:
        """Fragments of each word: cut between bytes that no token joins. The last one of a word ends with a zero mark."""
        import numpy as np

        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        final = np.zeros(len(flat), np.int64)
        final[ends - 1] = 1
        cut = np.ones(len(flat) + 1, bool)
        cut[1:-1] = ~self.joined[final[1:], flat[:-1], flat[1:]]
        cut[ends] = True
        at = np.flatnonzero(cut)
        data = flat.tobytes()
        fragments = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        counts = np.diff(np.r_[0, np.searchsorted(at, ends)])
        out, i = [], 0
        for n in counts.tolist():
            out.append([*(f + b"\x00" for f in fragments[i : i + n - 1]), fragments[i + n - 1] + b"\x01"])
            i += n
        return out

    def _ranks(self, a, b):
        import numpy as np

        key = a << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        hit = (self.pair_keys[at] == key) & (b >= 0) & (a >= 0)
        return np.where(hit, self.pair_ranks[at], NEVER), self.pair_made[at]

    def merge(self, fragments: list[bytes]) -> None:
        """Learn the ids of marked fragments."""
        import numpy as np

        groups: dict[int, list[bytes]] = {}
        for f in fragments:
            size = next((w for w in ROW_LENGTHS if len(f) - 1 <= w), 0)
            groups.setdefault(size, []).append(f)
        for f in groups.pop(0, []):
            self.fragments[f] = np.array(self._merge_long(f), "<u4").tobytes()
        for width, rows in groups.items():
            sizes = np.array([len(f) - 1 for f in rows])
            symbols = np.full((len(rows), width), -1, np.int64)
            flat = np.frombuffer(b"".join(f[:-1] for f in rows), np.uint8)
            r = np.repeat(np.arange(len(rows)), sizes)
            c = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            symbols[r, c] = self.inner[flat]
            whole = np.array([f[-1] for f in rows], bool)
            at = np.flatnonzero(whole)
            ends = sizes[at] - 1
            symbols[at, ends] = self.last[flat[np.cumsum(sizes)[at] - 1]]
            ranks, _ = self._ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
            ranks = ranks.reshape(len(rows), width - 1)
            active = np.arange(len(rows))
            done = np.empty_like(symbols)
            column = np.arange(width)
            while len(active):
                pos = ranks.argmin(axis=1)
                best = ranks[np.arange(len(active)), pos]
                over = best == NEVER
                if over.any():
                    done[active[over]] = symbols[over]
                    active, symbols, ranks, pos = active[~over], symbols[~over], ranks[~over], pos[~over]
                    if not len(active):
                        break
                rows_ = np.arange(len(active))
                _, made = self._ranks(symbols[rows_, pos], symbols[rows_, pos + 1])
                symbols[rows_, pos] = made
                take = np.minimum(column + (column > pos[:, None]), width - 1)
                symbols = np.take_along_axis(symbols, take, 1)
                symbols[:, -1] = -1
                ranks = np.take_along_axis(ranks, np.minimum(take[:, :-1], width - 2), 1)
                ranks[:, -1] = NEVER
                before = np.maximum(pos - 1, 0)
                new, _ = self._ranks(symbols[rows_, before], symbols[rows_, before + 1])
                ranks[rows_, before] = new
                after = np.minimum(pos, width - 2)
                new, _ = self._ranks(symbols[rows_, after], symbols[rows_, after + 1])
                ranks[rows_, after] = new
            kept = done >= 0
            flat_ids = done[kept].astype("<u4").tobytes()
            stops = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
            for f, a, b in zip(rows, [0, *stops], stops):
                self.fragments[f] = flat_ids[a:b]

    def _merge_long(self, fragment: bytes) -> list[int]:
        """Merge one fragment of any length with a heap of its pairs."""
        import numpy as np

        body = fragment[:-1]
        ids = self.inner[np.frombuffer(body, np.uint8)].tolist()
        if fragment[-1]:
            ids[-1] = int(self.last[body[-1]])
        if not hasattr(self, "pairs"):
            made = zip(self.pair_ranks.tolist(), self.pair_made.tolist())
            self.pairs = dict(zip(self.pair_keys.tolist(), made))
        following = [*range(1, len(ids)), -1]
        preceding = list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i):
            j = following[i]
            if j >= 0 and (found := self.pairs.get(ids[i] << 32 | ids[j])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = following[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.pairs[a << 32 | b][1], -1
            following[i] = following[j]
            if following[j] >= 0:
                preceding[following[j]] = i
            offer(i)
            if preceding[i] >= 0:
                offer(preceding[i])
        return [i for i in ids if i >= 0]

    def _learn(self, units: set[str]) -> None:
        older = self.older
        known = units.intersection(older)
        self.units.update((u, older[u]) for u in known)
        units = units - known
        if not units:
            return
        if len(self.fragments) > CACHE_UNITS:
            self.fragments.clear()
        words = {u: self.words(u) for u in units}
        distinct = list({w for ws in words.values() for w in ws})
        cut = dict(zip(distinct, self.cut(distinct))) if distinct else {}
        self.merge(list({f for fs in cut.values() for f in fs}.difference(self.fragments)))
        ids = {w: b"".join([self.fragments[f] for f in fs]) for w, fs in cut.items()}
        for unit, ws in words.items():
            self.units[unit] = b"".join([ids[w] for w in ws])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.units) > CACHE_UNITS:
            self.older, self.units = self.units, {}
        cut = []
        for text in texts:
            parts = self.split_special(text) if self.split_special and any(s in text for s in self.special) else [text]
            cut.append([p.replace("\n", " ").split(" ") if i % 2 == 0 else p for i, p in enumerate(parts)])
        missing: set[str] = set()
        for parts in cut:
            for part in parts[::2]:
                missing.update(part)
        self._learn(missing.difference(self.units))
        known = self.units.__getitem__
        out = []
        for parts in cut:
            pieces = [
                b"".join(map(known, p)) if i % 2 == 0 else self.special[p].to_bytes(4, "little") for i, p in enumerate(parts)
            ]
            out.append(b"".join(pieces))
        return out

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces, for a tokenizer file without a decoder."""
        import numpy as np

        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()


def opened(path: str) -> ForcedBpe:
    if path not in _OPEN:
        _OPEN[path] = ForcedBpe(path)
    return _OPEN[path]


def _map_column(path: str, column: str, kind: str, size: int):
    """Replace ``column`` by its ids or, for ids, its text."""

    def kernel(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = opened(path)
        for batch in batches:
            at = batch.schema.names.index(column)
            for part in slices(batch, size, column):
                if kind == "ids":
                    values = pa.array(bpe.encode(part[column].to_pylist()), pa.binary())
                else:
                    values = pa.array([bpe.decode(x) for x in part[column].to_pylist()], pa.string())
                columns = list(part.columns)
                columns[at] = values
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return kernel


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key and ``ids``."""
    rows = docs.select(F.col(key), text_of(text).alias("ids"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(_map_column(tokenizer, "ids", "ids", SLICE_BYTES), f"`{key}` {kind}, ids binary")


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """One row per row of ``encoded``: its key, ``ids`` and ``decoded``, the library's decoding of the ids."""
    rows = encoded.select(F.col(key), "ids", F.col("ids").alias("decoded"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        _map_column(tokenizer, "decoded", "text", 2 * SLICE_BYTES), f"`{key}` {kind}, ids binary, decoded string"
    )
