"""Token ids of whole texts from the tokenizers library, each distinct unit encoded once.

A byte-level tokenizer cuts before every single space that stands between two
visible characters: no alternative of its pattern holds a space after another
character. A line break between two visible characters is a token of its own,
and so is a plain mark between an ASCII letter or digit and the end of its word.
Text is split there; a unit not seen before is cut further by the tokenizer's
own pattern and each new pre-token goes through the library's model. The ids of
a text are its units' ids in a row. Units seen before are looked up all at once,
in an open-addressing table of arrays that holds their bytes and length, so no
two units are taken for one; those over ``KEY_BYTES`` in a dictionary. Texts with runs of white space, and units
that hold a special token, go through the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

CACHE_UNITS = 1_000_000  # about 60 MB
PIECES = 50_000
KEY_BYTES = 23  # of a unit that is looked up in arrays
CHUNK_UNITS = 1 << 16
PLAIN_MARKS = (".", ",", ";", ":", "!", "?")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed by the file format
_CERTAIN = re.compile(r"(?<=\S) (?=\S)")
_RUN = re.compile(r"\s\s")
_OPEN: dict[str, "UnitEncoder"] = {}


def byte_letters() -> dict[int, str]:
    """The printable letter by which a byte-level vocabulary names each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in names)
    names.update((b, chr(256 + i)) for i, b in enumerate(hidden))
    return names


class UnitEncoder:
    def __init__(self, path: str, cache_units: int = CACHE_UNITS):
        import numpy as np
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) if special else r"(?!)").search
        self.findall = regex.compile(PATTERN).findall
        self.letters = byte_letters()
        self.marks = {c: self._piece(c) for c in PLAIN_MARKS if c}
        self.is_mark, self.before_mark = np.zeros(256, bool), np.zeros(256, bool)
        # a special token with a mark in it must stay whole
        self.is_mark[[ord(c) for c in PLAIN_MARKS if not any(c in token for token in special)]] = True
        self.low = np.array([[(1 << 8 * min(max(n - 8 * i, 0), 8)) - 1 for i in range(3)] for n in range(KEY_BYTES + 1)], np.uint64)
        self.before_mark[[b for b in range(128) if chr(b).isalnum()]] = True
        self.cache_units = cache_units
        self.pieces: dict[str, bytes] = {}
        self._forget()

    def whole(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            spelled = piece.replace(" ", self.letters[0x20])
        else:
            spelled = piece.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokenize(spelled)]).tobytes()

    def _learn(self, raws: list[bytes]) -> list[bytes]:
        """Ids of units with the space or break before them."""
        pieces, heads, out = self.pieces, {}, []
        if len(pieces) > PIECES:
            pieces.clear()
        tokenize, code, space, letters = self.tokenize, self.code, self.letters[0x20], self.letters
        for raw in raws:
            text = raw.decode()
            unit = text[1:] if text[0] == " " else text
            if unit.isalpha():  # one pre-token with the space before it
                spelled = space + unit if raw.isascii() else raw.decode("latin-1").translate(letters)
                out.append(array(code, [t.id for t in tokenize(spelled)]).tobytes())
                continue
            head = unit[:-1]
            if unit[-1:] in PLAIN_MARKS and head.isalpha():  # a word and a mark
                ids = heads.get(head)
                if ids is None:
                    ids = heads[head] = self._piece(" " + head)
                out.append(ids + self.marks[unit[-1]])
                continue
            if self.special(text):
                out.append(self.whole(text))
                continue
            ids = []
            for piece in self.findall(text):
                if piece not in pieces:
                    pieces[piece] = self._piece(piece)
                ids.append(pieces[piece])
            out.append(b"".join(ids))
        return out

    def _forget(self, room: int = 1 << 12) -> None:
        import numpy as np

        self.known = 0
        self.keys = np.zeros((room, 3), np.uint64)
        self.first, self.size = np.zeros(room, np.int64), np.zeros(room, np.int64)
        self.pool, self.held = np.zeros(4 * room, self.dtype), 0
        self.slots = np.full(4 * room, -1, np.int32)
        self.long: dict[bytes, int] = {}

    def _place(self, entries) -> None:
        """Give each entry the next free slot after that of its hash."""
        import numpy as np

        last = np.uint64(len(self.slots) - 1)
        slot = (_hashed(self.keys[entries]) & last).astype(np.int64)
        while len(entries):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entries[free]
            left = self.slots[slot] != entries
            entries, slot = entries[left], (slot[left] + 1) & int(last)

    def _add(self, raws: list[bytes], keys) -> None:
        """Learn new units; their entries are the next ones."""
        import numpy as np

        ids = self._learn(raws)
        n = self.known + len(raws)
        if n > len(self.first):
            room = max(2 * len(self.first), n) - len(self.first)
            self.keys = np.r_[self.keys, np.zeros((room, 3), np.uint64)]
            self.first, self.size = (np.r_[x, np.zeros(room, np.int64)] for x in (self.first, self.size))
        flat = np.frombuffer(b"".join(ids), self.dtype)
        if self.held + len(flat) > len(self.pool):
            self.pool = np.r_[self.pool, np.zeros(len(self.pool) + len(flat), self.dtype)]
        self.pool[self.held : self.held + len(flat)] = flat
        new = np.arange(self.known, n)
        sizes = np.array([len(x) for x in ids], np.int64) // self.dtype.itemsize
        self.first[new], self.size[new] = self.held + np.cumsum(sizes) - sizes, sizes
        self.keys[new] = keys
        self.known, self.held = n, self.held + len(flat)
        short = np.array([len(r) <= KEY_BYTES for r in raws], bool)
        self.long.update((raws[i], int(new[i])) for i in np.flatnonzero(~short).tolist())
        if 2 * n > len(self.slots):
            size = len(self.slots)
            while 2 * n > size:
                size *= 2
            self.slots = np.full(size, -1, np.int32)
            whole = np.ones(n, bool)
            whole[list(self.long.values())] = False
            self._place(np.flatnonzero(whole))
        else:
            self._place(new[short])

    def _entries(self, data: bytes, starts, ends):
        """Entry of each unit ``data[start:end]``; ``data`` ends with ``KEY_BYTES`` + 1 zeros."""
        import numpy as np

        sizes = ends - starts
        held = np.minimum(sizes, KEY_BYTES)
        keys = np.ndarray((len(data) - KEY_BYTES, 3), "<u8", data, strides=(1, 8))[starts]
        keys &= self.low.take(held, axis=0)
        keys[:, 2] |= held.astype(np.uint64) << np.uint64(56)
        last = len(self.slots) - 1
        slot = (_hashed(keys) & np.uint64(last)).view(np.int64)
        found = self.slots[slot].astype(np.int64)  # a free slot says -1; no long unit is in the table
        own = self.keys.take(found, axis=0, mode="wrap")
        same = (own[:, 0] == keys[:, 0]) & (own[:, 1] == keys[:, 1]) & (own[:, 2] == keys[:, 2])
        todo = np.flatnonzero(~same & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & last
            got = found[todo] = self.slots[slot[todo]]
            own, asked = self.keys.take(got, axis=0, mode="wrap"), keys[todo]
            same = (own[:, 0] == asked[:, 0]) & (own[:, 1] == asked[:, 1]) & (own[:, 2] == asked[:, 2])
            todo = todo[~same & (got >= 0)]
        for i in np.flatnonzero(sizes > KEY_BYTES).tolist():
            found[i] = self.long.get(data[starts[i] : ends[i]], -1)
        lacking = np.flatnonzero(found < 0)
        if len(lacking):
            raws = [data[a:b] for a, b in zip(starts[lacking].tolist(), ends[lacking].tolist())]
            numbers: dict[bytes, int] = {}
            at = [numbers.setdefault(r, len(numbers)) for r in raws]
            where = np.empty(len(numbers), np.int64)
            where[at] = lacking
            found[lacking] = np.array(at) + self.known
            self._add(list(numbers), keys[where])
        return found

    def _ids(self, data: bytes, starts, ends):
        """Ids of all units in a row, and where those of each unit end."""
        import numpy as np

        data += bytes(KEY_BYTES + 1)
        parts, counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for a in range(0, len(starts), CHUNK_UNITS):
            entries = self._entries(data, starts[a : a + CHUNK_UNITS], ends[a : a + CHUNK_UNITS])
            sizes = self.size[entries]
            before = np.cumsum(sizes) - sizes
            parts.append(self.pool[np.repeat(self.first[entries] - before, sizes) + np.arange(sizes.sum())])
            counts.append(sizes)
        return np.concatenate(parts), np.cumsum(np.concatenate(counts))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``dtype``."""
        import numpy as np

        if self.known > self.cache_units:
            self._forget()
        out, plain = [b""] * len(texts), []
        for i, text in enumerate(texts):
            if not text:
                continue
            if not (_RUN.search(text) or text[0].isspace()):
                plain.append(i)
                continue
            first, *rest = _CERTAIN.split(text)
            raws = [b" " + unit.encode() for unit in rest]
            ends = np.cumsum([len(r) for r in raws], dtype=np.int64)
            starts = np.r_[0, ends][:-1].astype(np.int64)
            out[i] = self.whole(first) + self._ids(b"".join(raws), starts, ends)[0].tobytes()
        if plain:
            parts = [texts[i].encode() for i in plain]
            data = b"\n" + b"\n".join(parts)
            begin = np.cumsum([0, *(len(p) + 1 for p in parts)])
            raw = np.frombuffer(data, np.uint8)
            cut = (raw == 0x20) | (raw == 0x0A)
            ends_word = np.append(cut[1:], True)
            cut[1:] |= self.is_mark[raw[1:]] & self.before_mark[raw[:-1]] & ends_word[1:]
            starts = np.flatnonzero(cut)
            ids, stops = self._ids(data, starts, np.r_[starts[1:], len(data)])
            cuts = np.r_[0, stops][np.searchsorted(starts, begin)].tolist()
            # without the break put before the text
            for i, a, b in zip(plain, cuts, cuts[1:]):
                out[i] = ids[a + 1 : b].tobytes()
        return out


def _hashed(keys):
    """Spread 64-bit hashes of rows of three numbers."""
    import numpy as np

    h = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h = (h + keys[:, 1]) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h = (h + keys[:, 2]) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def opened(path: str) -> UnitEncoder:
    """The encoder of a worker process; its cache serves all tasks of the process."""
    if path not in _OPEN:
        _OPEN[path] = UnitEncoder(path)
    return _OPEN[path]


def crc_of(ids) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())
