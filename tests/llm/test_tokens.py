"""Token store, packing and forced-boundary BPE against the library."""

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabwright.llm import bpe, packing, token_store
from tabwright.llm.unit_encoder import UnitEncoder, opened


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def expected(tokenizer, rows):
    library = Tokenizer.from_file(tokenizer)
    return [(k, library.encode(t or "", add_special_tokens=False).ids + [0]) for k, t in rows]


def test_unit_encoder_equals_library(byte_tokenizer):
    texts = ["", " ", " a", "a ", "a  b", "\n\na\n b\t", "it's 'S don't", "a<|endoftext|>b <|endoftext|> c", "é  è x\u0085y", "a.\nb, c; d's"]
    library = Tokenizer.from_file(byte_tokenizer)
    encoder = UnitEncoder(byte_tokenizer, cache_units=3)
    for _ in range(3):
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_unit_encoder_keeps_units_apart(byte_tokenizer):
    stems = ["a", "é", "1", "ab\x00", "x\x00y"]
    texts = [s * n + tail for s in stems for n in (1, 3, 11, 21, 22, 23, 24, 40) for tail in ("", ".", "\x00", "\x00\x00")]
    texts += ["q " + " ".join(texts), "\nq " + "\n".join(texts)]
    library = Tokenizer.from_file(byte_tokenizer)
    encoder = UnitEncoder(byte_tokenizer)
    for _ in range(2):
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_unit_encoder_learns_many_units_once(byte_tokenizer):
    names = ["".join("abcdefghij"[int(d)] for d in str(n)) for n in range(400_000)]
    texts = ["x " + " ".join(names[i : i + 1000]) for i in range(0, len(names), 1000)]
    encoder, calls = UnitEncoder(byte_tokenizer), []
    tokenize = encoder.tokenize
    encoder.tokenize = lambda unit: calls.append(1) or tokenize(unit)
    first = encoder.encode(texts)
    learned = len(calls)
    assert encoder.encode(texts) == first
    assert len(calls) == learned
    library = Tokenizer.from_file(byte_tokenizer)
    assert np.frombuffer(first[-1], encoder.dtype).tolist() == library.encode(texts[-1], add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\ta.b'sé日 \x1c1,<|>Σİ")), max_size=40))
def test_encoders_equal_library_on_any_text(byte_tokenizer, word_tokenizer, text):
    ids = np.frombuffer(opened(byte_tokenizer).encode([text])[0], "<u2").tolist()
    assert ids == Tokenizer.from_file(byte_tokenizer).encode(text, add_special_tokens=False).ids if text else ids == []
    library = _library(word_tokenizer)
    forced = bpe.opened(word_tokenizer)
    got = forced.encode([text])[0]
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(got, "<u4").tolist() == want
    assert forced.decode(got) == library.decode(want, skip_special_tokens=False)


_LIBRARY = {}


def _library(path):
    if path not in _LIBRARY:
        _LIBRARY[path] = Tokenizer.from_file(path)
    return _LIBRARY[path]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000))
    h = token_store.PerfectHash.build(keys)
    assert len(h) == len(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    assert len(token_store.PerfectHash.build(np.zeros(0, np.int64))) == 0


def test_store_reads_back_every_document(odd_docs, byte_tokenizer):
    store = token_store.write_store(odd_docs, byte_tokenizer, shard_bytes=20_000, bucket_keys=3)
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = token_store.read_digests(store, odd_docs.select("doc_id")).collect()
    want = sorted((-1 if k is None else k, len(ids), crc(ids)) for k, ids in expected(byte_tokenizer, rows))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    by_key = dict(expected(byte_tokenizer, rows))
    assert store.lookup(8) == [by_key[8]]
    assert store.lookup(2) == [by_key[2]] * 2
    assert store.lookup(12345) == []


def test_empty_store(no_docs, byte_tokenizer):
    store = token_store.write_store(no_docs, byte_tokenizer)
    assert token_store.read_digests(store, no_docs.select("doc_id")).collect() == []
    assert store.lookup(1) == []


def check_pieces(pieces, docs, window):
    """Every id of every document in one piece; sequences gapless, none longer than the window."""
    left = {}
    for k, ids in docs:
        left.setdefault((k, len(ids)), []).append(ids)
    by_doc = {}
    for r in pieces:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert by_doc.keys() == left.keys()
    for name, own in by_doc.items():
        assert sum(r.length for r in own) == sum(map(len, left[name]))
        texts = {tuple(x) for x in left[name]}
        for r in own:
            assert any(crc(x[r.start : r.start + r.length]) == r.ids_crc32 for x in texts)
        assert sorted(i for r in own for i in range(r.start, r.start + r.length)) == sorted(
            i for x in left[name] for i in range(len(x))
        )
    sequences = {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        assert {r.padded_to for r in own} == {packing.padded_length(at, window)}
    return sequences


def test_packing_uses_every_token_once(odd_docs, byte_tokenizer):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    pieces = packing.pack(odd_docs, byte_tokenizer, window=64, shard_pieces=5).collect()
    check_pieces(pieces, expected(byte_tokenizer, rows), 64)


def test_packing_pads_little(spark, sf_dir, byte_tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    pieces = packing.pack(docs, byte_tokenizer).collect()
    sequences = check_pieces(pieces, expected(byte_tokenizer, rows), 1024)
    short = [s for s in sequences.values() if sum(r.length for r in s) < 1024]
    assert len(short) <= 2


def test_packing_empty(no_docs, byte_tokenizer):
    assert packing.pack(no_docs, byte_tokenizer).collect() == []


def test_packing_finds_neighbours_far_apart(spark, byte_tokenizer):
    """Each document shares its rare words with one other, 300 rows away; all share the common ones."""
    rng = np.random.default_rng(5)
    vocabulary = sorted(w for w in Tokenizer.from_file(byte_tokenizer).get_vocab() if w[0] == "Ġ" and w[1:].isalpha() and len(w) > 5)
    rare = [w[1:] for w in rng.permutation(vocabulary)[:3000]]
    rows = []
    for i in range(600):
        own = [rare[10 * (i % 300) + j] for j in rng.permutation(10)]
        rows.append((i, " ".join(["", *own, *rng.choice(["the", "of", "and", "to", "in"], 20)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.pack(docs, byte_tokenizer, window=128, shard_pieces=20).collect()
    check_pieces(pieces, expected(byte_tokenizer, rows), 128)
    at = {}
    for r in pieces:
        at.setdefault(r.doc_id, set()).add(r.sequence_id)
    assert sum(bool(at[i] & at[i + 300]) for i in range(300)) >= 285


def test_fill_takes_the_best_neighbour_first():
    a, b = np.arange(10), np.arange(100, 110)
    pieces = [a, b, np.r_[a[:8], 55], np.r_[b[:8], 66]]
    first = packing.fill(pieces, 32)[0]
    assert [p[0] for p in first][:2] == [0, 2]


def test_a_mark_after_a_word_is_a_unit_of_its_own(byte_tokenizer):
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]
    texts = ["q " + " ".join(w + mark for w in words) for mark in ("", ".", ",", ";", ":", "!", "?")]
    texts += ["x\u0301, é. a., b!? 'S. 's, 12:30: \u00a0. x<|endoftext|>, y", ",", "a\n.\nb.", "q.", "q .", "a.\u00a0b, c"]
    library = Tokenizer.from_file(byte_tokenizer)
    encoder = UnitEncoder(byte_tokenizer)
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.known < 2 * len(words)


def test_places_are_the_three_lowest_ranks():
    rng = np.random.default_rng(4)
    ranks = rng.permutation(40)
    ranks[ranks > 30] = -1
    pieces = [rng.integers(0, 40, n) for n in (1, 2, 3, 5, 30, 200)] + [np.flatnonzero(ranks < 0)]
    starts = np.cumsum([0, *map(len, pieces)])[:-1]
    got = packing.places_of(np.concatenate(pieces), starts, ranks).tolist()
    none = (1 << packing.PLACE_BITS) - 1
    for piece, place in zip(pieces, got):
        own = [*sorted({int(r) for r in ranks[piece] if r >= 0}), none, none][:3]
        want = packing.NO_PLACE if own[0] == none else own[0] << 2 * packing.PLACE_BITS | own[1] << packing.PLACE_BITS | own[2]
        assert place == want


def test_dropped_pieces_leave_the_other_scores():
    rng = np.random.default_rng(5)
    pieces = [rng.integers(0, 50, int(n)) for n in rng.integers(1, 40, 30)]
    whole, part = packing.Bm25(pieces), packing.Bm25(pieces)
    gone = rng.random(30) < 0.5
    part.drop(gone)
    for seed in np.flatnonzero(~gone).tolist():
        assert (whole.scores(seed)[~gone] == part.scores(seed)[~gone]).all()
        assert not part.scores(seed)[gone].any()


def test_forced_cuts_change_nothing(word_tokenizer):
    forced = bpe.opened(word_tokenizer)
    library = _library(word_tokenizer)
    for text in ["x" * 3000, "abcé" * 900, "日本語テキスト 한국어 😀😃", "ΑΣΣΟΣ Σ", "<|endoftext|>a<|startoftext|>"]:
        assert np.frombuffer(forced.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    words = forced.words("naïveté")
    assert b"".join(f[:-1] for f in forced.cut(words)[0]) == words[0]


def test_bpe_over_rows(odd_docs, no_docs, word_tokenizer):
    library = _library(word_tokenizer)
    rows = bpe.decode(bpe.encode(odd_docs, word_tokenizer), word_tokenizer).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect()]
    want = [(k, library.encode(t, add_special_tokens=False).ids) for k, t in texts]
    assert sorted((r.doc_id or -1, np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == sorted(
        (k or -1, ids) for k, ids in want
    )
    assert sorted(r.decoded for r in rows) == sorted(library.decode(ids, skip_special_tokens=False) for _, ids in want)
    assert bpe.encode(no_docs, word_tokenizer).collect() == []
