"""Suffix-array repeats against plain windows, tree search against all scores, and repair against all paths."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from tabwright.llm import conversation_repair, lexical_search, repetition


def covered_by_windows(words, k):
    seen = Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = [False] * len(words)
    for i in range(len(words) - k + 1):
        if seen[tuple(words[i : i + k])] > 1:
            out[i : i + k] = [True] * k
    return out


def longest_twice(words):
    best = 0
    for k in range(1, len(words)):
        if len({tuple(words[i : i + k]) for i in range(len(words) - k + 1)}) == len(words) - k + 1:
            break
        best = k
    return best


def test_repeats_equal_plain_windows(spark, odd_docs):
    rng = random.Random(5)
    texts = [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id != 8]
    for key in range(100, 160):
        words = [f"w{rng.randrange(rng.choice([1, 2, 20, 500]))}" for _ in range(rng.choice([0, 5, 40, 160]))]
        at = rng.randrange(len(words) // 2 + 1)
        texts.append((key, " \n".join(words + words[at : at + rng.randint(0, 60)])))
    docs = spark.createDataFrame([(k, t, "s") for k, t in texts], "doc_id long, text string, kept string")
    got = repetition.judge(docs).collect()
    want = []
    for key, text in texts:
        words = (text or "").encode().split()
        words = [w.decode() for w in words]
        covered, chars = covered_by_windows(words, 8), sum(map(len, words))
        held = sum(len(w) for w, c in zip(words, covered) if c)
        longest = longest_twice(words)
        longest = longest if longest >= 8 else 0
        failed = len(words) < 20 or 100 * sum(covered) > 30 * len(words)
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        kept = not failed and 100 * held <= 30 * chars and longest <= 50
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        want.append((key, len(words), chars, symbols, len(lines) - len(set(lines)), sum(covered), failed, kept, held, longest))
    assert Counter(map(tuple, got)) == Counter(want)


def test_repeats_of_long_and_missing_texts(spark, odd_docs, no_docs):
    assert repetition.judge(no_docs).collect() == []
    words = [f"w{i}" for i in range(60_000)]
    long = " ".join(words + words[:51])
    docs = spark.createDataFrame([(1, long), (2, "a " * 50_000), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in repetition.judge(docs).collect()}
    assert (got[1].n_words, got[1].longest_repeat, got[1].kept) == (60_051, 51, False)
    assert (got[2].n_repeat_words, got[2].longest_repeat, got[2].base_failed) == (50_000, 49_999, True)
    assert (got[3].n_words, got[3].base_failed, got[3].kept) == (0, True, False)
    assert repetition.judge(odd_docs, ["doc_id", "key"]).columns[:2] == ["doc_id", "key"]


def ranked_plainly(docs, items, k):
    """Scores of all documents for all items, straight from their definition."""
    def terms(text):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    held = [(key, Counter(terms(text))) for key, text in docs]
    held = [(key, c, sum(c.values())) for key, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c, n in held:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = 0
            for t in set(terms(text)):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, -1 if key is None else key))
        out += [(item, rank, key, -s) for rank, (s, key) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_tree_search_equals_all_scores(spark, odd_docs, no_docs):
    rng = random.Random(2)
    words = [f"t{i}" for i in range(40)] + ["é", "日本語", "The"]
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    docs += [(100 + i // 2, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 6)))) for i in range(12)]
    items += [(None, "the cat sat"), (50, None), (51, ""), (51, "unheard"), (52, "The CAT_sat É é!"), (1, items[1][1])]
    frame = spark.createDataFrame([(k, t, 1, "r") for k, t in docs], "doc_id long, text string, score int, rank string")
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    for k in (3, 50):
        got = lexical_search.search(frame, asked, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        rows = Counter((r[0], r[1], -1 if r[2] is None else r[2], r[3]) for r in got.collect())
        assert rows == Counter(ranked_plainly(docs, items, k))
    assert lexical_search.search(no_docs, asked).collect() == []
    assert lexical_search.search(frame, asked.filter("item_id = 99")).collect() == []


def test_tree_prunes_and_keeps_ties():
    rng = np.random.default_rng(3)
    sets = [rng.choice(60, rng.integers(1, 12), replace=False) for _ in range(600)] + [np.array([3, 7])] * 70
    starts = np.r_[0, np.cumsum([len(s) for s in sets])]
    terms = np.concatenate(sets).astype(np.int32)
    adds = rng.integers(1, 10**6, len(terms)) * 10**4
    adds[starts[600] :] = 5 * 10**9  # many equal documents
    tree = lexical_search.BallTree(starts, terms, adds, leaf=4)
    for asked in ([3, 7], [1], [0, 5, 9, 30], [59, 3]):
        asked = np.array(asked, np.int32)
        exact = np.array([adds[a:b][np.isin(terms[a:b], asked)].sum() for a, b in zip(starts, starts[1:])])
        for k, floor in ((5, 0), (50, 0), (5, int(np.sort(exact)[-9]))):
            places, scores = tree.search(asked, k, floor)
            least = max(int(np.sort(exact)[-k]), floor, 1)
            assert sorted(zip(places.tolist(), scores.tolist())) == [(i, s) for i, s in enumerate(exact.tolist()) if s >= least]


def edits_plainly(codes):
    """Least (cost, edits), trying every edit of every row and up to two inserts in a row."""
    best = []

    def go(i, state, cost, edits, inserts):
        if i == len(codes) and state in (0, 3):
            best.append((cost, edits))
        for c, e, j, s in conversation_repair._onward(codes, i, state):
            if e != "I" or inserts < 2:
                go(j, s, cost + c, edits + e, inserts + 1 if e == "I" else 0)

    go(0, 0, 0, "", 0)
    return min(best)


def repaired_plainly(rows):
    """{conversation: report} of damaged rows, one conversation at a time."""
    out = {}
    for conv, _, _, _ in rows:
        out.setdefault(conv, [])
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        case = zlib.crc32(name.encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        out[conv] += [(turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    white = "\x20\t\n\x0b\x0c\r"
    for conv, held in out.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, codes, faults = set(), "", Counter()
        for _, role, text in held:
            bare = text.strip(white)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            initial = role[:1] if role[:1] in tuple("sua") else "x"
            codes += "d" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        cost, edits = edits_plainly(codes)
        state, lines, i = "", [], 0
        for e in edits:
            emitted = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if e != "I":
                _, role, text = held[i]
                i += 1
            if e == "D":
                continue
            lines.append(f"{emitted}:" if e == "I" else f"{role}:{text}" if e == "K" else f"{emitted}:{text}")
            state = lines[-1][0]
        turns = {t for t, _, _ in held if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, edits, digest)
    return out


def test_repair_equals_all_paths(spark):
    rng = random.Random(8)
    texts = ["One.", "Two!", "three", "", " \n", None, "four?  ", "é 日本.", "x" * 3000 + "."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randint(0, 5)):
            turn = rng.choice([turn, turn, turn + 3, None, 1])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"])
            rows.append((conv, turn, role, rng.choice(texts)))
    rows += rows[:10]
    schema = "conv_id long, turn long, role string, text string, gone string, key int"
    frame = spark.createDataFrame([(*r, "g", 0) for r in rows], schema)
    want = repaired_plainly(rows)
    hurt = conversation_repair.damaged(frame)
    whole = {r[0]: tuple(r)[1:] for r in conversation_repair.repair(hurt).collect()}
    assert whole == want
    blocks = {r[0]: tuple(r)[1:] for r in conversation_repair.repair(hurt, long_rows=2).collect()}
    assert blocks == want
    assert conversation_repair.repair(conversation_repair.damaged(frame.limit(0))).collect() == []


def test_long_conversation_in_blocks(spark):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"No {t}.", "cut", ""])) for t in range(900)]
    frame = spark.createDataFrame([*rows, (8, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    hurt = conversation_repair.damaged(frame)
    assert sorted(conversation_repair.repair(hurt, long_rows=100).collect()) == sorted(conversation_repair.repair(hurt).collect())


def test_bidirectional_search_equals_every_path():
    rng = random.Random(1)
    for _ in range(200):
        codes = "".join(rng.choices("suaxSUAXd", k=rng.randint(0, 5)))
        assert conversation_repair.cheapest(codes) == edits_plainly(codes)
