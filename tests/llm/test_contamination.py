"""Benchmark windows in documents against a search of every window at every place."""

import hashlib
import random
import re

import numpy as np

from riskframe.llm import contamination

DOCS = "doc_id long, text string, item_id string, contaminated string"
ITEMS = "item_id long, text string, doc_id string"


def words_of(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)


def brute(docs, items, window=10):
    rows = []
    wanted = []
    for key, text, *_ in items:
        words = words_of(text)
        size = min(window, len(words))
        wanted += [(key, words[i : i + size]) for i in range(len(words) - size + 1) if size]
    for key, text, *_ in docs:
        words, hit, ids = words_of(text), set(), set()
        for item, w in wanted:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    ids |= {str(item)} if item is not None else set()
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        rows.append((key, len(words), len(hit), len(ids), sha, bool(hit)))
    return sorted(rows, key=str)


def found(spark, docs, items, **settings):
    df = contamination.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **settings)
    return sorted(map(tuple, df.collect()), key=str)


def corpus(rng, vocabulary, n_items, n_docs):
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, text(rng.choice([1, 2, 4, 5, 6, 9, 10, 11, 14, 25])), "x") for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        words = text(rng.randint(0, 60))
        for _ in range(rng.randrange(3)):
            _, part, _ = rng.choice(items)
            at = rng.randint(0, len(words))
            cut = rng.randint(0, len(part))
            words[at:at] = part[:cut] if rng.random() < 0.5 else part[len(part) - cut :]
        docs.append((i, rng.choice([" ", ", ", "\n- "]).join(w.upper() if rng.random() < 0.2 else w for w in words), "x", "y"))
    return docs, [(i, "; ".join(w), x) for i, w, x in items]


def test_equals_brute_force(spark):
    rng = random.Random(1)
    for vocabulary in ([f"w{i}" for i in range(300)], ["a", "b", "é7"]):
        docs, items = corpus(rng, vocabulary, 25, 80)
        assert found(spark, docs, items) == brute(docs, items)


def test_hostile_rows(spark):
    rng = random.Random(2)
    docs, items = corpus(rng, [f"w{i}" for i in range(50)], 12, 30)
    docs += [(None, None, "x", None), (None, items[3][1], None, "y"), (1, "", "x", "y"), (1, "?! --", "x", "y")]
    docs += [docs[4]] * 3 + [(900, " ".join(["w1"] * 50 + [items[5][1]] + ["w2"] * 70_000), "x", "y")]
    items += [(None, "null id words one two three four five six seven eight", None), (3, items[3][1], "x"), (77, items[3][1], "x"), (78, None, "x"), (79, "...", "x")]
    docs.append((901, "Null ID words one two three four five six seven eight, and more", "x", "y"))
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "one two", "x", "y"), (2, None, "x", "y")], [(1, "one", "x")]
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == brute(docs, [])
    assert found(spark, docs, [(5, None, "x")]) == brute(docs, [])


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    rng = random.Random(3)
    docs, items = corpus(rng, [f"w{i}" for i in range(100)], 30, 40)
    whole = contamination.bloom
    monkeypatch.setattr(contamination, "bloom", lambda hashes, n: whole(hashes, n, most=64))
    assert found(spark, docs, items) == brute(docs, items)


def test_filter_holds_what_it_got(spark):
    hashes = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 3000)
    filter_ = contamination.bloom(spark.createDataFrame([(int(h),) for h in hashes], "h long"), 3000)
    assert len(filter_.holds(hashes.view(np.uint64))) == 3000
    others = np.random.default_rng(5).integers(0, 2**63 - 1, 100_000).view(np.uint64)
    assert len(filter_.holds(others)) < 100


def test_a_popular_window_stays_linear(spark):
    """Copies of one document with a passage that many items share: one row of each hit, one list of items."""
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(i, passage, "x") for i in range(200)]
    docs = [(i, f"start {passage} end", "x", "y") for i in range(300)]
    assert found(spark, docs, items) == brute(docs[:1], items)[:0] + sorted([(i, *brute(docs[:1], items)[0][1:]) for i in range(300)], key=str)
