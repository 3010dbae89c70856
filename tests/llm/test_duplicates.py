"""SimHash, substring and MinHash duplicates against brute force, with odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from riskframe.llm import fingerprints, simhash, substrings

SCHEMA = "doc_id long, text string, doc string, marks int, fingerprint string"


def table(spark, rows):
    """Rows (doc_id, text) beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)


def corpus(seed, n=60):
    """Random texts with shared passages, near copies and copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = passage[rng.randint(0, 10) : rng.randint(40, 60)]
        if i % 7 == 0 and rows:
            text = rows[rng.randrange(len(rows))][1].split()
            if text and i % 2:
                text[rng.randrange(len(text))] = "edited"
        rows.append((i, " ".join(text)))
    return [*rows, (1000, None), (1001, ""), (1002, " \n\t"), (None, "a b c"), (5, rows[5][1]), (1003, "la " * 90)]


def brute_windows(texts, window):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("block", [substrings.BLOCK, 1])
def test_repeats_equal_brute_force(spark, block):
    rows = corpus(3)
    got = substrings.remove_repeats(table(spark, rows), block=block).collect()
    joined = Counter((r["doc_id"], r["n_words"], r["n_removed"], " ".join((r["kept"] or "").split())) for r in got)
    want = brute_windows([t for _, t in rows], substrings.WINDOW)
    assert joined == Counter((i, n, k, kept.decode()) for (i, _), (n, k, kept) in zip(rows, want, strict=True))
    assert sum(r["n_removed"] for r in got) > 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=6), st.integers(4, 9))
def test_block_factors_equal_brute_force(lists, window):
    """The parse of a block marks exactly the windows that also start elsewhere in it."""
    pieces = [np.array(p, np.uint64) for p in lists if len(p) >= window]
    if not pieces:
        return
    index = substrings.Block(pieces, np.ones(len(pieces), np.int64))
    seen = Counter(tuple(p[i : i + window].tolist()) for p in pieces for i in range(len(p) - window + 1))
    for k, p in enumerate(pieces):
        want = [seen[tuple(p[i : i + window].tolist())] > 1 for i in range(len(p) - window + 1)]
        assert index.factor(k, len(p), window).tolist() == want


def test_rolling_depends_on_the_window_only():
    words = np.random.default_rng(1).integers(0, 5, 400).astype(np.uint64)
    for size in (1, 2, 3, 12, 35):
        found = substrings.rolling(words, size)
        by_window = {}
        for i, h in enumerate(found.tolist()):
            assert by_window.setdefault(tuple(words[i : i + size].tolist()), h) == h
        assert len(set(by_window.values())) == len(by_window)


def test_deduplicate_keeps_rows_and_columns(spark):
    docs = table(spark, corpus(4))
    out = substrings.deduplicate(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    empty = spark.createDataFrame([], SCHEMA)
    assert substrings.deduplicate(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0


def brute_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots(ids, prints, most):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most:
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash_equals_brute_force(spark):
    rows = corpus(5, 200)
    got = simhash.near_duplicates(table(spark, rows)).collect()
    prints = [brute_print(t) for _, t in rows]
    want = Counter(zip([i for i, _ in rows], [f"{p:016x}" for p in prints], roots([i for i, _ in rows], prints, 2), strict=True))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(("bits", "most", "segments", "tile"), [(64, 2, 16, 4096), (64, 3, 8, 5), (128, 16, 17, 8), (64, 0, 4, 4096)])
def test_links_connect_what_brute_force_connects(spark, bits, most, segments, tile):
    rng = random.Random(bits + most)
    centres = [rng.getrandbits(bits) for _ in range(12)]
    prints = set(centres)
    for c in centres:
        for _ in range(20):
            x = c
            for _ in range(rng.randint(0, most + 2)):
                x ^= 1 << rng.randrange(bits)
            prints.add(x)
    prints = sorted(prints)
    names = [f"{p:0{bits // 4}x}" for p in prints]
    found = simhash.links(spark.createDataFrame([(n,) for n in names], "fingerprint string"), bits=bits, max_diff=most, segments=segments, tile=tile).collect()
    assert all((int(r["a"], 16) ^ int(r["b"], 16)).bit_count() <= most for r in found)
    root = {n: n for n in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        root[find(r["a"])] = find(r["b"])
    want = roots(names, prints, most)
    groups = lambda labels: Counter(frozenset(n for n, y in zip(names, labels, strict=True) if y == x) for x in labels)
    assert groups([find(n) for n in names]) == groups(want)


def test_keep_one_leaves_one_of_each_group(spark):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(2000)]
    rows, groups = [], []
    for g in range(12):
        base = [rng.choice(words) for _ in range(200)]
        groups.append(range(len(rows), len(rows) + 5))
        for _ in range(5):
            copy = list(base)
            for at in rng.sample(range(200), 2):
                copy[at] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(500, None), (501, ""), (502, ""), (None, "alone here")]
    docs = table(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert [sum(ids[i] for i in g) for g in groups] == [1] * 12
    assert ids[500] == ids[501] == ids[502] == ids[None] == 1


def test_edited_fingerprints(spark):
    rows = [*corpus(6), (7, "déjà vu ü" * 30), (-3, "x")]
    for ranges in (1, 7, 40):
        got = fingerprints.edited_fingerprints(table(spark, rows), ranges=ranges).collect()
        order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), (r[1] or "").encode()))
        want = Counter()
        for k, (key, text) in enumerate(order):
            own, after = text or "", order[(k + 1) % len(order)][1] or ""
            half = len(own) // 2
            want[key, len(own), hashlib.sha256((own[: len(own) - half] + after[:half]).encode()).hexdigest()] += 1
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    prints = {}
    for r in got:
        prints.setdefault(r["doc_id"], r["fingerprint"])
    assert prints[1000] == prints[1001] and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprints.edited_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    one = fingerprints.edited_fingerprints(table(spark, [(1, "abcd")])).collect()
    assert [(r["n_chars"], r["near_next"]) for r in one] == [(4, 1.0)]


def test_minhash_estimates_jaccard_and_pairs_are_whole(spark):
    rng = random.Random(2)
    words = [f"u{i}" for i in range(5000)]
    rows = []
    for g in range(15):
        base = [rng.choice(words) for _ in range(150)]
        for edits in (0, 1, 3, 6):
            copy = list(base)
            for at in rng.sample(range(150), edits):
                copy[at] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, rows[0][1]), (901, None), (None, rows[1][1])]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(146)} for i, t in rows if t and i is not None}
    likeness = lambda a, b: len(a & b) / len(a | b)
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] != sets[b] and likeness(sets[a], sets[b]) >= 0.8}
    docs = table(spark, rows)
    got = {(r["a"], r["b"]): r["jaccard"] for r in fingerprints.near_pairs(docs, tile=8).collect()}
    assert set(got) <= {p for p in want if 900 not in p} and len(got) >= 0.95 * len({p for p in want if 900 not in p})
    assert all(abs(j - likeness(sets[a], sets[b])) < 1e-9 for (a, b), j in got.items())
    assert {r["doc_id"]: r["class_id"] for r in fingerprints.classes(docs).collect()}[900] == 0
    prints = {r["doc_id"]: np.frombuffer(bytes.fromhex(r["fingerprint"]), ">u2") for r in fingerprints.fingerprints(docs).collect()}
    errors = [abs(fingerprints.likeness(prints[a], prints[b]) - likeness(sets[a], sets[b])) for a in range(0, 60, 4) for b in (a + 1, a + 2, a + 3)]
    assert np.mean(errors) < 0.05
