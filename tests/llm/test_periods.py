"""Periodic runs against a comparison of all words at all distances."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from riskframe.llm import periods, queries

SCHEMA = "doc_id long, text string, n_runs string"


def brute(words):
    """{(start, length): smallest period}: maximal stretches in which words q apart are equal."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((start, length, q) for (start, length), q in found.items())


def summary(words):
    found = sorted(brute(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    longest = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    most = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (len(found), *most, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)))


def sample(rng, n):
    kind = rng.randrange(6)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        root = [rng.choice("abc") for _ in range(rng.randint(1, 12))]
        words = (root * n)[:n]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(n)] = rng.choice("abcd")
        return words
    if kind == 2:
        return ["é"] * n
    if kind == 3:
        words = []
        while len(words) < n:
            words += [rng.choice("abcdef") for _ in range(rng.randint(1, 9))] * rng.randint(1, 7)
        return words[:n]
    if kind == 4:
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    root = [rng.choice("xyz") for _ in range(rng.randint(1, max(1, n // 4)))]
    return ([rng.choice("pq") for _ in range(n // 5)] + root * n)[:n]


def test_random_texts():
    rng = random.Random(5)
    for _ in range(150):
        texts = [sample(rng, rng.randint(1, 130)) if rng.random() < 0.95 else [] for _ in range(rng.randint(1, 12))]
        got = periods.group_runs([[w.encode() for w in t] for t in texts])
        for words, found in zip(texts, got, strict=True):
            assert sorted((s, n, q) for _, s, n, q in found.tolist()) == brute(words)


def test_wavelet_tree():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 500):
        values = rng.permutation(n)
        tree = periods.WaveletTree(values)
        low = rng.integers(0, n, 200)
        high = low + 1 + (rng.random(200) * (n - low)).astype(np.int64)
        x = rng.integers(0, n, 200)
        rank = (rng.random(200) * (high - low)).astype(np.int64)
        want = [(np.sum(values[a:b] < v), np.sort(values[a:b])[r]) for a, b, v, r in zip(low, high, x, rank, strict=True)]
        assert list(zip(tree.below(low, high, x), tree.select(low, high, rank), strict=True)) == want


def test_summaries_and_hostile_rows(spark):
    rng = random.Random(6)
    texts = [" ".join(sample(rng, rng.randint(1, 90))) for _ in range(60)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "a a a a a a", "x"), (3, texts[3], "x"), (3, texts[3], "x"), (70, None, "x"), (71, "", "x"), (72, " \t\n", "x"), (73, "b\x0bb\x1fb b b b b b b b", "x")]
    got = periods.summaries(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(i, *summary([w for w in (t or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w])) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert periods.summaries(spark.createDataFrame([], SCHEMA)).count() == 0


def test_collapse_keeps_columns(spark):
    rows = [(1, "go " + "ab cd " * 30 + "end", "x"), (2, "plain  text stays\nas it is", "y"), (None, None, "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = periods.collapse(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "go ab cd end", "x"), rows[1], rows[2]], key=str)


def test_very_long_text():
    """300,000 words: one period of a third of it, a short one inside, and noise."""
    rng = random.Random(7)
    root = [str(rng.randrange(5000)).encode() for _ in range(50_000)]
    root[1000:1040] = [b"x", b"y"] * 20
    words = [b"start"] * 5 + (root * 5)[:249_000] + [str(rng.randrange(5000)).encode() for _ in range(50_000)]
    (found,) = periods.group_runs([words])
    runs = {(s, n, q) for _, s, n, q in found.tolist()}
    assert (5, 249_000, 50_000) in runs
    assert {(5 + 1000 + k * 50_000, 40, 2) for k in range(5)} <= runs


def test_less_than_four_periods_is_refused():
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(9, np.int64), np.array([0]), np.array([9]), times=3)


def test_query_equals_brute_force(spark):
    """The registered query with its edit, on whole texts of the smallest table."""
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    changed = 0
    for key, text in docs:
        words = [w for w in (text or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
        h, n = zlib.crc32(str(key).encode()), len(words)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        if n < 1500 or h % 10 == 0 and n < 4000:
            assert got[key] == (key, *summary(words))
    assert len(got) == len(docs) and changed > 5
