"""Vector codes against a plain Lloyd iteration in Python integers."""

import hashlib
import math
import random
from collections import defaultdict

from riskframe.llm import codebooks

SCHEMA = "vec_id long, embedding array<float>, label int, code string"
INPUT = "vec_id long, embedding array<double>, label int"


def brute(rows, parts, entries, rounds):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    whole = []
    for i, v, label in kept:
        x = [max(-codebooks.LIMIT, min(codebooks.LIMIT, math.floor(256 * c))) for c in v]
        x += [0] * (parts * width - len(x))
        whole.append((i, [x[p * width : (p + 1) * width] for p in range(parts)], label))
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[list(r[1][p]) for r in first] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, x, _ in whole:
                members[near(x[p], books[p])[1]].append(x[p])
            for k, own in members.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    coded = []
    for i, x, label in whole:
        found = [near(x[p], books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    by_label = defaultdict(int)
    for *_, error, label in coded:
        by_label[label] += error
    return sorted(((i, code, error, by_label[label], sha) for i, code, error, label in coded), key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(16)], rng.choice([1, 2, None])) for i in rng.sample(range(10**6), 400)]
    same = [0.25] * 16
    rows += [(10**6 + i, same, 3) for i in range(300)]  # a vector that many rows share
    rows += [rows[0]] * 5 + [(None, [0.1] * 16, None), (None, [0.2] * 16, 1)]
    rows += [(-5, None, 1), (-4, [0.1] * 15 + [None], 1), (-3, [math.nan] * 16, 1), (-2, [math.inf] + [0.0] * 15, 1)]
    rng.shuffle(rows)
    got = codebooks.compress(spark.createDataFrame(rows, INPUT), parts=4, entries=8, rounds=3)
    assert rows_of(got) == brute(rows, 4, 8, 3)


def test_few_short_and_huge_vectors(spark):
    rows = [(1, [0.5, -0.25, 0.1], 1), (2, [], 1), (3, [1e300, -1e300, 1.0, 2.0, 3.0], None)]
    assert rows_of(codebooks.compress(spark.createDataFrame(rows, INPUT), parts=2)) == brute(rows, 2, 64, 2)


def test_no_usable_rows_and_clashing_names(spark):
    rows = [(1, None, 2), (2, [math.nan], 2)]
    assert codebooks.compress(spark.createDataFrame(rows, INPUT)).count() == 0
    assert codebooks.compress(spark.createDataFrame([], INPUT)).count() == 0
    rows = [(i, [i / 50] * 4, i % 3, "x") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("code", "error")
    assert rows_of(codebooks.compress(df, parts=2, entries=4)) == brute([(i, v, lab) for i, v, lab, _ in rows], 2, 4, 2)


def test_only_movers_are_dealt_anew(spark):
    """Owners hold about OWNED members at most, and stayers keep their file."""
    rng = random.Random(2)
    df = spark.createDataFrame([(i, [rng.random() for _ in range(8)], 0) for i in range(500)], INPUT)
    rows = codebooks.integers(df, "embedding")
    books = codebooks.train(df, parts=2, entries=4, rounds=1)
    members = codebooks._members(rows, books, 3)
    assert {r["salt"] for r in members.collect()} == {0, 1, 2}
    moved = codebooks._sums(members, books)
    after = codebooks._migrate(members, moved)
    assert after.agg({"weight": "sum"}).first()[0] == 2 * 500
    assert (codebooks._sums(after, moved) == codebooks._sums(codebooks._members(rows, moved, 1), moved)).all()
