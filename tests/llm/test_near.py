"""The near-dedup stage against exact Jaccard similarity of five-word shingles."""

import random
from collections import Counter

from riskframe.llm import near, simhash, substrings
from riskframe.llm.common import components, contracted
from riskframe.operators import graph
from riskframe.session import staged

SCHEMA = "doc_id long, text string, source string"


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def kept_ids(spark, rows, **settings):
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], SCHEMA)
    return Counter(r["doc_id"] for r in simhash.keep_one(docs, **settings).collect())


def block_edits(rng, n):
    """Pairs of texts at a similarity of 0.80 to 0.85, one block of words appended, cut off, or replaced."""
    word = lambda: f"w{rng.randrange(10**6)}"
    for k in range(n):
        base = [word() for _ in range(rng.randint(300, 450))]
        share, n = rng.uniform(0.80, 0.85), len(base) - 4
        if k % 3 == 0:
            other = base + [word() for _ in range(int(n / share - n))]
        elif k % 3 == 1:
            other = base[: len(base) - int(n * (1 - share))]
        else:
            cut = int(n * (1 - share) / (1 + share))
            other = base[: len(base) - cut] + [word() for _ in range(cut)]
        yield " ".join(base), " ".join(other)


def test_block_edits_are_found(spark):
    pairs = list(block_edits(random.Random(1), 150))
    assert all(0.8 <= jaccard(a, b) <= 0.86 for a, b in pairs)
    rows = [(2 * k + side, text) for k, pair in enumerate(pairs) for side, text in enumerate(pair)]
    assert kept_ids(spark, rows) == Counter(2 * k for k in range(150))


def test_only_verified_pairs_are_joined(spark):
    rng = random.Random(2)
    word = lambda: f"v{rng.randrange(10**6)}"
    rows = []
    for _ in range(40):  # short texts with one changed word: 0.52
        base = [word() for _ in range(20)]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join([*base[:10], word(), *base[11:]]))]
    line = " ".join(word() for _ in range(8))
    for _ in range(20):  # one line repeated many times around texts that have nothing else in common
        rows.append((len(rows), f"{line} " * 40 + " ".join(word() for _ in range(60))))
    rows += [(len(rows), "one two three"), (len(rows) + 1, "one two four")]
    assert kept_ids(spark, rows) == Counter(i for i, _ in rows)


def test_tiles_lose_no_pair(spark):
    """Chains and stars of copies, with groups of many tiles: the same components as all exact pairs."""
    rng = random.Random(3)
    word = lambda: f"t{rng.randrange(10**6)}"
    rows = []
    for _ in range(4):
        text = [word() for _ in range(150)]
        for _ in range(25):
            text = list(text)
            at = rng.randrange(130)
            text[at : at + rng.choice([6, 10, 14])] = [word() for _ in range(8)]
            rows.append((len(rows), " ".join(text)))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in rows:
        for b, t in rows[:a]:
            if jaccard(s, t) >= 0.8 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = Counter({find(a) for a, _ in rows})
    assert 4 < len(want) < 100
    for tile in (512, 3):
        assert kept_ids(spark, rows, tile=tile) == want


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, rows without id and shared ids, through near-dedup and substring dedup together."""
    rng = random.Random(4)
    a, b, c, d, e = (" ".join(f"r{rng.randrange(10**6)}" for _ in range(80)) for _ in range(5))
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (3, b, "x"), (5, b, "x"), (5, c, "x"), (None, d, "x"), (None, d, "x"), (None, c, "x"), (None, e, "x"), (7, f"{e} end", "x"), (8, "", "x"), (8, "", "x"), (9, None, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    want = Counter([(1, a), (3, b), (5, c), (None, d), (7, f"{e} end"), (8, ""), (8, ""), (9, None)])
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == want
    assert Counter((r["doc_id"], r["text"]) for r in substrings.deduplicate(kept).collect()) == want
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_simhash_links_are_candidates(spark):
    """Without MinHash bands, the pigeonring search of SimHash fingerprints alone finds long texts with a small edit."""
    rng = random.Random(6)
    texts = [" ".join(f"s{rng.randrange(10**6)}" for _ in range(3000)) for _ in range(8)]
    rows = [(2 * i + side, i, text + " end" * side) for i, text in enumerate(texts) for side in (0, 1)]
    sets = near.signatures(spark.createDataFrame(rows, "doc_id long, body long, text string")).cache()
    of = {r["content"]: r["doc_id"] for r in sets.collect()}
    found = {frozenset((of[r["a"]], of[r["b"]])) for r in near.linked(sets).collect()}
    assert found == {frozenset((2 * i, 2 * i + 1)) for i in range(8)}
    both = {frozenset((of[r["a"]], of[r["b"]])) for r in near.candidates(sets, near.THRESHOLD).collect()}
    assert found <= both


def test_links_are_contracted_before_the_rounds(spark):
    chain = spark.range(400, numPartitions=3).selectExpr("lpad(id + 1, 4, '0') a", "lpad(id, 4, '0') b")
    few = contracted(chain)
    assert few.filter("a <= b").isEmpty() and few.select("a").distinct().count() == few.count() == 400
    # A task holds at most so many links; what is left is joined by the rounds.
    for most in (2**18, 1):
        cut = components(contracted(chain, most)).collect()
        assert len(cut) == 401 and {r["component"] for r in cut} == {"0000"}
    assert components(chain.filter("a is null")).isEmpty()


def test_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "staged", lambda df, path: written.append(path) or staged(df, path))
    pairs = spark.range(1, 300).selectExpr("lpad(id, 4, '0') a", "lpad(id - 1, 4, '0') b").coalesce(1)
    assert components(pairs).filter("component = '0000'").count() == 300
    assert [path.rsplit("/", 1)[1] for path in written] == ["edges"]
