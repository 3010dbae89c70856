"""Quality, URL, language, mixing and packing operators: brute force, held-out accuracy, odd rows."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import language, mixing, packing, quality, urls

DATA = "/root/testdata/sf0.001"


def test_attention_gradient():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality.WIDTH)).astype(np.float32) for n in (1, 3, 2)]
    labels = np.array([1.0, 0.0, 1.0])
    model = quality.fit(bags, labels, epochs=1, hidden=5, gates=3)
    x, starts = np.concatenate(bags).astype(float), np.array([0, 1, 4])
    found = model.gradient(x, starts, labels)

    def loss():
        p = model.forward(x, starts)["score"]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, g in found.items():
        flat = model.weights[name] = np.array(model.weights[name], float)
        at = (0,) * flat.ndim
        flat[at] += 1e-5
        above = loss()
        flat[at] -= 2e-5
        below = loss()
        flat[at] += 1e-5
        assert abs((above - below) / 2e-5 - np.asarray(g)[at]) < 1e-6


def test_attention_finds_the_bad_passage():
    """One junk passage among clean ones decides the label; attention singles it out."""
    rng = random.Random(1)
    clean = lambda: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(quality.PASSAGE))
    junk = " ".join("#$%&"[rng.randrange(4)] * 3 for _ in range(quality.PASSAGE))
    texts, labels = [], []
    for k in range(300):
        parts = [clean() for _ in range(4)]
        if k % 2:
            parts[rng.randrange(4)] = junk
        texts.append(" ".join(parts).encode())
        labels.append(float(k % 2 == 0))
    bags = [quality.passages(t) for t in texts]
    model = quality.fit(bags[:200], np.array(labels[:200]))
    scores = model.scores(bags[200:])
    assert ((scores >= 0.5) == (np.array(labels[200:]) == 1)).mean() > 0.97


def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).withColumn("held", quality.held_out("doc_id"))
    rows = scored.join(labels, "doc_id").filter("held").select("score", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in rows]) > 0.95


def test_quality_odd_rows(spark):
    schema = "doc_id long, text string, score string, bag int"
    docs = spark.createDataFrame([(1, None, "a", 1), (2, "", "b", 2), (None, "some words", "c", 3), (1, None, "a", 1), (3, "x " * 50_000, "d", 4)], schema)
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (1, None, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    out = quality.keep_good(docs, labels, threshold=0.0)
    assert out.columns == docs.columns and out.count() == 5 and {r["score"] for r in out.collect()} == {"a", "b", "c", "d"}
    assert {r["s"] for r in quality.score(docs, None, score_col="s").collect()} == {0.5}
    empty = docs.limit(0)
    assert quality.train(empty, labels) is None and quality.score(empty, None).count() == 0
    held = docs.select("doc_id", quality.held_out("doc_id").alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in held)


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[: min([len(rest), *(rest.find(x) for x in "/?#" if x in rest)])])
    path = rest[len(host) :]
    path = path[: min([len(path), *(path.find(x) for x in "?#" if x in path)])]
    best = None
    for verdict, owner, start in urls.RULES:
        if (host == owner or host.endswith("." + owner)) and path.startswith(start) and (best is None or len(owner + start) > len(best[0])):
            best = owner + start, verdict
    return host, path, best


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en/", "http://a.b.example.com/en", "http://example.com",
    "ftp://x.NET/es/1", "https://net/fr/", "https://abcnet/fr/", "http://www.example.com/en/?q=1", "http://www.example.com?/en/", "http://u://v.com/p", "http://É.net/fr/é", "x://\n.com/\n",
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string, rule string")
    got = urls.judge(pages).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, best = brute_url(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0]), r
        assert r["verdict"] == (best[1] if best else "block" if r["score"] is not None and r["score"] >= 0 else "allow")
    assert urls.judge(pages.limit(0)).count() == 0


def test_markov_probabilities():
    """Blended estimates are distributions, and equal a direct recursion."""
    order = 2
    rng = np.random.default_rng(3)
    texts = [rng.integers(1, 4, 12) for _ in range(30)]
    total = np.bincount(np.concatenate([urls.grams(t, order) for t in texts]), minlength=urls.SYMBOLS ** (order + 1))
    p = np.exp(urls.log_likelihood(total, order)).reshape(-1, urls.SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1)
    counts = defaultdict(Counter)
    for t in texts:
        padded = [0] * order + t.tolist()
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[tuple(padded[i - k : i])][padded[i]] += 1

    def direct(context, s):
        shorter = direct(context[1:], s) if context else 1 / urls.SYMBOLS
        c = counts.get(tuple(context))
        return (c[s] + len(c) * shorter) / (c.total() + len(c)) if c else shorter

    for context in ([1, 2], [3, 3], [0, 1], [0, 0], [9, 1], [9, 9]):
        for s in (0, 1, 2, 3, 31):
            code = context[0] * urls.SYMBOLS + context[1]
            assert np.isclose(p[code, s], direct(context, s))


def test_url_model_tells_classes_apart(spark):
    rng = random.Random(4)
    good = [f"https://news.site{rng.randint(1, 99)}.org/story/{rng.randint(1, 999)}" for _ in range(400)]
    bad = [f"http://win-cash-{rng.randint(1, 99)}.biz/?aff={rng.randint(1, 999)}" for _ in range(400)]
    rows = spark.createDataFrame([(u, False) for u in good[:300]] + [(u, True) for u in bad[:300]], "url string, rejected boolean")
    model, threshold = urls.train(rows)
    assert np.mean([urls.mean_difference(u, model) < threshold for u in good[300:]]) > 0.98
    assert np.mean([urls.mean_difference(u, model) >= threshold for u in bad[300:]]) > 0.98
    assert urls.train(rows.filter("rejected"))[1] == np.inf


def test_language_text_and_evidence(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language.fit(docs.filter("doc_id % 2 = 0"))
    other = docs.filter("doc_id % 2 = 1")
    got = language.fuse(language.text_evidence(other, model, host=F.col("source")), model)
    rows = got.join(other.withColumnRenamed("lang", "true"), F.col("id") == F.col("doc_id")).select("lang", "true", "confidence").collect()
    assert np.mean([r["lang"] == r["true"] for r in rows]) > 0.97 and all(0 < r["confidence"] <= 1 for r in rows)


def test_language_fusion_by_hand(spark):
    """Posteriors equal a direct computation; null evidence counts as one; a row's own vote is left out."""
    model = language.TextModel(["aa", "bb"], np.zeros((language.SLOTS, 2), np.float32))
    rows = [(1, "x.site.de", "aa", [3.0, 0.0]), (2, "x.site.de", "bb", [2.0, 0.0]), (3, "y.site.de", None, [0.0, 4.0]), (4, None, None, [0.0, 0.0]), (5, "z.fr", "bb", [0.0, 1.0]), (6, "x.site.de", "aa", [0.0, 0.5]), (6, "x.site.de", "aa", [0.0, 0.5])]
    votes = [0 if v[0] > v[1] else 1 if v[1] > v[0] else None for *_, v in rows]
    everywhere = np.array([votes.count(0), votes.count(1)], float)
    overall = (everywhere + 1) / (everywhere + 1).sum()
    k = language.STRENGTH

    def tally(match, without=None):
        n = np.zeros(2)
        for r, v in zip(rows, votes, strict=True):
            if v is not None and match(r):
                n[v] += 1
        if without is not None:
            n[without] = max(0, n[without] - 1)
        return n

    want = Counter()
    for (key, host, declared, ll), vote in zip(rows, votes, strict=True):
        domain = host and ".".join(host.split(".")[-2:])
        d = tally(lambda r: r[1] and ".".join(r[1].split(".")[-2:]) == domain, vote) if host else np.zeros(2)
        h = tally(lambda r: r[1] == host, vote) if host else np.zeros(2)
        up = (d + k * overall) / (d.sum() + k)
        total = np.array(ll) + np.log((h + k * up) / (h.sum() + k))
        for sign, of in ((declared, lambda r: r[2]), (host and host.split(".")[-1], lambda r: r[1] and r[1].split(".")[-1])):
            c = tally(lambda r: of(r) == sign) if sign else np.zeros(2)
            if c.sum():
                share = c.sum() / everywhere.sum()
                total += np.log((c + k * share) / (everywhere + k))
        p = np.exp(total - total.max())
        want[key, model.languages[int(total.argmax())], round(float(p.max() / p.sum()), 9)] += 1
    evidence = spark.createDataFrame(rows, "id long, host string, declared string, likelihood array<double>")
    assert Counter((r["id"], r["lang"], round(r["confidence"], 9)) for r in language.fuse(evidence, model).collect()) == want


def test_language_odd_rows(spark):
    docs = spark.createDataFrame([(1, "ein haus und ein baum", "de", "s"), (2, None, "de", "s"), (3, "a house and a tree", "en", None), (None, "", None, None)], "doc_id long, text string, lang string, source string")
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    pages = spark.createDataFrame([(1, None, None, "q"), (2, "http://a.de/", "<html lang='DE-at'><p>haus und baum", "q"), (2, "x", "", "q"), (None, "http://b.com", "<p>house and tree", "q")], "page_id long, url string, html string, lang string")
    got = language.fuse(language.page_evidence(pages, model), model).collect()
    assert len(got) == 4 and all(r["lang"] in ("de", "en") for r in got)
    assert {(r["declared"], r["lang"]) for r in got if r["declared"]} == {("de", "de")}
    none = language.fit(docs.limit(0))
    assert none.languages == [] and language.fuse(language.page_evidence(pages, none), none).filter("lang is null").count() == 4
    assert language.fuse(language.text_evidence(docs.limit(0), model), model).count() == 0


def brute_targets(sizes):
    """Exact sharing round by round: what is cut is shared again among those below."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    stopped, total = {}, Fraction(3, 2) * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            return stopped | share
        stopped |= {s: Fraction(2 * sizes[s]) for s in above}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_mixing_targets_and_totals(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "é", "z", None, ""]
    rows = [(i, "w " * int(rng.lognormvariate(3, 1)), rng.choice(names[: 5 + seed])) for i in range(400)]
    rows += [(None, "n n n", "a"), (7, rows[7][1], rows[7][2]), (8, None, "b"), (9, "", "only empty"), (10, "x " * 3000, "c")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, times int, key string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    taken, own, largest = Counter(), Counter(), Counter()
    for r in got:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["source_size"] == sizes[r["source"]] and np.isclose(r["target"], float(want[r["source"]]), rtol=1e-9)
        assert r["taken"] == r["times"] * r["size"] and 0 <= r["times"] <= 2
        taken[r["source"]] += r["taken"]
        own[r["doc_id"], r["source"], r["key"], r["times"]] += 1
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= largest[s] / 2, (s, taken[s], want[s])
    assert sum(abs(taken[s] - float(want[s])) <= max(5, 0.01 * float(want[s])) for s in sizes if s != "c") == len(sizes) - 1
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r["times"] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_mixing_draws_evenly(spark):
    """Over many seeds each document is drawn about as often as its source's ratio says."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), "a" if i < 40 else "b") for i in range(80)], "doc_id long, text string, source string")
    times = Counter()
    for seed in range(12):
        for r in mixing.mix(docs, seed=str(seed), weights=(3, 1), share=1.2, bins=16).collect():
            times[r["doc_id"]] += r["times"]
    assert 12 <= min(times[i] for i in range(40)) and max(times[i] for i in range(40)) <= 24
    assert len({times[i] for i in range(40, 80)}) > 2


TEXTS = ["", " a", "a ", "a  b", "a\n b", "x\n  y", "é　日本 語", "don't  <|endoftext|> x", "\x1c a\x1cb", "it's 123abc!!   z", "a\u200bb c", "Ǆǅ ʼn ﬀ", "\n\n a \t b  ", "a\u2003 b \xa0c", "😀 😀x", "I'll we've'd ''s"]


def test_encoder_equals_the_tokenizer(spark):
    from tokenizers import Tokenizer

    files = packing.default_files()
    plain, encoder = Tokenizer.from_file(files["tokenizer"]), packing.Encoder(**files, cache=50)
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def best_fit(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        room = [f for f in free if f >= n]
        if room:
            free.remove(min(room))
        free.append((min(room) if room else capacity) - n)
    return len(free)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_tight(seed):
    rng = random.Random(seed)
    draw = [lambda: rng.randint(1, 1024), lambda: rng.randint(340, 520), lambda: min(1024, int(rng.lognormvariate(6, 0.8)) + 1), lambda: rng.choice([300, 400, 513]), lambda: rng.randint(1, 30), lambda: 342][seed]
    lengths = [draw() for _ in range(1500)]
    bins = packing.plan(Counter(lengths))
    assert all(sum(c) <= 1024 and n > 0 for c, n in bins)
    assert Counter(k for c, n in bins for k in c for _ in range(n)) == Counter(lengths)
    assert sum(n for _, n in bins) <= 1.02 * best_fit(lengths, 1024) + 1
    assert packing.plan({}) == []


def test_packed_documents_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "null id"), (3, TEXTS[3]), (60, "long text " * 3000), (61, "y " * 1023), (62, "y " * 1022)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, length int, offset int")
    packed = packing.pack_documents(docs, buckets=3)
    got = packed.collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_files()["tokenizer"])
    want = Counter((i, tuple([*plain.encode(t or "", add_special_tokens=False).ids, packing.END])) for i, t in rows)
    parts = defaultdict(list)
    for r in got:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert r["length"] == 1024 or r["piece"] == 0
        parts[r["doc_id"], r["piece"]].append(r)
    whole = Counter()
    for i, t in rows:
        n = len(want) and next(len(ids) for (k, ids) in want if k == i)
        ids = [x for p in range(-(-n // 1024)) for x in parts[i, p][0]["ids"]]
        whole[i, tuple(ids)] += 1
    assert whole == want and len(got) == sum(-(-len(ids) // 1024) * n for (_, ids), n in want.items())
    at = defaultdict(list)
    for r in got:
        at[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
    for found in at.values():
        end = 0
        for offset, length, _ in sorted(found):
            assert offset == end
            end += length
        assert end <= 1024
    sequences = {r["sequence_id"]: list(r["ids"]) for r in packing.sequences(packed).collect()}
    assert sequences == {k: [x for _, _, ids in sorted(v) for x in ids] for k, v in at.items()}
    assert packing.pack_documents(docs.limit(0)).count() == 0
