"""Benchmark passages in documents, by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of a benchmark item, or the whole item if it is shorter. As a set of
shingles (``SHINGLE`` words, or the whole window if it is shorter) it can only occur where all its shingles do, so
its necessary prefix is one shingle, the one that is rarest in the documents. Windows meet documents by that
shingle only. Where the two meet, the window's place follows from the shingle's place in it: windows that would
start before the document or end after it are dropped by length and position, and of the rest the words of the
item-sized stretch are compared with the window's, one by one.

A Bloom filter of the shingles in question keeps the other shingles of the documents from ever becoming rows. It
is what tasks get of the benchmark, and has ``membership.BITS`` bits at most, however large the benchmark is; a fuller filter
lets more rows through, and the join decides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, mix64, stage, text_bytes
from riskframe.llm.membership import Filter, bloom
from riskframe.llm.substrings import WordHashes, rolling
from riskframe.operators.skew import splittable

WINDOW, SHINGLE = 10, 5

#: What is no word: ASCII outside 0-9, A-Z and a-z; A-Z become a-z.
_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Shingles:
    """Hashes of runs of words."""

    def __init__(self) -> None:
        self.hashes = WordHashes()

    def words(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.hashes.__getitem__, parts), np.uint64, len(parts))

    def together(self, texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words of many texts, each followed by a bar; their hashes, and the places of the bars.

        A bar is no word, so a run of words that holds one is no shingle of any item.
        """
        parts = b" | ".join([*[(t or b"").translate(_FOLD) for t in texts], b""]).split()
        words = self.words(parts)
        return parts, words, np.flatnonzero(words == np.uint64(self.hashes[b"|"]))

    @staticmethod
    def of(words: np.ndarray, size: int) -> np.ndarray:
        return mix64(rolling(words, size) + np.uint64(size))


_WINDOWS = "item_id string, name binary, words array<string>"
_SHINGLES = "name binary, at int, shingle long"


def windows(items: DataFrame, *, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, name, words): the distinct windows of every item; ``name`` is a hash of the words."""

    def run(batches: Batches) -> Batches:
        schema = pa.schema([("item_id", pa.string()), ("name", pa.binary()), ("words", pa.list_(pa.string()))])
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = [w.decode() for w in split_words(text)]
                size = min(window, len(words))
                found = {tuple(words[i : i + size]) for i in range(len(words) - size + 1) if size}
                rows += [(key, xxhash.xxh3_128_digest(" ".join(w).encode()), w) for w in sorted(found)]
            if rows:
                yield batch(schema, zip(*rows, strict=True))

    named = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return named.mapInArrow(run, _WINDOWS).distinct()


def _window_shingles(distinct: DataFrame, shingle: int) -> DataFrame:
    """(name, at, shingle) of windows (name, words); the shingle as a hash."""

    def run(batches: Batches) -> Batches:
        own = Shingles()
        for b in batches:
            rows = []
            for name, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = own.of(own.words([w.encode() for w in words]), min(shingle, len(words)))
                rows += [(name, at, h) for at, h in enumerate(found.view(np.int64).tolist())]
            if rows:
                yield batch(arrow_type(_SHINGLES), zip(*rows, strict=True))

    return distinct.select("name", "words").mapInArrow(run, _SHINGLES)


def _counts(docs: DataFrame, known: Filter, sizes: list[int]) -> DataFrame:
    """(shingle, n): occurrences in all documents of the shingles that the filter holds."""

    def run(batches: Batches) -> Batches:
        own, total = Shingles(), {}
        for b in batches:
            for at in range(0, b.num_rows, 256):
                _, words, _ = own.together(text_bytes(b.column(0)[at : at + 256]))
                for size in sizes:
                    found = own.of(words, size)
                    for h in found[known.holds(found)].view(np.int64).tolist():
                        total[h] = total.get(h, 0) + 1
                if len(total) > 200_000:
                    yield batch(arrow_type("shingle long, n long"), (total.keys(), total.values()))
                    total = {}
        yield batch(arrow_type("shingle long, n long"), (total.keys(), total.values()))

    return docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


_SCANNED = "doc_id long, n_words long, name binary, hits array<struct<shingle: long, place: int, before: int, near: array<string>>>"


def _scan(docs: DataFrame, prefixes: Filter, sizes: list[int], window: int) -> DataFrame:
    """Each document with its number of words and the places of prefix shingles, with as many words around as a window needs.

    ``name`` is a hash of the words, null where nothing was found; documents with equal words have equal hits.
    """
    hit = pa.struct([("shingle", pa.int64()), ("place", pa.int32()), ("before", pa.int32()), ("near", pa.list_(pa.string()))])
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("name", pa.binary()), ("hits", pa.list_(hit))])

    def run(batches: Batches) -> Batches:
        own = Shingles()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                keys = b.column(0)[at : at + 256]
                parts, words, ends = own.together(text_bytes(b.column(1)[at : at + 256]))
                starts = np.concatenate(([0], ends[:-1] + 1))
                hits: list[list[dict]] = [[] for _ in range(len(keys))]
                for size in sizes:
                    found = own.of(words, size)
                    held = prefixes.holds(found)
                    text = np.searchsorted(ends, held)
                    for place, t in zip(held.tolist(), text.tolist(), strict=True):
                        start, end = int(starts[t]), int(ends[t])
                        if place + size <= end:
                            first = max(start, place - window + size)
                            near = [w.decode() for w in parts[first : min(end, place + window)]]
                            hits[t].append({"shingle": int(found[place].view(np.int64)), "place": place - start, "before": place - first, "near": near})
                names = [xxhash.xxh3_128_digest(b" ".join(parts[s:e])) if h else None for s, e, h in zip(starts.tolist(), ends.tolist(), hits, strict=True)]
                yield batch(out, (keys, ends - starts, names, hits))

    return docs.select("doc_id", "text").mapInArrow(run, _SCANNED)


def _digest(lists: Column) -> Column:
    """(n_items, items_sha256) of several lists of ids."""
    ids = F.array_sort(F.array_distinct(F.flatten(lists)))
    return F.struct(F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"))


def occurrences(scanned: DataFrame, placed: DataFrame) -> DataFrame:
    """(name, window, start, size): where windows stand in the documents' distinct word sequences.

    ``placed`` has rows (shingle, window, at, words), one for each window: its prefix and the place of it.
    """
    hits = scanned.filter("name is not null").select("name", F.size("hits").alias("_n"), F.explode("hits").alias("hit"))
    hits = hits.select("name", "hit.*").dropDuplicates(["name", "shingle", "place"])
    met = hits.join(splittable(placed), "shingle")
    start, size = F.col("place") - F.col("at"), F.size("words")
    inside = F.col("before") - F.col("at")  # the window's place among the words around
    bounded = met.filter((start >= 0) & (inside >= 0) & (inside + size <= F.size("near")))
    same = F.slice("near", inside + 1, size) == F.col("words")
    return bounded.filter(same).select("name", "window", start.alias("start"), size.alias("size"))


def contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each row of ``docs``.

    Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters; a null text has none. ``n_hit``
    counts words inside any occurrence of a window, ``n_items`` the items with occurring windows;
    ``items_sha256`` is of their ids, sorted as text and joined by commas (none: of the empty text). Items without
    words have no window. Repeated or equal items share their windows, ids count once, a null id does not count as an
    item, but its windows hit. Documents with equal words have equal results. Other columns are not read.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    owned = stage(windows(items, id_col=item_id_col, text_col=item_text_col, window=window), "windows")
    distinct = owned.dropDuplicates(["name"]).select("name", "words")
    parts = stage(_window_shingles(distinct, shingle), "shingles")
    seen = parts.select("shingle").distinct()
    # Short items have shingles of their own length: at most ``shingle`` lengths in all.
    sizes = sorted(r[0] for r in owned.select(F.least(F.size("words"), F.lit(shingle))).distinct().collect())
    known = bloom(seen, seen.count())
    counts = _counts(narrow, known, sizes)
    rarity = parts.join(counts, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    prefix = rarity.groupBy("name").agg(F.min(F.struct("n", "shingle", "at")).alias("rarest")).filter("rarest.n > 0")
    prefix = prefix.select(F.col("name").alias("window"), "rarest.shingle", "rarest.at")
    placed = stage(prefix.join(distinct.withColumnRenamed("name", "window"), "window"), "prefixes")
    wanted = placed.select("shingle").distinct()
    scanned = stage(_scan(narrow, bloom(wanted, wanted.count()), sizes, window), "scanned")
    found = stage(occurrences(scanned, placed), "occurrences")

    # Windows of the same items form one list; a text's items depend on its set of lists alone.
    lists = owned.groupBy(F.col("name").alias("window")).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    lists = lists.select("window", F.md5(F.to_json("ids")).alias("list"), "ids")
    used = stage(lists.join(found.select("window").distinct(), "window", "left_semi"), "lists")
    per_text = found.select("name", "window").distinct().join(splittable(used.select("window", "list")), "window")
    per_text = per_text.groupBy("name").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    combos = per_text.groupBy("lists").agg(F.count(F.lit(1)).alias("_n")).select("lists", F.explode("lists").alias("list"))
    named = used.groupBy("list").agg(F.first("ids").alias("ids"))
    named = combos.join(splittable(named), "list").groupBy("lists").agg(_digest(F.collect_list("ids")).alias("items"))
    per_text = per_text.join(splittable(named), "lists").select("name", "items.*")

    reach = found.groupBy("name", "start").agg(F.max("size").alias("size")).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("spans"))
    # Spans in order: each adds what lies beyond the furthest end before it.
    end = lambda s: s["start"] + s["size"]
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), end(s) - F.greatest(acc["end"], s["start"]))).alias("n"), F.greatest(acc["end"], end(s)).alias("end"))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"].cast("long"))
    results = per_text.join(reach.select("name", covered.alias("n_hit")), "name")
    plain = hashlib.sha256(b"").hexdigest()
    joined = scanned.select("doc_id", "n_words", "name").join(splittable(results), "name", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.lit(plain)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
