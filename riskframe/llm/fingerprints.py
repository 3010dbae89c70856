"""MinHash fingerprints of documents, their likeness, and near-duplicate pairs by signature bands.

A text is the set of its five-word shingles (A-Z in lower case); a shorter text is one shingle, an empty
text has none. Each of ``SIZE`` multiplicative hash functions orders the shingles anew; the signature keeps
the low 16 bits of the least value of each, so the share of equal values estimates the Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, mix64, runs, sorted_groups, stage
from riskframe.llm.substrings import WordHashes, rolling

SIZE = 128
WORDS = 5
_MULTIPLY = mix64(np.arange(1, SIZE + 1)) | np.uint64(1)
_ADD = mix64(np.arange(1001, SIZE + 1001))


def shingles(text: str | None, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """64-bit hashes of the text's shingles, repeats included."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    found = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    return mix64(rolling(found, min(words, len(parts))) + np.uint64(min(words, len(parts))))


def signature(found: np.ndarray) -> np.ndarray:
    """Low 16 bits of the least value of every hash function; all ones for no shingle.

    The high bits of a least value shrink with the number of shingles and would agree in unrelated long texts.
    """
    least = np.full(SIZE, 2**64 - 1, np.uint64)
    for at in range(0, len(found), 512):
        least = np.minimum(least, (_MULTIPLY[:, None] * found[None, at : at + 512] + _ADD[:, None]).min(axis=1))
    return (least & np.uint64(0xFFFF)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) with the signature as hex, one row for each row of ``docs``; a null text is empty."""
    schema = "doc_id long, fingerprint string"

    def run(batches: Batches) -> Batches:
        hashes, out = WordHashes(), arrow_type(schema)
        for b in batches:
            prints = [signature(shingles(t, hashes)).tobytes().hex() for t in b.column(1).to_pylist()]
            yield batch(out, (b.column(0), prints))

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _place(key: Column, borders: list[int], low: int = 0) -> Column:
    """Number of borders below ``key``, as a balanced tree of comparisons."""
    if not borders:
        return F.lit(low)
    middle = len(borders) // 2
    above = _place(key, borders[middle + 1 :], low + middle + 1)
    return F.when(key <= F.lit(borders[middle]), _place(key, borders[:middle], low)).otherwise(above)


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness to each other and to the next text.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many, or all, of the
    next document in descending id order; after the last comes the first. A null text is empty, a null id is
    the smallest, equal ids are ordered by text; a single document follows itself.

    Ids are cut at quantiles into ``ranges``; a document whose id is a border is also sent to the range above
    it, so each range knows its last document's successor and the texts are shuffled once.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)).cast("long"))
    narrow = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranges = ranges or min(2000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [(i + 1) / ranges for i in range(ranges)]
    cuts = narrow.agg(F.percentile_approx("key", shares, 10 * ranges).alias("cuts"), F.max("key").alias("top")).first()
    if cuts["top"] is None:
        return spark.createDataFrame([], _EDITED)
    top = cuts["top"]
    borders = sorted(set(cuts["cuts"]) - {top})
    place = F.struct(_place(F.col("key"), borders).alias("range"), F.lit(False).alias("guest"))
    above = F.when(F.col("key").isin(borders) if len(borders) < 10 else F.array_contains(F.lit(borders).cast("array<long>"), F.col("key")), F.struct((place["range"] + 1).alias("range"), F.lit(True).alias("guest")))
    after = F.when(F.col("key") == top, F.struct(F.lit(0).alias("range"), F.lit(True).alias("guest")))
    dealt = narrow.withColumn("at", F.explode(F.filter(F.array(place, above, after), lambda x: x.isNotNull())))
    dealt = dealt.select(
        F.col("at.range").cast("int").alias("range"),
        # The top document, as guest of the lowest range, comes after all others.
        F.when(F.col("at.guest") & (F.col("key") == top), F.lit(None)).otherwise(F.col("key")).alias("key"),
        F.col("at.guest").alias("guest"),
        "doc_id",
        "text",
    )
    ordered = dealt.repartition("range").sortWithinPartitions("range", F.desc_nulls_last("key"), "text", "guest")
    return ordered.select("range", "guest", "doc_id", "text").mapInArrow(_edit, _EDITED)


def _edit(batches: Batches) -> Batches:
    hashes, out = WordHashes(), arrow_type(_EDITED)
    before = None
    for b in batches:
        for at in range(0, b.num_rows, 256):
            rows = []
            for part, guest, key, text in zip(*(b.column(i)[at : at + 256].to_pylist() for i in range(4)), strict=True):
                mine = signature(shingles(text, hashes))
                if before and before[0] == part and not before[1]:
                    _, _, owner, own, print_ = before
                    half = len(own) // 2
                    edited = own[: len(own) - half] + text[:half]
                    changed = signature(shingles(edited, hashes))
                    digest = hashlib.sha256(edited.encode()).hexdigest()
                    rows.append((owner, len(own), digest, print_.tobytes().hex(), changed.tobytes().hex(), likeness(print_, changed), likeness(print_, mine)))
                before = (part, guest, key, text, mine)
            if rows:
                yield batch(out, zip(*rows, strict=True))


def near_pairs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, bands: int = 32, tile: int = 2048) -> DataFrame:
    """(a, b, jaccard): pairs of distinct shingle sets whose Jaccard similarity reaches ``threshold``.

    A set is named by the least doc_id that has it; see ``classes`` for the members. Signatures that agree in
    one of ``bands`` bands meet; estimates well below the threshold are dropped, the others are verified on the
    shingles themselves. Bands of more than ``tile`` signatures are compared tile by tile. Rows with a null id
    or without shingles take no part.
    """
    members = stage(_members(docs, id_col, text_col), "minhash")
    sets = members.filter("least").select("doc_id", "fingerprint")
    width = 4 * (SIZE // bands)
    keyed = sets.select(
        "doc_id",
        "fingerprint",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.substring(F.col("fingerprint"), i * width + 1, F.lit(width)))).alias("band", "part"),
    )
    keyed = keyed.select(F.xxhash64("band", "part").alias("key"), "doc_id", "fingerprint")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = keyed.join(sizes, "key").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    shared = shared.withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int"))
    units = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    units = units.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"), "doc_id", "fingerprint")

    def compare(tables: Iterator[pa.Table]) -> Batches:
        out = arrow_type("a long, b long")
        for t in tables:
            ids = t.column("doc_id").to_numpy()
            prints = np.frombuffer(bytes.fromhex("".join(t.column("fingerprint").to_pylist())), ">u2").reshape(-1, SIZE)
            found = []
            for s, e in zip(*(x.tolist() for x in runs(t.column("unit").to_numpy())), strict=True):
                for i in range(s, e - 1):
                    alike = (prints[i + 1 : e] == prints[i]).mean(axis=1) >= threshold - 0.15
                    found += [(min(ids[i], j), max(ids[i], j)) for j in ids[i + 1 : e][alike].tolist() if j != ids[i]]
            if found:
                yield batch(out, zip(*found, strict=True))

    pairs = sorted_groups(units, "unit", compare, "a long, b long").distinct()
    sets = members.filter("least").select("doc_id", "shingles")
    both = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    common = F.size(F.array_intersect("left", "right"))
    both = both.withColumn("jaccard", common / (F.size("left") + F.size("right") - common))
    return both.filter(F.col("jaccard") >= threshold).select("a", "b", "jaccard")


def _members(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, class_id, least, fingerprint, shingles): equal shingle sets share the class of their least id."""
    schema = "doc_id long, fingerprint string, content string, shingles array<long>"

    def run(batches: Batches) -> Batches:
        hashes, out = WordHashes(), arrow_type(schema)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows = []
                for key, text in zip(b.column(0)[at : at + 256].to_pylist(), b.column(1)[at : at + 256].to_pylist(), strict=True):
                    found = np.unique(shingles(text, hashes))
                    if len(found):
                        rows.append((key, signature(found).tobytes().hex(), hashlib.sha256(found.tobytes()).hexdigest(), found.view(np.int64)))
                if rows:
                    yield batch(out, zip(*rows, strict=True))

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id is not null").distinct()
    rows = stage(found.mapInArrow(run, schema), "shingles")
    least = rows.groupBy("content").agg(F.min("doc_id").alias("class_id"))
    return rows.join(least, "content").select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("least"), "fingerprint", "shingles")


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id): documents with equal shingle sets share the least of their ids."""
    return _members(docs, id_col, text_col).select("doc_id", "class_id")
