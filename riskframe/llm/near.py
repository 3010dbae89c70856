"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least a threshold.

Candidates come from two searches over the same shingles. SimHash fingerprints within a few bits link, by the
pigeonring search of ``simhash``: near copies with small edits. At a similarity of 0.8 fingerprints differ in about 15 %
of their bits, which no such search reaches, so MinHash signatures add the rest: those that agree in one of
``BANDS`` bands meet, and are candidates if their estimate is at most ``SLACK`` below the threshold; at 0.8 a pair
misses all 32 bands of four values, or falls so far below, with a chance below 1e-7. Candidates only say where to look: the shingles of each connected group of candidates are
brought together, and only pairs whose exact similarity reaches the threshold become links.

A group of more than ``TILE`` sets is first compared within tiles, each of which also holds the group's least
set; that joins what resembles it. Only sets of a group that is then still in parts are compared across tiles:
those outside its largest part against all. No pair is lost, and no task holds more than two tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, components, fresh, runs, sorted_groups, stage
from riskframe.llm.fingerprints import SIZE, shingles, signature
from riskframe.llm.membership import bloom, may_hold, split
from riskframe.llm.simhash import fingerprint, links
from riskframe.llm.substrings import WordHashes
from riskframe.operators.skew import splittable

THRESHOLD = 0.8
BANDS = 32
SLACK = 0.2
#: Sets and shingles of a tile of the exact comparison; signatures of a tile of candidates.
TILE, LOAD, BUCKET = 512, 2**20, 4096

_ROWS = "doc_id long, body long, content binary, n long, fingerprint binary, simhash string"
_LINKS = "a binary, b binary"


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, body, content, n, fingerprint, simhash) of rows (doc_id, body, text) with words.

    ``content`` names the set of n shingles, ``fingerprint`` is its MinHash signature, ``simhash`` its SimHash as hex.
    """

    def run(batches: Batches) -> Batches:
        hashes, schema = WordHashes(), arrow_type(_ROWS)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows = []
                for key, body, text in zip(*(b.column(i)[at : at + 256].to_pylist() for i in range(3)), strict=True):
                    found = np.unique(shingles(text, hashes))
                    if len(found):
                        name = xxhash.xxh3_128_digest(found.tobytes())
                        rows.append((key, body, name, len(found), signature(found).tobytes(), fingerprint(found).hex()))
                if rows:
                    yield batch(schema, zip(*rows, strict=True))

    return docs.select("doc_id", "body", "text").mapInArrow(run, _ROWS)


def forest(label: np.ndarray, alike: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links (by position) that connect different labels wherever ``alike(i, others)`` holds, never more than needed."""
    label = label.copy()
    parts = len(np.unique(label))
    for i in range(len(label) - 1):
        if parts == 1:
            return
        rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        for j in (rest[alike(i, rest)] if len(rest) else rest).tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                parts -= 1
                yield i, j


def linked(sets: DataFrame) -> DataFrame:
    """(a, b): contents of rows (content, simhash) that connect all whose fingerprints the pigeonring search links."""
    prints = sets.select("content", "simhash")
    # One set stands for all with its fingerprint.
    least = stage(prints.groupBy("simhash").agg(F.min("content").alias("least")), "prints")
    equal = prints.join(splittable(least), "simhash").filter("content <> least").select(F.col("least").alias("a"), F.col("content").alias("b"))
    found = links(least.select(F.col("simhash").alias("fingerprint"))).withColumnsRenamed({"a": "x", "b": "y"})
    for end, print_ in (("a", "x"), ("b", "y")):
        found = found.join(least.select(F.col("simhash").alias(print_), F.col("least").alias(end)), print_)
    return equal.unionByName(found.select("a", "b"))


def candidates(sets: DataFrame, threshold: float, bands: int = BANDS, tile: int = BUCKET) -> DataFrame:
    """(a, b): contents of rows (content, fingerprint, simhash) that may be near copies: by SimHash, then by MinHash bands."""
    return linked(sets).unionByName(banded(sets, threshold, bands, tile)).distinct()


def banded(sets: DataFrame, threshold: float, bands: int = BANDS, tile: int = BUCKET) -> DataFrame:
    """(a, b): contents of rows (content, fingerprint) whose signatures share a band and are about alike; a forest of each bucket."""
    width = 2 * (SIZE // bands)
    parts = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring("fingerprint", i * width + 1, F.lit(width))))
    keyed = sets.select("content", F.explode(parts).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = keyed.join(splittable(sizes), "key").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    mine = F.pmod(F.xxhash64("content"), F.col("tiles")).cast("int")
    units = shared.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    units = units.select(
        F.when(F.col("tiles") == 1, F.col("key"))
        .otherwise(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")))
        .alias("unit"),
        "content",
    )
    units = units.join(sets.select("content", "fingerprint"), "content")

    def compare(tables: Iterator[pa.Table]) -> Batches:
        out = arrow_type(_LINKS)
        for t in tables:
            names = t.column("content").combine_chunks()
            prints = np.frombuffer(b"".join(t.column("fingerprint").to_pylist()), ">u2").astype(np.uint16).reshape(-1, SIZE)
            found = []
            for s, e in zip(*(x.tolist() for x in runs(t.column("unit").to_numpy())), strict=True):
                own = prints[s:e]
                alike = lambda i, rest, own=own: (own[rest] == own[i]).mean(axis=1) >= threshold - SLACK
                found += [(i + s, j + s) for i, j in forest(np.arange(e - s), alike)]
            if found:
                a, b = zip(*found, strict=True)
                yield batch(out, (names.take(pa.array(a)), names.take(pa.array(b))))

    return sorted_groups(units, "unit", compare, _LINKS).distinct()


def _exact(units: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links between sets of different labels in rows (unit, content, label, shingles) whose Jaccard reaches the threshold."""

    def compare(tables: Iterator[pa.Table]) -> Batches:
        out = arrow_type(_LINKS)
        for t in tables:
            names = t.column("content").combine_chunks()
            labels = t.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
            lists = [np.frombuffer(x, ">u8") for x in t.column("shingles").to_pylist()]
            found = []
            for s, e in zip(*(x.tolist() for x in runs(t.column("unit").to_numpy())), strict=True):
                if e - s < 2:
                    continue
                sizes = np.array([len(x) for x in lists[s:e]])
                _, codes = np.unique(np.concatenate(lists[s:e]), return_inverse=True)
                own = np.split(codes, np.cumsum(sizes)[:-1])
                flags = np.zeros(len(codes), bool)

                def alike(i: int, rest: np.ndarray, own=own, sizes=sizes, flags=flags) -> np.ndarray:
                    fits = np.minimum(sizes[rest], sizes[i]) >= threshold * np.maximum(sizes[rest], sizes[i]) - 1e-9
                    flags[own[i]] = True
                    common = np.array([np.count_nonzero(flags[own[j]]) if ok else 0 for j, ok in zip(rest.tolist(), fits.tolist(), strict=True)])
                    flags[own[i]] = False
                    return fits & (common >= threshold * (sizes[rest] + sizes[i] - common) - 1e-9)

                found += [(i + s, j + s) for i, j in forest(labels[s:e], alike)]
            if found:
                a, b = zip(*found, strict=True)
                yield batch(out, (names.take(pa.array(a)), names.take(pa.array(b))))

    return sorted_groups(units, "unit", compare, _LINKS)


def _shingled(texts: DataFrame) -> DataFrame:
    """(content, shingles): rows (content, text) with their sets of shingles."""
    schema = "content binary, shingles binary"

    def run(batches: Batches) -> Batches:
        hashes = WordHashes()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                names, part = b.column(0)[at : at + 256], b.column(1)[at : at + 256].to_pylist()
                yield batch(arrow_type(schema), (names, [np.unique(shingles(t, hashes)).astype(">u8").tobytes() for t in part]))

    return texts.select("content", "text").mapInArrow(run, schema)


def verified(narrow: DataFrame, sets: DataFrame, found: DataFrame, threshold: float, tile: int = TILE, load: int = LOAD) -> DataFrame:
    """(a, b): links of exact similarity that connect whatever such links connect within the groups of ``found``.

    ``narrow`` has rows (doc_id, body, text), ``sets`` one row (content, n, doc_id, body) for each set.
    """
    groups = components(found).withColumnsRenamed({"node": "content", "component": "group"})
    groups = stage(sets.join(groups, "content").select("content", "group", "n", "doc_id", "body"), "groups")
    sizes = groups.groupBy("group").agg(
        F.min("content").alias("pivot"),
        F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n") / load)).cast("int").alias("tiles"),
    )
    mine = F.pmod(F.xxhash64("content"), F.col("tiles")).cast("int")
    placed = stage(groups.join(splittable(sizes), "group").select("content", "group", "tiles", "pivot", mine.alias("tile")), "tiles")
    wanted = groups.select("content", F.col("doc_id").alias("_id"), F.col("body").alias("_body"))
    # Only texts that may be candidates move.
    known = bloom(groups.select("body").distinct(), groups.count())
    texts = narrow.filter(may_hold(known, F.col("body"))).join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body")))
    shingled = stage(_shingled(texts.dropDuplicates(["content"])), "shingled")

    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    units = placed.withColumn("at", F.explode(F.when(F.col("content") == F.col("pivot"), every).otherwise(F.array("tile"))))
    units = units.select(F.xxhash64("group", "at").alias("unit"), "content", F.col("content").alias("label"))
    first = stage(_exact(units.join(shingled, "content"), threshold), "within")

    large = placed.filter("tiles > 1")
    if large.isEmpty():
        return first
    joined = components(first).withColumnsRenamed({"node": "content", "component": "label"})
    large = stage(large.join(joined, "content", "left").withColumn("label", F.coalesce("label", "content")), "large")
    parts = large.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.groupBy("group").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"))
    parts = parts.select("group", F.col("most.label").alias("main"), (F.col("n") - F.col("most.n")).alias("others")).filter("others > 0")
    # Sets outside the main part meet all: (deal of the others, tile of all).
    still = large.join(splittable(parts), "group")
    deals = F.least(F.col("tiles"), F.ceil(F.col("others") / tile).cast("int") + 1)
    still = still.withColumn("deals", deals).withColumn("deal", F.pmod(F.xxhash64("content", F.lit("deal")), F.col("deals")).cast("int"))
    all_ = still.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).withColumn("v", F.col("tile"))
    others = still.filter("label <> main").withColumn("u", F.col("deal")).withColumn("v", F.explode(every))
    units = all_.unionByName(others).select(F.xxhash64("group", "u", "v").alias("unit"), "content", "label").distinct()
    across = _exact(units.join(shingled, "content"), threshold)
    return stage(first.unionByName(across), "verified")


def row_decisions(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, **tiles) -> DataFrame:
    """(doc_id, body, kept, times): each distinct row with words, whether it stays, and how often it occurs.

    ``body`` is the hash of the text. Of the rows that links connect, copies included, the one with the least id
    stays, a null id last and equal ids by ``body``.
    """
    narrow = _narrow(docs, id_col, text_col)
    rows = stage(signatures(narrow), "signatures")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body")
    sets = rows.groupBy("content").agg(F.min(row).alias("least"), F.first("n").alias("n"), F.first("fingerprint").alias("fingerprint"), F.first("simhash").alias("simhash"))
    sets = stage(sets, "sets")
    found = stage(candidates(sets, threshold, bands), "candidates")
    edges = verified(narrow, sets.select("content", "n", "least.doc_id", "least.body"), found, threshold, **tiles)
    labels = components(edges).withColumnsRenamed({"node": "content", "component": "root"})
    own = stage(sets.select("content", "least").join(labels, "content", "left").withColumn("root", F.coalesce("root", "content")), "roots")
    named = own.select("content", "root").join(splittable(own.groupBy("root").agg(F.min("least").alias("winner"))), "root")
    times = rows.groupBy("doc_id", "body", "content").agg(F.count(F.lit(1)).alias("times"))
    decided = times.join(splittable(named), "content")
    kept = F.col("doc_id").eqNullSafe(F.col("winner.doc_id")) & (F.col("body") == F.col("winner.body"))
    return decided.select("doc_id", "body", kept.alias("kept"), "times")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with exactly one row of each group of copies and near copies; rows without words stay.

    Rows are told apart by id and text. Of equal rows, which may differ in other columns, one stays, the same in
    every run.
    """
    decided = row_decisions(docs, id_col=id_col, text_col=text_col, **settings)
    decided = stage(decided.filter("not kept or times > 1").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), "kept"), "decided")
    body = F.xxhash64(docs[text_col].cast("string"))
    same = docs[id_col].cast("long").eqNullSafe(decided["_id"]) & (body == decided["_body"])
    known = lambda some: bloom(some.select("_body").distinct(), some.count())
    # Rows that no decision concerns stay where they are; the others meet the decisions in one plan at every size.
    concerned, clear = split(docs, body, known(decided))
    clear = clear.unionByName(concerned.join(splittable(decided).hint("merge"), same, "left_anti"))
    repeated = decided.filter("kept")
    again = docs.filter(may_hold(known(repeated), body)).join(splittable(repeated).hint("merge"), same, "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    row = fresh(docs, "row")
    again = again.groupBy(F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_body"))
    again = again.agg(F.min_by(whole, F.to_json(whole)).alias(row)).select(*[F.col(row)[c].alias(c) for c in docs.columns])
    return clear.unionByName(again)
