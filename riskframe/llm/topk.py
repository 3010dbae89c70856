"""Exact top-k inner products with a pivot-distance index.

A vector v with |v| <= M becomes (v, sqrt(M^2 - |v|^2)), a query q becomes (q, 0). All vectors then have norm M,
and |q' - v'|^2 = |q|^2 + M^2 - 2 <q, v>: the largest inner products are the nearest neighbours.

Index: each vector belongs to its nearest pivot and is keyed by its distance r to it. Vectors in the order
(pivot, r, id) are cut into blocks, so a block is an annulus of one pivot. Search: queries come in blocks of
neighbours. The annuli nearest to a query block give each query a score it has to beat; with it, the triangle
inequality |d(q, p) - r| <= d(q, v) leaves, for each pivot, one interval of r. The annuli that meet it are
compared from the closest outward, and the scores to beat rise on the way, which stops the rest.

Pivots come from a bounded sample; every vector is indexed, and all comparisons are exact.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, runs, stage

PIVOTS, SAMPLE = 64, 2048
BLOCK, QUERIES = 1024, 256
SLICE = 64


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, size, most, norm2, vector): floor(scale * x) of rows whose vector and components are all usable."""
    schema = "vec_id long, size int, most double, norm2 double, vector binary"

    def run(batches: Batches) -> Batches:
        out = arrow_type(schema)
        for b in batches:
            rows = []
            for key, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if x is None or any(c is None for c in x):
                    continue
                x = np.asarray(x, np.float64)
                if np.isfinite(x).all():
                    x = np.floor(scale * x)
                    rows.append((key, len(x), float(np.abs(x).max(initial=0)), float(x @ x), x.tobytes()))
            if rows:
                yield batch(out, zip(*rows, strict=True))

    usable = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>")).mapInArrow(run, schema)


def _kind(most: float) -> str:
    """The smallest type that holds all components."""
    return next((kind for kind, limit in (("i1", 2**7), ("<i2", 2**15), ("<i4", 2**31)) if most < limit), "<f8")


def _matrix(column: list[bytes], width: int, kind: str = "<f8") -> np.ndarray:
    out = np.zeros((len(column), width))
    for row, raw in zip(out, column, strict=True):
        x = np.frombuffer(raw, kind)
        row[: len(x)] = x  # shorter vectors end in zeros
    return out


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack((x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))[:, None]))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def spread_out(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next pivot is the row farthest from those chosen."""
    chosen, least = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        least = np.minimum(least, _distances(sample, sample[chosen[-1:]])[:, 0])
        far = int(np.argmax(least))
        if least[far] <= 0:
            break
        chosen.append(far)
    return sample[chosen]


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; beyond the exact range of doubles, in Python integers."""
    if np.sqrt((q * q).sum(axis=1).max(initial=0) * (v * v).sum(axis=1).max(initial=0)) < 2**52:
        return q @ v.T
    whole = lambda m: np.array([[int(c) for c in row] for row in m], dtype=object).reshape(m.shape)
    return whole(q) @ whole(v).T


def _blocks(keyed: DataFrame, order: list[str], group: str, size: int) -> DataFrame:
    """Rows in ``order`` gathered into blocks of at most ``size`` rows with one ``group``."""
    schema = f"block long, {group} int, low double, high double, ids array<long>, vectors array<binary>"
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select(group, "r", "vec_id", "vector")
    out = pa.schema([("block", pa.int64()), (group, pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("ids", pa.list_(pa.int64())), ("vectors", pa.list_(pa.binary()))])

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            number += 1
            distance = [h[1] for h in held]
            row = ([number], [held[0][0]], [min(distance)], [max(distance)], [[h[2] for h in held]], [[h[3] for h in held]])
            held.clear()
            return batch(out, row)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (len(held) == size or held[0][0] != row[0]):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    return dealt.mapInArrow(run, schema)


def search(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: int = 64, pivots: int = PIVOTS, sample: int = SAMPLE, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its ``k`` best other rows by inner product.

    ``is_query`` is a condition on ``vec_id``. Scores are integer products of floor(``scale`` * x); ties go to
    the smaller vec_id. Null vectors, null or non-finite components and null ids take no part; shorter vectors
    count as if they ended in zeros. A repeated id is a candidate each time it
    occurs, never for itself; a query row that is repeated, or shares its id, gets its ranks each time.
    """
    spark = vectors.sparkSession
    rows = stage(quantised(vectors, id_col, vector_col, scale), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    stats = rows.agg(F.max("size").alias("width"), F.max("norm2").alias("top"), F.max("most").alias("most")).first()
    if stats["width"] is None:
        return empty
    width, top, kind = stats["width"], stats["top"], _kind(stats["most"])
    some = [r["vector"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").collect()]
    centre = spread_out(_lift(_matrix(some, width), top), pivots)

    def assign(batches: Batches) -> Batches:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1).to_pylist(), width)
            near = _distances(_lift(x, top), centre)
            home = near.argmin(axis=1)
            packed = [row.tobytes() for row in x.astype(kind)]
            yield batch(arrow_type(keyed), (b.column(0), home, near[np.arange(len(home)), home], packed))

    keyed = "vec_id long, pivot int, r double, vector binary"
    index = stage(_blocks(rows.select("vec_id", "vector").mapInArrow(assign, keyed), ["pivot", "r", "vec_id"], "pivot", block), "annuli")
    asked = rows.filter(is_query).select("vec_id", "vector").mapInArrow(assign, keyed)
    asked = asked.withColumn("part", F.lit(0))
    asked = stage(_blocks(asked, ["pivot", "r", "vec_id"], "part", query_block), "queries")
    asked = asked.select(F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("vectors").alias("qvectors"))
    annuli = index.select("block", "pivot", "low", "high")
    best = _compare(width, top, centre, k, kind)

    # Seeds: for each pivot that is home to queries of a block, the annulus nearest to their median distance.
    def homes(batches: Batches) -> Batches:
        out = arrow_type("qblock long, pivot int, mid double")
        for b in batches:
            for key, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                near = _distances(_lift(_matrix(raw, width, kind), top), centre)
                home = near.argmin(axis=1)
                own = np.unique(home)
                yield batch(out, (np.full(len(own), key), own, [float(np.median(near[home == p, p])) for p in own]))

    middles = asked.select("qblock", "qvectors").mapInArrow(homes, "qblock long, pivot int, mid double")
    gap = F.greatest(F.lit(0.0), F.col("mid") - F.col("high"), F.col("low") - F.col("mid"))
    seeds = middles.join(annuli, "pivot").groupBy("qblock", "pivot").agg(F.min(F.struct(gap.alias("bound"), "block")).alias("near"))
    seeds = seeds.select("qblock", "near.bound", "near.block")
    first = _meet(seeds, asked.withColumn("floor", F.lit(None).cast("array<double>")), index).mapInArrow(best, _FOUND)
    # A query row is a place in a query block: rows with one id, equal or not, each have ranks of their own.
    bars = first.groupBy("qblock", "copy").agg(F.slice(F.sort_array(F.collect_list("score"), asc=False), 1, k).alias("top"))
    bars = bars.select("qblock", "copy", F.when(F.size("top") == k, F.element_at("top", k).cast("double")).alias("bar"))
    bars = bars.groupBy("qblock").agg(F.map_from_entries(F.collect_list(F.struct("copy", "bar"))).alias("bars"))
    known = asked.join(bars, "qblock", "left")
    place = F.sequence(F.lit(0).cast("long"), F.size("qids").cast("long") - 1)
    lowest = F.transform(place, lambda at: F.coalesce(F.try_element_at("bars", at), F.lit(float("-inf"))))
    known = stage(known.withColumn("floor", lowest).drop("bars"), "bars")

    # Intervals of r that the scores leave, for each pivot; one row for each query block and pivot.
    def intervals(batches: Batches) -> Batches:
        out = arrow_type("qblock long, pivot int, near double, low double, high double")
        for b in batches:
            for key, raw, floor in zip(*(c.to_pylist() for c in b.columns), strict=True):
                q = _matrix(raw, width, kind)
                to = _distances(np.hstack((q, np.zeros((len(q), 1)))), centre)
                reach = _reach(q, np.array(floor, float), top)[:, None]
                yield batch(out, (np.full(len(centre), key), np.arange(len(centre)), to.min(axis=0), (to - reach).min(axis=0), (to + reach).max(axis=0)))

    spans = known.select("qblock", "qvectors", "floor").mapInArrow(intervals, "qblock long, pivot int, near double, from double, to double")
    bound = F.greatest(F.lit(0.0), F.col("low") - F.col("near"))
    pairs = spans.join(annuli, "pivot").filter("high >= `from` and low <= `to`").select("qblock", "block", bound.alias("bound"))
    found = _meet(pairs, known, index).mapInArrow(best, _FOUND)
    # Ranks among what the slices of the index returned, at most k for each query row and slice.
    order = Window.partitionBy("qblock", "copy").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


_FOUND = "qblock long, copy long, query_id long, vec_id long, score long"


def _reach(q: np.ndarray, floor: np.ndarray, top: float) -> np.ndarray:
    """Largest distance at which a score of at least ``floor`` is possible, with room for rounding."""
    square = (q * q).sum(axis=1) + top
    return np.where(np.isneginf(floor), np.inf, np.sqrt(np.maximum(square - 2 * floor, 0) + 1e-9 * square + 1e-6))


def _meet(pairs: DataFrame, asked: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs with both blocks, dealt by query block and slice of the index, closest annuli first."""
    full = pairs.join(index, "block").join(asked, "qblock")
    full = full.withColumn("slice", F.xxhash64("qblock", F.shiftrightunsigned("block", 32)))
    full = full.repartition("slice").sortWithinPartitions("qblock", "slice", "bound")
    return full.select("qblock", "slice", "block", "pivot", "low", "high", "ids", "vectors", "qids", "qvectors", "floor")


def _compare(width: int, top: float, centre: np.ndarray, k: int, kind: str):
    """Best ``k`` of each query row within a slice of the index; ``copy`` is the row's place in its block."""

    def run(batches: Batches) -> Batches:
        out, now = arrow_type(_FOUND), None
        held: list[tuple[np.ndarray, ...]] = []  # (query place, id, score): what may be among the best

        def best() -> tuple[np.ndarray, ...]:
            at, ids, score = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((ids, -score, at))
            start, end = runs(at[order])
            order = order[np.arange(len(order)) - np.repeat(start, end - start) < k]
            return at[order], ids[order], score[order]

        def written() -> Batches:
            if held:
                at, ids, score = best()
                yield batch(out, (np.full(len(at), now[0]), at, qids[at], ids, [int(x) for x in score]))
                held.clear()

        for b in batches:
            for r in b.to_pylist():
                if now != (r["qblock"], r["slice"]):
                    yield from written()
                    now, q, qids = (r["qblock"], r["slice"]), _matrix(r["qvectors"], width, kind), np.array(r["qids"])
                    to = _distances(np.hstack((q, np.zeros((len(q), 1)))), centre)
                    floor = np.array(r["floor"], float) if r["floor"] else np.full(len(q), -np.inf)
                    tops = np.full((len(q), k), -np.inf)
                # The triangle inequality stops queries that this annulus cannot serve.
                gap = np.maximum(0, np.maximum(to[:, r["pivot"]] - r["high"], r["low"] - to[:, r["pivot"]]))
                mine = np.flatnonzero(gap <= _reach(q, floor, top))
                if not len(mine):
                    continue
                v, ids = _matrix(r["vectors"], width, kind), np.array(r["ids"])
                score = _exact(q[mine], v)
                value = score.astype(float)
                value[qids[mine][:, None] == ids[None, :]] = -np.inf
                a, c = np.nonzero(value >= np.maximum(floor[mine], -1e300)[:, None])
                if len(a):
                    held.append((mine[a], ids[c], score[a, c]))
                    if sum(len(h[0]) for h in held) > 4 * k * len(q) + 100_000:
                        held[:] = [best()]
                if len(ids) > k:
                    value = np.partition(value, len(ids) - k, axis=1)[:, -k:]
                tops[mine] = -np.sort(-np.hstack((tops[mine], value)), axis=1)[:, :k]
                floor[mine] = np.maximum(floor[mine], tops[mine][:, -1])
        yield from written()

    return run
