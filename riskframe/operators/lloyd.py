"""Lloyd's rounds of many k-means models in the same passes over the points.

A fit of its own reads all points once a round, so sixty fits read them some thousand times. Here one pass serves
every model that still moves, and it ends when the last one stands still. A round is that of ``pyspark.ml``: points
go to the nearest center, centers to the mean of their points, a center without points stays, and a model is done
when no center has moved by more than ``tol``. The driver gets the sums of each task, some kilobytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Points in one row of ``blocks``: few enough for the distances to a model's centers to stay in a core's cache.
BLOCK_POINTS = 5_000


def blocks(points: DataFrame, column: str) -> DataFrame:
    """The vectors of ``column`` as rows of many doubles, dealt over the task slots; tasks take them in faster than single rows."""
    schema = pa.schema([("block", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_POINTS):
                values = batch.slice(at, BLOCK_POINTS).column(0).flatten().to_numpy(zero_copy_only=False)
                yield pa.record_batch([pa.array([values.tobytes()], pa.binary())], schema=schema)

    packed = points.select(vector_to_array(column)).mapInArrow(pack, "block binary")
    return packed.repartition(points.sparkSession.sparkContext.defaultParallelism)


def nearest(column: str, centers: np.ndarray) -> Column:
    """Number of the center nearest to the vector of ``column``, the first of equally near ones."""
    away = F.array(*[sum((F.get(column, F.lit(i)) - float(at)) ** 2 for i, at in enumerate(center)) for center in centers])
    return (F.array_position(away, F.array_min(away)) - 1).cast("int")


def partial_sums(points: np.ndarray, models: Sequence[np.ndarray]) -> Iterator[tuple[np.ndarray, float]]:
    """For each model the sums and counts (last column) of the points of each center, and their sum of squared distances."""
    counted = np.column_stack([points, np.ones(len(points))])
    turned, squares = -2 * points.T, np.square(points).sum(axis=1)
    for centers in models:
        distances = centers @ turned  # squared, less the square of the point
        distances += np.square(centers).sum(axis=1)[:, None]
        least = distances.min(axis=0)
        mine = distances == least
        if np.count_nonzero(mine) > len(points):  # equally near to several: the first
            mine = distances.argmin(axis=0) == np.arange(len(centers))[:, None]
        yield mine.astype(float) @ counted, float(np.maximum(least + squares, 0).sum())


def _round(packed: DataFrame, models: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """``partial_sums`` over all points."""
    dims = models[0].shape[1]

    def run(rows: Iterator[Row]) -> Iterator[np.ndarray]:
        sums, costs = [np.zeros((len(m), dims + 1)) for m in models], np.zeros(len(models))
        for row in rows:
            points = np.frombuffer(row["block"]).reshape(-1, dims)
            for i, (found, cost) in enumerate(partial_sums(points, models)):
                sums[i] += found
                costs[i] += cost
        yield np.concatenate([*map(np.ravel, sums), costs])

    total = np.sum(packed.rdd.mapPartitions(run).collect(), axis=0)
    *sums, costs = np.split(total, np.cumsum([len(m) * (dims + 1) for m in models]))
    return [(s.reshape(-1, dims + 1), float(c)) for s, c in zip(sums, costs, strict=True)]


def settle(packed: DataFrame, starts: Sequence[np.ndarray], max_iter: int, tol: float) -> list[tuple[np.ndarray, float]]:
    """Centers and sum of squared distances of each start after its rounds, at most ``max_iter``."""
    models = [(np.asarray(s, float), 0.0) for s in starts]
    moving = list(range(len(models)))
    for _ in range(max_iter):
        if not moving:
            break
        still = []
        for i, (sums, cost) in zip(moving, _round(packed, [models[i][0] for i in moving]), strict=True):
            held, counts = models[i][0], sums[:, -1:]
            centers = np.where(counts > 0, sums[:, :-1] / np.maximum(counts, 1), held)
            if (np.square(centers - held).sum(axis=1) > tol * tol).any():
                still.append(i)
            models[i] = (centers, cost)
        moving = still
    return models
