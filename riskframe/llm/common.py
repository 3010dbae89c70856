"""Helpers the operators share: Arrow maps, sorted group streams, words and staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskframe.operators.graph import connected_components
from riskframe.session import staged, work_path

Batches = Iterator[pa.RecordBatch]


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: short lineage, shared by all executors."""
    return staged(df, work_path(df.sparkSession, label))


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def short_batches(spark, rows: int = 1000) -> None:
    """Let Arrow batches hold fewer rows than Spark's default, since texts are long; a setting made by the user stays.

    Both sides of a Python task hold whole batches outside the heap.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def arrow_type(df_schema: str) -> pa.Schema:
    """Arrow schema of a DDL string of plain types."""
    types = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
        "array<long>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
        "array<double>": pa.list_(pa.float64()),
    }
    return pa.schema([(name, types[kind]) for name, kind in (part.split() for part in df_schema.split(", "))])


def sorted_groups(df: DataFrame, key: str, fn: Callable[[Iterator[pa.Table]], Batches], schema: str, *order: str) -> DataFrame:
    """Rows dealt by ``key`` and sorted; ``fn`` gets tables that hold whole groups, many small groups in one.

    A table is as large as an Arrow batch plus the group that the batch cut, so the caller bounds its groups.
    """
    dealt = df.repartition(key).sortWithinPartitions(key, *order)

    def whole(batches: Batches) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            change = np.flatnonzero(keys[1:] != keys[:-1])
            if held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != keys[0]:
                yield pa.Table.from_batches(held)
                held = []
            if len(change):
                cut = int(change[-1]) + 1
                yield pa.Table.from_batches([*held, b.slice(0, cut)])
                held = [b.slice(cut)]
            else:
                held.append(b)
        if held:
            yield pa.Table.from_batches(held)

    return dealt.mapInArrow(lambda batches: fn(whole(batches)), schema)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal neighbours."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return starts, np.append(starts[1:], len(keys))


#: Links that a task contracts at a time.
LINKS = 2**18


def contracted(edges: DataFrame, most: int = LINKS) -> DataFrame:
    """(a, b): stars that connect what ``edges`` (a, b) connect, made of up to ``most`` links at a time.

    A task replaces each run of links that it holds by one link from every node to the least node it reaches in the run.
    """

    def run(batches: Batches) -> Batches:
        schema, parent = None, {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        def stars() -> pa.RecordBatch:
            ends = [x for x in parent if root(x) != x]
            return batch(schema, (ends, [root(x) for x in ends]))

        held = 0
        for b in batches:
            schema = b.schema
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x, y = root(x), root(y)
                parent[max(x, y)] = min(x, y)
            held += b.num_rows
            if held >= most:
                yield stars()
                parent.clear()
                held = 0
        if parent:
            yield stars()

    links = edges.select("a", "b").filter("a <> b")
    return links.mapInArrow(run, links.schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) as ``connected_components`` gives them; tasks contract the links first, which saves most rounds."""
    return connected_components(contracted(edges))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
