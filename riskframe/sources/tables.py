"""Reading, normalising, loading and writing tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.clean import enforce_types, normalise
from riskframe.sources.schemas import LOAD_ORDER, TABLES
from riskframe.sources.snapshots import Snapshots, Version


def _found(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """Parquet, else CSV with a header, else None. Columns keep their stored types; use
    :func:`typed` or the cleaners to enforce the declared ones."""
    base = f"{folder.rstrip('/')}/{name}"
    parquet = _found(lambda: spark.read.parquet(f"{base}.parquet"))
    if parquet is not None:
        return parquet
    # All columns as text: no inference pass over the data, types follow from the declaration.
    return _found(lambda: spark.read.csv(f"{base}.csv", header=True))


def typed(name: str, df: DataFrame) -> DataFrame:
    """Declared columns in declared order and type; a missing column is an error."""
    table = TABLES[name]
    missing = [c for c in table.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return enforce_types(df, table.types).select(table.columns)


def read_all(spark: SparkSession, folder: str, names: Iterable[str] = LOAD_ORDER) -> dict[str, DataFrame]:
    """Every table that is present; the others come out empty with their declared schema."""
    found = {n: read_table(spark, folder, n) for n in names}
    return {n: df if df is not None else spark.createDataFrame([], TABLES[n].schema) for n, df in found.items()}


Sink = Callable[[str, DataFrame, str], None]


def files_sink(folder: str, formats: Iterable[str] = ("parquet",), partition_by: tuple[str, ...] = ()) -> Sink:
    """Write ``<folder>/<table>.<format>`` folders, in parallel from the executors."""

    def write(name: str, df: DataFrame, mode: str) -> None:
        for fmt in formats:
            options = {"header": "true"} if fmt == "csv" else {}
            writer = df.write.mode(mode).format(fmt).options(**options)
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.save(f"{folder.rstrip('/')}/{name}.{fmt}")

    return write


def catalog_sink(database: str) -> Sink:
    def write(name: str, df: DataFrame, mode: str) -> None:
        df.write.mode(mode).saveAsTable(f"{database}.{name}")

    return write


def jdbc_sink(url: str, schema: str = "banking", batch_size: int = 5000, **properties: str) -> Sink:
    """Batched inserts over JDBC; overwriting truncates and keeps the table definition."""

    def write(name: str, df: DataFrame, mode: str) -> None:
        options = {"url": url, "dbtable": f"{schema}.{name}", "batchsize": str(batch_size), "truncate": "true"}
        df.write.format("jdbc").options(**options, **properties).mode(mode).save()

    return write


def load_all(
    spark: SparkSession, folder: str, sink: Sink, *, truncate_first: bool = True, names: Iterable[str] = LOAD_ORDER
) -> dict[str, int]:
    """Load the tables into ``sink`` and return rows written per table.

    With ``truncate_first`` the targets are emptied in reverse order, so a table goes before those
    it refers to; then the rows are appended in load order. Missing and empty tables count 0. Rows
    are counted while they are written.
    """
    order = [n for n in LOAD_ORDER if n in set(names)]
    sources = {n: read_table(spark, folder, n) for n in order}
    if truncate_first:
        for name in reversed(order):
            if sources[name] is not None:
                schema = normalise(name, sources[name]).schema
                sink(name, spark.createDataFrame([], schema), "overwrite")
    written = {}
    for name in order:
        if sources[name] is None:
            written[name] = 0
            continue
        seen = Observation()
        sink(name, normalise(name, sources[name]).observe(seen, F.count(F.lit(1)).alias("rows")), "append")
        written[name] = seen.get["rows"]
    return written


def load_version(spark: SparkSession, folder: str, store: Snapshots, batch: str, *, names: Iterable[str] = LOAD_ORDER) -> Version:
    """Load the tables as one new version of ``store``: readers see all of them or none.

    A job that dies leaves the version before; a batch id that is already in changes nothing. Tables without a file
    keep what they had.
    """
    sources = {n: read_table(spark, folder, n) for n in LOAD_ORDER if n in set(names)}
    return store.publish({n: normalise(n, df) for n, df in sources.items() if df is not None}, batch)


def write_datasets(
    datasets: Mapping[str, DataFrame], folder: str, partitions: Mapping[str, tuple[str, ...]] | None = None
) -> dict[str, int]:
    """Overwrite one Parquet dataset per entry, counting rows on the way."""
    written = {}
    for name, df in datasets.items():
        seen = Observation()
        files_sink(folder, partition_by=(partitions or {}).get(name, ()))(
            name, df.observe(seen, F.count(F.lit(1)).alias("rows")), "overwrite"
        )
        written[name] = seen.get["rows"]
    return written
