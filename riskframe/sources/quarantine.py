"""Loads that set unsound rows aside, with their reasons, and publish the others.

A table is read once. That pass types the columns, notes what is wrong within a row, and asks a Bloom filter of each
referenced table whether it can hold the row's value: what the filter denies is rejected there. Values that pass
are counted per key and checked exactly, so a popular value is one row in that join, and only the few that
the filter let through by mistake come back to the rows. These few are stored first: Spark then knows their size, and
broadcasts them instead of moving the rows. Keys that occur more than once are found by counting narrow keys; a Bloom filter
of them lets all other rows pass, so only likely copies are moved and told apart by one aggregate per key.

Reasons: ``type <column>`` (no value of the declared type, or a number that is not finite), ``null <column>`` (key and
required columns), ``foreign key <column>`` (no sound row of the referenced table has the value; null is allowed), and
``duplicate key`` for all rows but one of those that are sound otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import flag, is_finite
from riskframe.operators.skew import splittable
from riskframe.session import remove, staged, work_path
from riskframe.sources.schemas import LOAD_ORDER, TABLES, TableDef, require
from riskframe.sources.snapshots import Snapshots, Version

REJECTS = "rejects"
DUPLICATE = "duplicate key"

#: Size of a filter: 512 KB whatever the table holds. A fuller one denies less, and the exact check decides more.
FILTER_BITS = 1 << 22
_HASHES = 3
_WORD = 64

# Of several rows with one key the latest stays, as in the cleaner; elsewhere the choice is by content.
_LATEST = {"transactions": "timestamp"}


class KeyFilter:
    """Bloom filter over a column, or a struct of several, kept as an array of 64-bit words in a scalar subquery."""

    def __init__(self, keys: DataFrame, bits: int = FILTER_BITS) -> None:
        self.bits = bits
        column = _whole(keys.columns)
        places = keys.select(F.explode(F.array(*self._places(column))).alias("place"))
        words = places.groupBy(F.floor(F.col("place") / _WORD).alias("at")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % _WORD).cast("int"))).alias("word")
        )
        whole = keys.sparkSession.range(bits // _WORD).withColumnRenamed("id", "at").join(words, "at", "left")
        dense = F.array_sort(F.collect_list(F.struct("at", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))))
        self.words = whole.agg(F.transform(dense, lambda w: w["word"])).scalar()

    def _places(self, value: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(value, F.lit(i)), F.lit(self.bits)) for i in range(_HASHES)]

    def denies(self, value: Column) -> Column:
        """True if no row of the table has the value; a null value is not denied."""
        held = F.lit(True)
        for place in self._places(value):
            word = F.get(self.words, F.floor(place / _WORD).cast("int"))
            held &= F.bit_get(word, (place % _WORD).cast("int")) == 1
        return value.isNotNull() & ~held


def _whole(columns: Sequence[str]) -> Column:
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def _reasons_within(table: TableDef, df: DataFrame) -> list[Column]:
    stored, found = dict(df.dtypes), []
    for column, kind in table.types.items():
        value = F.col(column).try_cast(kind)
        readable = is_finite(value) if kind == "double" else value.isNotNull()
        if stored[column] != kind or kind == "double":
            found.append(F.when(F.col(column).isNotNull() & ~flag(readable), F.lit(f"type {column}")))
    found += [F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in dict.fromkeys((*table.key, *table.required))]
    return found


def _first(table: TableDef) -> Column:
    """What rows with one key are compared by; the row's own number only separates equal ones."""
    names = [f"`{c}`" for c in table.columns]
    content = F.expr(f"xxhash64({', '.join(names + [f'isnull({c})' for c in names])})")
    latest = _LATEST.get(table.name)
    return F.struct((-F.unix_micros(latest) if latest else F.lit(0)).alias("age"), content.alias("content"), F.col("_row"))


def sift(name: str, df: DataFrame, parents: Mapping[str, DataFrame], folder: str, bits: int = FILTER_BITS) -> DataFrame:
    """The declared columns of every row, typed, with ``_reasons`` (sorted; empty for a sound row) and ``_raw``.

    ``parents`` holds the sound rows of the tables that this one refers to; one that is absent counts as empty.
    ``_raw`` is the row as delivered, in JSON, where something within it is wrong. Columns that are not declared
    are left out; a declared one that is missing is an error. ``folder`` takes the typed rows and what is found out
    about them in between.
    """
    table = TABLES[name]
    spark = df.sparkSession
    df = require(df, *table.columns).select(table.columns)
    keys = {
        column: (parents[parent] if parent in parents else spark.createDataFrame([], TABLES[parent].schema)).select(
            F.col(TABLES[parent].key[0]).alias(column)
        )
        for column, parent in table.references
    }
    denied = [F.when(KeyFilter(held, bits).denies(F.col(c)), F.lit(f"foreign key {c}")) for c, held in keys.items()]
    checked = df.withColumn("_reasons", F.array_compact(F.array(*_reasons_within(table, df), *denied)))
    raw = F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"})
    rows = staged(
        checked.select(
            *[F.col(c).try_cast(kind).alias(c) for c, kind in table.types.items()],
            "_reasons",
            F.when(F.size("_reasons") > 0, raw).alias("_raw"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        f"{folder}/typed",
    )
    found = rows
    for column, held in keys.items():
        reason = F.lit(f"foreign key {column}")
        asked = rows.filter(F.col(column).isNotNull() & ~F.array_contains("_reasons", reason)).select(column).distinct()
        absent = staged(asked.join(held, column, "left_anti"), f"{folder}/absent-{column}").withColumn("_absent", F.array(reason))
        found = found.join(splittable(absent), column, "left").withColumn(
            "_reasons", F.concat("_reasons", F.coalesce("_absent", F.array().cast("array<string>")))
        ).drop("_absent")

    sound = F.size("_reasons") == 0
    counts = found.filter(sound).groupBy(*table.key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = staged(counts.filter("_n > 1").select(*table.key), f"{folder}/repeated")
    likely = flag(sound & ~KeyFilter(repeated, bits).denies(_whole(table.key)))
    copies = found.filter(likely)
    firsts = copies.join(splittable(repeated), list(table.key), "left_semi").groupBy(*table.key).agg(F.min(_first(table)).alias("_first"))
    copy = flag(_first(table) != F.col("_first"))
    told_apart = copies.join(splittable(firsts), list(table.key), "left").withColumn(
        "_reasons", F.when(copy, F.array(F.lit(DUPLICATE))).otherwise(F.col("_reasons"))
    )
    alone = found.filter(~likely).withColumn("_reasons", F.array_sort("_reasons"))
    columns = [*table.columns, "_reasons", "_raw"]
    return alone.select(columns).unionByName(told_apart.select(columns))


def load_with_rejects(spark: SparkSession, tables: Mapping[str, DataFrame], store: Snapshots, batch: str, bits: int = FILTER_BITS) -> Version:
    """Publish the sound rows of ``tables`` and the table ``rejects`` as one version.

    ``rejects`` has (table_name, row_key, reasons, row), the row in JSON. Referenced tables that are not among ``tables``
    are those of the version before. A batch id that is already in changes nothing; a job that dies publishes nothing.
    """
    before = store.latest()
    if batch in before.batches:
        return before
    parents = {n: store.read(n, before) for n in LOAD_ORDER if n in before.tables and n not in tables}
    parts, schemas, rejected = {}, {}, {}
    for name in (n for n in LOAD_ORDER if n in tables):
        table, path, between = TABLES[name], store.folder(), work_path(spark, f"typed-{name}")
        sifted = sift(name, tables[name], parents, between, bits)
        sifted.withColumn("sound", F.size("_reasons") == 0).write.partitionBy("sound").parquet(path)
        remove(spark, between)
        written = spark.read.schema(f"{table.ddl}, _reasons array<string>, _raw string, sound boolean").parquet(path)
        parents[name] = written.filter("sound").select(table.columns)
        given = F.coalesce("_raw", F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"}))
        aside = written.filter("not sound").select(
            F.lit(name).alias("table_name"), F.concat_ws("|", *table.key).alias("row_key"), F.col("_reasons").alias("reasons"), given.alias("row")
        )
        rejected[name] = store.folder()
        aside.write.parquet(rejected[name])
        parts[name] = {"": f"{path}/sound=true"} if store.holds(f"{path}/sound=true") else {}
        schemas[name], schemas[REJECTS] = table.schema.json(), aside.schema.json()
    return store.commit(before, {**parts, REJECTS: rejected}, schemas, batch)
