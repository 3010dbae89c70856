"""What a watermark would drop, kept: a stream is split into rows in time and rows aside, with counts per micro-batch.

A stateful operator drops rows older than its watermark and counts them at best. The gate stands before it and judges
each row by the same rule: a row is late if its time is before the greatest time of all earlier micro-batches, less the
delay. Late rows and rows without time go aside with their reason, nothing is lost, and an operator with
the same delay (or a longer one) behind the gate drops none of the rows that pass.

A micro-batch is stored under its number and becomes visible by one rename; then its greatest time and its counts are
stored as its mark. A batch that Spark repeats after a failure finds what is already there and adds nothing. Each mark
carries the greatest time so far, so a batch reads one mark, not all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskframe.session import configure
from riskframe.streaming.io import file_stream
from riskframe.streaming.windows import WATERMARK

IN_TIME, LATE, TIMELESS = "in time", "late", "no time"
MARK = "batch bigint, latest timestamp, in_time bigint, late bigint, no_time bigint"
_RULE = "passed"


class Gate:
    """The two sides of a stream, below ``folder`` on a file system that all of the cluster shares.

    On a store without an atomic rename of folders a reader may see part of a batch that is being published.
    Columns named ``batch``, ``reason`` or ``passed`` are refused, since the sides carry them.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, *, time: str = "timestamp", delay: str = WATERMARK) -> None:
        clashes = {"batch", "reason", _RULE} & set(schema.names)
        if clashes:
            raise ValueError(f"columns {sorted(clashes)} have names that the gate uses")
        self.spark, self.folder, self.schema = configure(spark), folder.rstrip("/"), schema
        self.time, self.delay = time, delay
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        for name in ("rows", "marks"):
            self._fs.mkdirs(self._path(f"{self.folder}/{name}"))

    def _publish(self, df: DataFrame, place: str, *by: str) -> None:
        """Write ``df`` to ``place`` in one step, unless it is there; what a dead attempt left is written anew."""
        target = self._path(f"{self.folder}/{place}")
        if self._fs.exists(target):
            return
        draft = f"{self.folder}/drafts/{place}"
        df.write.mode("overwrite").partitionBy(*by).parquet(draft)
        if not self._fs.rename(self._path(draft), target):
            raise OSError(f"cannot publish {place}")

    def admit(self, rows: DataFrame, batch: int) -> None:
        """Split one micro-batch; batches come in order of their numbers, as a stream delivers them."""
        latest = None
        if batch:
            before = self.spark.read.schema(MARK).parquet(f"{self.folder}/marks/number={batch - 1}")
            latest = before.select(F.unix_micros("latest")).first()[0]
        before = F.timestamp_micros(F.lit(latest).cast("bigint"))
        at = F.col(self.time)
        late = F.coalesce(at < before - F.expr(f"INTERVAL {self.delay}"), F.lit(False))
        reason = F.when(at.isNull(), TIMELESS).when(late, LATE).otherwise(IN_TIME)
        judged = rows.withColumn("batch", F.lit(batch).cast("bigint")).withColumn("reason", reason).withColumn(_RULE, reason == IN_TIME)
        self._publish(judged, f"rows/number={batch}", _RULE)
        stored = self.spark.read.schema(self._stored).parquet(f"{self.folder}/rows/number={batch}")
        count = lambda r: F.count_if(F.col("reason") == r)
        mark = stored.agg(
            F.lit(batch).cast("bigint").alias("batch"),
            F.greatest(F.max(self.time), before).alias("latest"),
            count(IN_TIME).alias("in_time"),
            count(LATE).alias("late"),
            count(TIMELESS).alias("no_time"),
        )
        self._publish(mark, f"marks/number={batch}")

    @property
    def _stored(self) -> StructType:
        return StructType([*self.schema.fields]).add("batch", "long").add("reason", "string").add(_RULE, "boolean")

    def run_available(self, stream: DataFrame) -> None:
        """Pass everything that is there; a later call goes on where this one ended."""
        query = (
            stream.writeStream.foreachBatch(lambda rows, batch: self.admit(rows, batch))
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def _rows(self, passed: bool) -> DataFrame:
        rows = self.spark.read.schema(self._stored.add("number", "long")).parquet(f"{self.folder}/rows")
        return rows.filter(F.col(_RULE) == passed).drop(_RULE, "number")

    def passed(self) -> DataFrame:
        """Rows in time, with the number of their ``batch``."""
        return self._rows(True)

    def aside(self) -> DataFrame:
        """Rows that did not pass, with ``batch`` and ``reason``."""
        return self._rows(False)

    def marks(self) -> DataFrame:
        """(batch, latest, in_time, late, no_time) of each micro-batch; ``latest`` is the greatest time so far."""
        return self.spark.read.schema(MARK).parquet(f"{self.folder}/marks")

    def live(self) -> DataFrame:
        """Rows in time as a stream. It takes whole batches in their order, so a watermark of the same delay drops none."""
        whole = file_stream(self.spark, f"{self.folder}/rows", self._stored.add("number", "long"))
        return whole.filter(_RULE).select(*self.schema.names)
