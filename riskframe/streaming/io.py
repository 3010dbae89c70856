"""Stream sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskframe.session import configure, work_path


def file_stream(
    spark: SparkSession, folder: str, schema: StructType | str, *, glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """New Parquet files of a folder; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, schema: StructType, *, offsets_per_trigger: int | None = None
) -> DataFrame:
    """JSON transactions from a topic; needs Spark's Kafka package on the cluster."""
    from pyspark.sql import functions as F

    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    )
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return reader.load().select(F.from_json(F.col("value").cast("string"), schema).alias("row")).select("row.*")


def run_available(stream: DataFrame, label: str) -> DataFrame:
    """Process everything that is there, into a Parquet table below the shared folder."""
    spark = configure(stream.sparkSession)
    target = work_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{target}/table")
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{target}/table")
