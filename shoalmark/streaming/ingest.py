"""Streaming ingest of listings (beyond what a batch build needs): latest record of each listing, with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import LISTING


def listing_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Listings from JSON lines that arrive in a folder, with the time `seen` from `fetched`."""
    return spark.readStream.schema(LISTING).json(folder).withColumn("seen", F.to_timestamp("fetched"))


def deduplicated(stream: DataFrame, late: str = "7 days") -> DataFrame:
    return stream.withWatermark("seen", late).dropDuplicatesWithinWatermark(["src", "src_id", "fetched"])


def upsert(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps the latest record of each listing: every batch is merged with the version before and written as a new one.

    A batch that runs again after a failure writes the same version again.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        before = max((v for v in _versions(spark, path) if v < number), default=None)
        if before is None and number > 0:
            raise RuntimeError(f"{path} has no version before {number}: its history is gone")
        if before is not None:
            rows = spark.read.parquet(f"{path}/v={before}").unionByName(batch, allowMissingColumns=True)
        w = Window.partitionBy("src", "src_id").orderBy(F.desc("seen"), F.xxhash64("name"))
        latest = rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
        latest.write.mode("overwrite").parquet(f"{path}/v={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/v={max(_versions(spark, path))}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that were written whole."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    found = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("v=")]
    return [int(p.getName()[2:]) for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def windowed_counts(stream: DataFrame, time: str = "ts", size: str = "1 hour", late: str = "2 hours", by: str = "event_type") -> DataFrame:
    """Counts by tumbling window with a watermark for late rows."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, time: str = "ts", gap: str = "30 minutes", late: str = "2 hours", by: str = "user_id") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
