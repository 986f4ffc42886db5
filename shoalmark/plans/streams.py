"""Queries of streams and published tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import files, publish
from ..streaming import ingest
from .registry import query
from .tables import read

c = F.col


@query("SELECT c_custkey AS id, c_nationkey AS pref FROM customer WHERE c_nationkey = 7")
def published_partition(spark, d):
    """Entities of one area from a published table: written anew, the pointer moved, the old version dropped, one partition read."""
    root = files.scratch(spark) + "/entities"
    rows = read(spark, d, "customer").select(c("c_custkey").alias("id"), c("c_nationkey").alias("pref"))
    publish.write_versioned(rows.limit(1), root, "pref")
    publish.write_versioned(rows, root, "pref")
    publish.drop_old(spark, root)
    return publish.read_current(spark, root).where("pref = 7").select("id", c("pref").cast("int").alias("pref"))


def _events(spark, d):
    return spark.readStream.schema(read(spark, d, "events").schema).parquet(f"{d}/events.parquet*").withColumn("ts", c("ts").cast("timestamp"))


def _settled(stream):
    """The result of an aggregating stream when all input is read, as a table in the shared folder: each batch replaces it."""
    spark = stream.sparkSession
    out, state = files.scratch(spark), files.scratch(spark)
    put = lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/t")
    stream.writeStream.foreachBatch(put).outputMode("complete").option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/t")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, d):
    """Counts of a stream's events by hour and kind (beyond what a batch build needs)."""
    return _settled(ingest.windowed_counts(_events(spark, d))).select(c("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def stream_sessions(spark, d):
    """Sessions of a stream's users: events under half an hour apart (beyond what a batch build needs)."""
    return _settled(ingest.sessions(_events(spark, d))).select("user_id", c("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT event_type AS src, CAST(user_id AS VARCHAR) AS src_id, CAST(arg_max(event_id, (ts, event_id)) AS VARCHAR) AS name FROM events GROUP BY event_type, user_id")
def stream_upsert(spark, d):
    """The latest record of each key of a stream that arrives in two runs, the second one with older rows, too."""
    folder, out, state = files.scratch(spark), files.scratch(spark), files.scratch(spark)
    e = read(spark, d, "events")
    rows = e.groupBy("event_type", "user_id", "ts").agg(F.max("event_id").alias("event_id")).select(c("event_type").alias("src"), c("user_id").cast("string").alias("src_id"), c("event_id").cast("string").alias("name"), c("ts").cast("string").alias("fetched"), (c("event_id") % 3 == 0).alias("late"))
    for late in (False, True):
        rows.where(c("late") == late).drop("late").write.mode("append").json(f"{folder}/in")
        ingest.upsert(ingest.listing_stream(spark, f"{folder}/in"), f"{out}/t", f"{state}/c").awaitTermination()
    return ingest.latest(spark, f"{out}/t").select("src", "src_id", "name")
