"""Connected components of an edge table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of checkpoints, which driver and executors share: the session's spark.checkpoint.dir.

    A session without one gets a new folder only where all runs in one process (a local master); on a cluster, whose
    executors could not read it, that is an error.
    """
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None)
    known = sc._jsc.sc().getCheckpointDir()
    if not at and known.isDefined():
        at = known.get()
    if not at:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="shoalmark-")
    if known.isEmpty():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The rows of df as a Parquet table in the folder of checkpoints, read again.

    Like a checkpoint it cuts the lineage and survives lost executors.  Unlike one it leaves behind what Spark has inferred about
    the rows (a checkpoint keeps constraints and size estimates, which grow with every join of a loop), and its size
    is the measured one, so that small tables are broadcast.  The table goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/shoalmark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt by the keys to a number of tasks that AQE leaves as it is: it would join tasks by the size of the rows, which
    says nothing of the pairs that they make."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of the edges (a, b); root is the smallest node that it reaches.

    Each round links every node to the smallest of its neighbourhood, alternately over larger and smaller neighbours.  The
    minima are combined before each shuffle and joined back, so no neighbourhood is gathered; edges and minima are
    checkpointed, and as tables of their own they meet in plain joins that Spark splits where a node is crowded.
    """
    checkpoint_dir(edges.sparkSession)

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()
    was = state(now)
    for _ in range(most_rounds):
        if not was[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).checkpoint()
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct().checkpoint()
        least = large.groupBy("a").agg(F.min("b").alias("m")).checkpoint()
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct().checkpoint()
        found = state(now)
        if found == was:
            break
        was = found
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def shared_key_edges(rows: DataFrame, id_col: str, key: str) -> DataFrame:
    """Edges (a, b) that connect rows of equal keys: each to the least id of its key, so a key makes a star, not all pairs."""
    keyed = rows.where(F.col(key).isNotNull()).select(F.col(id_col).alias("a"), F.col(key).alias("k"))
    least = keyed.groupBy("k").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return keyed.join(least, "k").where("a <> b").select("a", "b")
