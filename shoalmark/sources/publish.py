"""Sinks: partitioned tables with a pointer that readers follow, the index payload, membership, reports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import written


def _path(spark: SparkSession, at: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_versioned(rows: DataFrame, root: str, by: str | None = None) -> str:
    """Writes a new version of the table below root and then moves the pointer to it; readers see one or the other."""
    spark = rows.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    out = rows.write
    (out.partitionBy(by) if by else out).parquet(f"{root}/{version}")
    target, fs = _path(spark, f"{root}/CURRENT")
    fresh, _ = _path(spark, f"{root}/.CURRENT-{version}")
    stream = fs.create(fresh, True)
    stream.writeBytes(version)
    stream.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fresh, target, options)
    return version


def read_current(spark: SparkSession, root: str) -> DataFrame:
    version = spark.read.text(f"{root}/CURRENT").first()[0].strip()
    return spark.read.parquet(f"{root}/{version}")


def id_range(id_col: str, width: int):
    """The number of the range of so many ids that an id lies in."""
    return F.floor(F.col(id_col) / width).cast("long")


def write_by_ranges(rows: DataFrame, root: str, id_col: str, width: int) -> str:
    """A version of rows laid out for lookups: a folder for each range of so many ids, sorted by id within."""
    return write_versioned(rows.withColumn("_range", id_range(id_col, width)).repartition("_range").sortWithinPartitions("_range", id_col), root, "_range")


def looked_up(wanted: DataFrame, root: str, id_col: str, width: int) -> DataFrame:
    """The rows of a table written by ranges whose ids stand in wanted (id_col), each once; null ids have none.

    Where wanted is small enough for a broadcast, its ranges prune the table's folders while the query runs, and only
    the files of those ranges are read; otherwise both sides are shuffled.
    """
    table = read_current(wanted.sparkSession, root)
    # Written first, so that their size is known; the comparison tells the optimiser that the ids select, without which it doesn't prune.
    asked = written(wanted.select(id_col).where(F.col(id_col).isNotNull()).distinct().withColumn("_range", id_range(id_col, width))).where(F.col("_range") >= -(1 << 62))
    return table.join(asked, ["_range", id_col]).select(*[c for c in table.columns if c != "_range"])


def looked_up_ids(spark: SparkSession, root: str, id_col: str, width: int, ids: list[int]) -> DataFrame:
    """The same for ids at hand: their folders are known before anything is read, and within a file the order skips row groups."""
    table = read_current(spark, root)
    return table.where(F.col("_range").isin(sorted({i // width for i in ids})) & F.col(id_col).isin(ids)).drop("_range")


def drop_old(spark: SparkSession, root: str) -> int:
    """Deletes the versions that the pointer doesn't name; returns how many."""
    version = spark.read.text(f"{root}/CURRENT").first()[0].strip()
    path, fs = _path(spark, root)
    old = [s.getPath() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName() not in (version,)]
    for p in old:
        fs.delete(p, True)
    return len(old)


def index_payload(index: DataFrame, sources: DataFrame, generated: str, most: int = 1_000_000) -> str:
    """The client's script: positional rows and the sources in use.  The client loads it whole, so it is bounded."""
    rows = index.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"an index of more than {most} rows is not a client payload")
    used = {r.src: [r.label, r.kind] for r in sources.collect()}
    return "window.DATA=" + json.dumps({"generated": generated, "sources": used, "rows": [list(r) for r in rows]}, ensure_ascii=False, separators=(",", ":"))


def memberships(entities: DataFrame, id_col: str = "id", members: str = "members") -> DataFrame:
    return entities.select(id_col, F.explode(members).alias("member"))


def sparse_json(rows: DataFrame, id_col: str) -> DataFrame:
    """(id, js): rows as JSON without nulls, empty texts and empty lists."""
    kept = [F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.when(F.size(c) > 0, F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes]
    return rows.select(F.col(id_col), F.to_json(F.struct(*kept)).alias("js"))


def public(rows: DataFrame) -> DataFrame:
    """rows without internal columns (those that begin with _); stale is null unless true."""
    kept = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(*[F.when(F.col(c), F.lit(True)).alias(c) if c == "stale" else F.col(c) for c in kept])


def blanked(rows: DataFrame, flagged: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """rows whose columns are null where flagged (on, <column>_unstated) says so; for rewriting a partition."""
    marks = flagged.select(*on, *[F.col(f"{c}_unstated").alias(f"_x_{c}") for c in columns])
    out = rows.join(marks, on, "left")
    return out.withColumns({c: F.when(~F.coalesce(f"_x_{c}", F.lit(False)), F.col(c)) for c in columns}).drop(*[f"_x_{c}" for c in columns])


def used_sources(*tables: DataFrame) -> DataFrame:
    """The sources that any of the tables names."""
    out = tables[0].select("src")
    for t in tables[1:]:
        out = out.unionByName(t.select("src"))
    return out.where("src IS NOT NULL").distinct()


def report(counts: DataFrame, most: int = 40) -> DataFrame:
    """(metric, line): each metric of counts (metric, value, n) as a line of a report: its values by how many they are, at most
    so many, as value=n."""
    ranked = counts.withColumn("_n", F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("n"), "value"))).where(F.col("_n") <= most)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_n", "value", "n"))), lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string")))
    return ranked.groupBy("metric").agg(F.concat(F.first("metric"), F.lit(": "), F.array_join(parts, ", ")).alias("line"))


def log(spark: SparkSession, folder: str, step: str, **facts: int | str) -> None:
    """Adds an entry to a log: a file of its own, whose name sorts behind those before it, so that nothing is rewritten."""
    from .files import names, put

    at = len(names(spark, folder))
    put(spark, f"{folder}/{at:09d}-{uuid.uuid4().hex[:8]}.json", json.dumps({"at": at, "step": step, "facts": {k: str(v) for k, v in facts.items()}}, ensure_ascii=False))


def log_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(at, step, facts) of a log's entries."""
    return spark.read.schema("at bigint, step string, facts map<string, string>").json(folder)
