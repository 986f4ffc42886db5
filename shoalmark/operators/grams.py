"""Substrings by indexes of grams: keyword search over posting lists, and large dictionaries of names in texts.

Keyword search.  A posting list holds the ids of the texts with a gram of three characters.  An index is a folder of Parquet
files, each sorted by gram for its own texts (grams are numbers), so that a search reads the row groups of its grams only, and a small table of the
lists' lengths.  A text holds a keyword only if it is in the lists of all of the keyword's grams: lists are intersected
from the rarest on, and what is left is verified in the texts themselves.

Dictionaries.  Each name is indexed by the one of its grams (of 8 characters where it is long enough) that the fewest texts have.  Texts meet it where they have
that gram, and only these pairs are verified, whatever the number of names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import written

GRAM = 3
#: Characters of the grams by which names of that length or more meet texts: few texts have one that they need not have.
LONG = 8
#: Texts whose grams a task sorts.
TEXTS = 5000


def grams(text: Column, size: int = GRAM) -> Column:
    """The distinct grams of a text, in time linear in it; none of a shorter one."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1)))


def number_of(gram: str) -> int:
    """The number that stands for a gram: its own up to three characters, else a hash.  Grams of one number only make more to verify."""
    if len(gram) <= 3:
        return sum(ord(x) << 21 * i for i, x in enumerate(gram))
    return int(_numbers(np.array([ord(x) for x in gram], np.uint64), len(gram))[0].astype(np.int64))


def _numbers(points: np.ndarray, size: int) -> np.ndarray:
    """The number of the gram that begins at each code point that has one, as an unsigned one."""
    out = np.zeros(len(points) - size + 1, np.uint64)
    for i in range(size):
        at = points[i : len(points) - size + 1 + i]
        out = out | at << np.uint64(21 * i) if size <= 3 else out * np.uint64(0x9E3779B97F4A7C15) + at
    return out


def numbered(rows: DataFrame, sizes: Sequence[int], of_length: bool = False) -> DataFrame:
    """(id, gram) of rows (id, text): the numbers of the distinct grams of each text, of each size; null texts have none.

    of_length: only those of the largest size that a text has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part, found = batch.slice(at, 200), []
                for text in part.column(1):
                    points = np.frombuffer((text.as_py() or "").encode("utf-32-le"), np.uint32).astype(np.uint64)
                    fit = [s for s in sizes if s <= len(points)]
                    found.append([np.unique(_numbers(points, s)) for s in (fit[-1:] if of_length else fit)])
                times = [sum(map(len, x)) for x in found]
                grams_of = np.concatenate([y for x in found for y in x] or [np.zeros(0, np.uint64)])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.repeat(np.arange(len(times)), times))), pa.array(grams_of.view(np.int64))], ["id", "gram"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, gram bigint")


class KeywordIndex:
    """Posting lists in a folder that driver and executors share: postings/ (gram, id), lengths/ (gram, n)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def build(self, texts: DataFrame, id_col: str, text_col: str, partitions: int | None = None) -> KeywordIndex:
        """Writes the lists of all rows; a null text has none.

        Each task sorts the grams of its own texts, about TEXTS of them: a list lies in parts in all files, so that no gram is
        crowded, and only texts are shuffled.
        """
        rows = texts.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        parts = partitions or max(self.spark.sparkContext.defaultParallelism, -(-rows.count() // TEXTS))
        dealt = numbered(rows.repartition(parts, "id"), [GRAM]).select("gram", "id")
        dealt.sortWithinPartitions("gram", "id").write.option("parquet.block.size", 1 << 20).parquet(f"{self.folder}/postings")
        self.postings().groupBy("gram").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("gram").write.parquet(f"{self.folder}/lengths")
        return self

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/postings")

    def search(self, texts: DataFrame, keywords: Sequence[str], id_col: str, text_col: str) -> DataFrame:
        """The rows of texts that hold all keywords; keywords shorter than a gram are verified only."""
        wanted = sorted({number_of(k[i : i + GRAM]) for k in keywords for i in range(len(k) - GRAM + 1)})
        holds = F.lit(True)
        for k in keywords:
            holds = holds & F.col(text_col).contains(k)
        if not wanted:
            return texts.where(holds)
        lengths = {r.gram: r.n for r in self.spark.read.parquet(f"{self.folder}/lengths").where(F.col("gram").isin(wanted)).collect()}  # as many rows as the keywords have grams
        ids = self.postings().where(F.col("gram") == min(wanted, key=lambda g: lengths.get(g, 0))).select("id")
        for gram in sorted(wanted, key=lambda g: lengths.get(g, 0))[1:]:
            ids = ids.join(self.postings().where(F.col("gram") == gram).select("id"), "id", "left_semi")
        found = written(ids)  # its size is known: texts are only shuffled where many are left
        return texts.join(found.withColumnRenamed("id", id_col), id_col, "left_semi").where(holds)


def names_in_texts(texts: DataFrame, names: DataFrame, id_col: str, text_col: str, name_col: str) -> DataFrame:
    """(id_col, name_col) of the distinct names that stand in each text (id_col unique); null and empty names and null texts
    have none."""
    t = texts.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    listed = names.where(F.col(name_col) != "").select(F.col(name_col).alias("_name")).distinct()
    at = F.when(F.length("_name") >= LONG, LONG).otherwise(F.least(F.length("_name"), F.lit(GRAM)))
    sizes = sorted(r[0] for r in listed.select(at).distinct().collect())  # 1 to GRAM, and LONG
    if not sizes:
        return t.select(F.col("_id").alias(id_col), F.lit(None).cast("string").alias(name_col)).limit(0)
    of_name = written(numbered(listed.select(F.col("_name").alias("id"), F.col("_name").alias("text")), sizes, of_length=True).toDF("_name", "_gram"))
    of_text = numbered(t.select(F.col("_id").alias("id"), F.col("_text").alias("text")), sizes).toDF("_id", "_gram")
    # Only grams of names are kept of the texts' ones, and counted.
    kept = written(of_text.join(written(of_name.select("_gram").distinct()), "_gram", "left_semi"))
    counts = kept.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # A name with a gram that no text has is in none.
    rarest = of_name.join(counts, "_gram", "left").groupBy("_name").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_r")).where("_r.n > 0").select("_name", F.col("_r._gram").alias("_gram"))
    pairs = kept.join(written(rarest), "_gram").select("_id", "_name")
    return written(pairs).join(t, "_id").where(F.col("_text").contains(F.col("_name"))).select(F.col("_id").alias(id_col), F.col("_name").alias(name_col))


def longest_names(texts: DataFrame, names: DataFrame, id_col: str, text_col: str, name_col: str, out: str = "found") -> DataFrame:
    """texts with `out`: the names in each, the longest first, in places that no longer one holds; in order of first place.

    Where a longer name holds all places of a shorter one, the shorter is none: its places are masked first.  Names of equal
    length come in their own order.
    """
    held = names_in_texts(texts, names, id_col, text_col, name_col)
    lists = held.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct((-F.length(name_col)).alias("l"), F.col(name_col).alias("name")))).alias("_names"))
    mask = "\u0000"
    start = F.struct(F.coalesce(F.col(text_col), F.lit("")).alias("rest"), F.array().cast("array<struct<at: int, name: string>>").alias("got"))

    def take(state: Column, item: Column) -> Column:
        at = F.position(item["name"], state["rest"])
        blank = F.repeat(F.lit(mask), F.length(item["name"]))
        hit = F.struct(F.replace(state["rest"], item["name"], blank).alias("rest"), F.concat(state["got"], F.array(F.struct(at.cast("int").alias("at"), item["name"].alias("name")))).alias("got"))
        return F.when(at > 0, hit).otherwise(state)

    got = F.aggregate(F.coalesce("_names", F.array().cast("array<struct<l: int, name: string>>")), start, take, lambda s: F.transform(F.array_sort(s["got"]), lambda x: x["name"]))
    return texts.join(lists, id_col, "left").withColumn(out, got).drop("_names")


def without_names(texts: DataFrame, names: DataFrame, id_col: str, text_col: str, name_col: str, least: int = 3) -> DataFrame:
    """texts with every name of `least` characters or more cut out of the text, the longest first."""
    long = names.where(F.length(name_col) >= least)
    held = names_in_texts(texts, long, id_col, text_col, name_col)
    lists = held.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct((-F.length(name_col)).alias("l"), F.col(name_col).alias("name")))).alias("_names"))
    cut = F.aggregate(F.coalesce("_names", F.array().cast("array<struct<l: int, name: string>>")), F.col(text_col), lambda t, x: F.replace(t, x["name"], F.lit("")))
    return texts.join(lists, id_col, "left").withColumn(text_col, cut).drop("_names")
