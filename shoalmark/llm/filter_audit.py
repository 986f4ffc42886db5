"""How filters act together: for every order of them, what each step removes, and what of it only this filter finds.

Filters are conditions under which a document fails.  One of them, a copy of a document with a smaller id, is found by
refining partitions: documents are parted by their length in code points, then by the hash of their first block, their
second, and so on, and a document alone in its part is dropped.  What is left is compared as whole texts.  Each
document then is a mask of the filters that it fails; masks are counted for each part of the table, and all orders are read
off these counts, of which a part has 32 at most.

Texts are read twice and never shuffled but for the comparison, where equal texts of a task become one row first.  The
refinement works on ids, keys and block hashes.  Rounds of blocks that grow fourfold: a text of n code points has about
log4(n / 512) of them.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

SPACES = r"[\x20\x09-\x0D]+"
#: Code points of the first block; each further one has four times as many.
FIRST_BLOCK = 512
FILTERS = "ABCDE"
#: The filter that refinement decides.
COPIES = "E"


def fails(text: Column) -> dict[str, Column]:
    """The conditions of A to D over a text that isn't null."""
    words = F.array_remove(F.split(text, SPACES), "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def block_hashes(text: Column, hashed: Callable[[Column], Column]) -> Column:
    """The hashes of a text's successive blocks; texts of equal length have as many."""
    blocks = 3 * F.ceil(F.length(text) / FIRST_BLOCK)  # blocks 1, 4, 16, ... of the first one's size reach 4**k > blocks
    n = F.when(blocks == 0, 0).otherwise(F.floor((F.length(F.bin(blocks)) + 1) / 2)).cast("int")

    def block(i: Column) -> Column:
        size = F.pow(F.lit(4.0), i)
        return hashed(F.substring(text, (FIRST_BLOCK * (size - 1) / 3 + 1).cast("int"), (FIRST_BLOCK * size).cast("int")))

    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), block))


def last_key(length: Column, blocks: Column) -> Column:
    """The key of a document after all rounds."""
    return F.aggregate(blocks, length.cast("long"), lambda key, block: F.xxhash64(key, block))


def copy_classes(small: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal texts: (key, least) for the keys whose texts are all equal, with the smallest id; and the other keys,
    whose different texts share all hashes.

    small: (id, length, blocks); texts: (id, key, text) of the same rows, key by last_key.
    """
    alive = small.select(F.col("length").cast("long").alias("key"), "blocks")
    done = 0
    while True:
        # Keys held more than once; as a table of their own they meet the rows in a plain join that splits crowded keys.
        several = written(alive.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
        rest = alive.join(several, "key", "left_semi")
        deepest = rest.agg(F.max(F.size("blocks"))).first()[0]
        if deepest is None or deepest <= done:
            break
        done += 1
        key = F.when(F.size("blocks") >= done, F.xxhash64("key", F.get("blocks", F.lit(done - 1)))).otherwise(F.col("key"))
        alive = written(rest.select(key.alias("key"), "blocks"))
    # Equal texts of a task are one row before the shuffle; the text goes when it has been compared.
    compared = texts.groupBy("key", "text").agg(F.min("id").alias("least")).select("key", "least").join(several, "key", "left_semi")
    classes = written(compared.groupBy("key").agg(F.count(F.lit(1)).alias("texts"), F.min("least").alias("least")))
    return classes.where("texts = 1").select("key", "least"), classes.where("texts > 1").select("key")


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(id, part, mask) for each row of docs: bit i of mask is set where the document fails filter i of ABCDE.

    A null text is empty, a null part an empty string.  A document with a null id is no copy and has none, as its id is
    neither smaller nor larger than another; rows that repeat an id and a text are not copies of each other.
    hashed: the hash of a block; whatever it is, only equal texts are copies.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bits = [F.when(c, 1 << FILTERS.index(f)).otherwise(0) for f, c in fails(F.col("text")).items()]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask + b
    blocks = block_hashes(F.col("text"), hashed)
    small = written(rows.select("id", "part", mask.alias("mask"), F.length("text").alias("length"), blocks.alias("blocks")))
    texts = rows.select("id", "text", last_key(F.length("text"), blocks).alias("key"))
    one, mixed = copy_classes(small, texts)
    copy = 1 << FILTERS.index(COPIES)

    def marked(x: DataFrame) -> DataFrame:
        return x.select("id", "part", F.when(F.col("id") > F.col("least"), F.col("mask") + copy).otherwise(F.col("mask")).alias("mask"))

    keyed = small.select("id", "part", "mask", last_key(F.col("length"), F.col("blocks")).alias("key"))
    if mixed.isEmpty():
        return marked(keyed.join(one, "key", "left"))
    # Different texts with equal hashes: these rows are matched by their texts.
    held = rows.withColumn("mask", mask).withColumn("key", last_key(F.length("text"), blocks)).join(mixed, "key", "left_semi")
    least = written(held.groupBy("key", "text").agg(F.min("id").alias("least")))
    return marked(keyed.join(mixed, "key", "left_anti").join(one, "key", "left")).unionByName(marked(held.join(least, ["key", "text"])))


def interactions(counted: DataFrame) -> DataFrame:
    """Every order and step for the mask counts (part, mask, n, good, toxic): see op13_filter_audit for the columns."""
    steps = [(order, k + 1, order[k], sum(1 << FILTERS.index(f) for f in order[:k]), 1 << FILTERS.index(order[k])) for order in map("".join, permutations(FILTERS)) for k in range(len(FILTERS))]
    fixed = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(f).alias("filter"), F.lit(b).alias("before"), F.lit(x).alias("bit")) for o, k, f, b, x in steps])
    each = counted.withColumn("at", F.explode(fixed)).select("*", "at.*")
    fails_it, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(what: Column, of: Column) -> Column:
        return F.coalesce(F.sum(F.when(what, of)), F.lit(0)).cast("long")

    first = total(fails_it, F.col("n") * F.floor(F.lit(120) / F.greatest(F.bit_count("mask"), F.lit(1))))  # of 120 orders, each failed filter is first in as many
    return each.groupBy("part", "filter_order", "step", "filter").agg(
        total(~fails_it & ~earlier, F.col("n")).alias("kept"),
        total(fails_it & ~earlier, F.col("n")).alias("removed"),
        total(fails_it & earlier, F.col("n")).alias("redundant"),
        total(F.col("mask") == F.col("bit"), F.col("n")).alias("unique_fails"),
        total(fails_it & ~earlier, F.col("good")).alias("good_lost"),
        total(fails_it & ~earlier, F.col("toxic")).alias("toxic_lost"),
        first.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The interactions of all orders of the filters in each part of docs.

    labels: (id_col, quality, toxic); a document is good or toxic if any of its labels says so.  Repeated rows count as
    often as they stand.  An empty docs gives no row, an empty labels zeros.  Other columns are not read.
    """
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = masks(docs, id_col, text_col, part_col, hashed).join(marks, "id", "left")
    counted = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return interactions(counted)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), f AS (
  SELECT part, (len(words) < 100) AS a, (100 * len(list_distinct(words)) < 80 * len(words)) AS b,
    (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t)) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1) AS toxic
  FROM d
), g AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS failed,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL
), l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT l1.x || l2.x || l3.x || l4.x || l5.x AS filter_order FROM l l1, l l2, l l3, l l4, l l5
  WHERE len(list_distinct([l1.x, l2.x, l3.x, l4.x, l5.x])) = 5
), s AS (
  SELECT filter_order, step::INTEGER AS step, substr(filter_order, step::BIGINT, 1) AS filter, string_split(left(filter_order, step::BIGINT - 1), '') AS before
  FROM o, range(1, 6) r(step)
), x AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (NOT list_contains(failed, filter) AND NOT list_has_any(failed, before)), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (list_contains(failed, filter) AND NOT list_has_any(failed, before)), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (list_contains(failed, filter) AND list_has_any(failed, before)), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = [filter]), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (list_contains(failed, filter) AND NOT list_has_any(failed, before)), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (list_contains(failed, filter) AND NOT list_has_any(failed, before)), 0)::BIGINT AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, filter
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM x
"""
