"""Aggregates that merge the records of an entity: first value by priority, votes, tiers, ordered unions, medians.

All are single aggregations with partial results before the shuffle, unless a window is needed for an order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def present(c: Column, kind: str = "string") -> Column:
    """Neither null nor an empty text or list."""
    if kind == "string":
        return c.isNotNull() & (c != "")
    return c.isNotNull() & (F.size(c) > 0) if kind.startswith("array") else c.isNotNull()


def first_present(c: Column, *order: Column, kind: str = "string") -> Column:
    """Aggregate: the present value that comes first in the order."""
    return F.min_by(F.when(present(c, kind), c), F.when(present(c, kind), F.struct(*order)))


def upper_median(c: Column) -> Column:
    """Aggregate: the middle value, of an even number the upper one."""
    values = F.sort_array(F.collect_list(c))
    return F.get(values, (F.size(values) / 2).cast("int"))


def median_by_rank(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The upper median of each group without gathering a group: ranks by a window, so a large group is sorted, not held."""
    w = Window.partitionBy(*keys)
    ranked = rows.where(F.col(value).isNotNull()).withColumn("_rank", F.row_number().over(w.orderBy(value))).withColumn("_n", F.count(F.lit(1)).over(w))
    return ranked.where(F.col("_rank") == F.floor(F.col("_n") / 2) + 1).select(*keys, F.col(value).alias(name))


def majority(rows: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column], name: str) -> DataFrame:
    """The most frequent value of each group; of equally frequent ones that which comes first in the order."""
    votes = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_first"))
    return votes.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col("_first"), F.col(value))).alias(name))


def tiered(value: Column, tier: Column, *order: Column) -> Column:
    """Aggregate: the value of the best (smallest) tier, then first in the order; rows without a tier don't count."""
    return F.min_by(F.when(tier.isNotNull(), value), F.when(tier.isNotNull(), F.struct(tier, *order)))


def ordered_union(rows: DataFrame, keys: Sequence[str], item: str, order: Sequence[str], most: int, name: str) -> DataFrame:
    """The distinct items of each group by their first place in the order, at most so many, as an array."""
    firsts = rows.where(F.col(item).isNotNull()).groupBy(*keys, item).agg(F.min(F.struct(*order)).alias("_at"))
    w = Window.partitionBy(*keys).orderBy("_at", item)
    kept = firsts.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    return kept.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", item))), lambda x: x[item]).alias(name))


def ranked_union(rows: DataFrame, keys: Sequence[str], item: str, order: Sequence[str], most: int, name: str) -> DataFrame:
    """The distinct items of each group by how often they occur, then by first place, at most so many, as an array."""
    counts = rows.where(F.col(item).isNotNull()).groupBy(*keys, item).agg(F.count(F.lit(1)).alias("_times"), F.min(F.struct(*order)).alias("_at"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_times"), "_at", item)
    kept = counts.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    return kept.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", item))), lambda x: x[item]).alias(name))


def keep_first(rows: DataFrame, identity: Sequence[str], order: Sequence, most: int | None = None, within: Sequence[str] = ()) -> DataFrame:
    """The first row of each identity; of these at most so many in each group `within`, by the same order."""
    out = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*identity).orderBy(*order))).where("_n = 1")
    if most is not None:
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).where(F.col("_n") <= most)
    return out.drop("_n")


def shared_keys(rows: DataFrame, key: str, value: str, most: int) -> DataFrame:
    """The keys that more than so many distinct values share."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(value).alias("_n")).where(F.col("_n") > most).select(key)


def dictionary(rows: DataFrame, item: str, order: str, least: int = 3) -> DataFrame:
    """(item, n, code) of the items that occur often enough; codes from 0 by frequency, then first place."""
    counts = rows.where(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_first")).where(F.col("n") >= least)
    # One row for each distinct item: a dictionary is small by its use, and its codes need one order.
    return counts.withColumn("code", (F.row_number().over(Window.orderBy(F.desc("n"), "_first", item)) - 1).cast("int")).drop("_first")


def owned(rows: DataFrame, value: str, owner: str) -> DataFrame:
    """(value, owner) of the owners that use a value more often than, or as often as, any other."""
    uses = rows.where(F.col(value).isNotNull()).groupBy(value, owner).agg(F.count(F.lit(1)).alias("_n"))
    most = uses.groupBy(value).agg(F.max("_n").alias("_top"))
    return uses.join(most, value).where("_n = _top").select(value, owner)


def used_in_one(rows: DataFrame, value: str, group: str, order: str) -> DataFrame:
    """rows with the value null where it first belongs to another group."""
    first = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.min_by(group, order).alias("_group"))
    return rows.join(first, value, "left").withColumn(value, F.when(F.col("_group") == F.col(group), F.col(value))).drop("_group")


def first_by(value: Column, rank: Column) -> Column:
    """Aggregate: the value of the smallest rank; nulls don't count."""
    return F.min_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), rank))


def grouped(rows: DataFrame, keys: Sequence[str], order: str, item: str) -> DataFrame:
    """(place, keys, items, distinct_items): rows of equal keys as one, in the order in which they first come; for groups of a
    page or a list, whose items are few."""
    lists = rows.groupBy(*keys).agg(F.min(order).alias("_first"), F.transform(F.sort_array(F.collect_list(F.struct(order, item))), lambda x: x[item]).alias("items"))
    return lists.select(F.row_number().over(Window.orderBy("_first")).alias("place"), *keys, "items", F.array_distinct("items").alias("distinct_items"))
