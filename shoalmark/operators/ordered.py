"""Operators on ordered rows as windows over a group: fill, runs, context, numbering, budgets, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def over(keys: Sequence[str], order: Sequence) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def forward_fill(value: Column, w: WindowSpec) -> Column:
    return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def back_fill(value: Column, w: WindowSpec) -> Column:
    return F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))


def section(starts: Column, w: WindowSpec) -> Column:
    """The number of the section that a row lies in, each from a row that starts one."""
    return F.sum(starts.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")


def islands(value: Column, w: WindowSpec) -> Column:
    """The number of the run of neighbouring equal values that a row lies in."""
    return section(~value.eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1), w)


def context(matches: Column, w: WindowSpec, around: int = 2) -> Column:
    """A row within so many rows matches."""
    return F.max(matches).over(w.rowsBetween(-around, around))


def repeats_previous(value: Column, w: WindowSpec) -> Column:
    return F.coalesce(value == F.lag(value).over(w), F.lit(False))


def trailing(value: Column, w: WindowSpec, n: int) -> Column:
    """The values of the n rows before."""
    return F.collect_list(value).over(w.rowsBetween(-n, -1))


def numbered_label(label: Column, w: WindowSpec) -> Column:
    """A label, from its second row on with the number of the row behind it."""
    n = F.row_number().over(w)
    return F.when(n > 1, F.concat(label, F.lit("("), n.cast("string"), F.lit(")"))).otherwise(label)


def spiral(rows: DataFrame, id_col: str, lat: str, lon: str, places: int = 4) -> DataFrame:
    """Rows at one rounded place moved apart on a spiral, in the order of their ids; the first stays."""
    w = over(["_la", "_lo"], [id_col])
    i = F.row_number().over(w) - 1
    out = rows.withColumn("_la", F.round(lat, places)).withColumn("_lo", F.round(lon, places)).withColumn("_i", i.cast("double"))
    radius, angle = F.sqrt("_i") * 0.00028, F.col("_i") * 2.39996
    out = out.withColumn(lat, F.when(F.col("_i") > 0, F.bround(F.col(lat) + radius * F.sin(angle), 6)).otherwise(F.col(lat)))
    moved = F.bround(F.col(lon) + radius * F.cos(angle) / F.cos(F.radians(lat)), 6)
    return out.withColumn(lon, F.when(F.col("_i") > 0, moved).otherwise(F.col(lon))).drop("_la", "_lo", "_i")


def budget(rows: DataFrame, keys: Sequence[str], order: Sequence, size: str, total: int) -> DataFrame:
    """Rows in order while what came before leaves room in the budget; the size that still fits as `taken`."""
    before = F.coalesce(F.sum(size).over(over(keys, order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_room", F.lit(total) - before).where("_room > 0").withColumn("taken", F.least(F.col(size), F.col("_room"))).drop("_room")


def top_n(rows: DataFrame, keys: Sequence[str], order: Sequence, n: int) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(over(keys, order))).where(F.col("_n") <= n).drop("_n")


def round_robin(rows: DataFrame, group: str, order: Sequence, n: int, stride: int = 1) -> DataFrame:
    """The first n rows when groups give one row in turn, each its every stride-th."""
    out = rows.withColumn("_k", F.row_number().over(over([group], order)) - 1).where(F.col("_k") % stride == 0)
    return out.orderBy((F.col("_k") / stride).cast("int"), group).limit(n).drop("_k")


def missing_numbers(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """(keys, number) of the numbers from 1 to the largest of each group that it lacks.

    Only the gaps between neighbours are expanded, not whole ranges.
    """
    w = over(keys, [number])
    gaps = rows.select(*keys, number).distinct().withColumn("_before", F.coalesce(F.lag(number).over(w), F.lit(0)))
    gaps = gaps.where(F.col(number) > F.col("_before") + 1)
    return gaps.select(*keys, F.explode(F.sequence(F.col("_before") + 1, F.col(number) - 1)).alias(number))


def trimmed_extent(rows: DataFrame, value: str, share: float = 0.1, gap: float = 3.0) -> DataFrame:
    """(low, high): the range of the values without outliers, at most that share of each side cut off at gaps.

    A gap lies between two cells of a third of its width, so one pass that counts each cell is all that reads the
    rows; the cells are at most three times the range over the gap.
    """
    v = rows.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    cells = v.groupBy(F.floor(F.col("v") / (gap / 3)).alias("c")).agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count(F.lit(1)).alias("n"))
    up, down = Window.orderBy("c"), Window.orderBy(F.desc("c"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    most = F.floor(F.sum("n").over(Window.partitionBy()) * share)
    low = F.when((F.col("a") - F.lag("b").over(up) >= gap) & (before(up) <= most), F.col("a"))
    high = F.when((F.lag("a").over(down) - F.col("b") >= gap) & (before(down) <= most), F.col("b"))
    cells = cells.select("a", "b", low.alias("low"), high.alias("high"))
    return cells.agg(F.coalesce(F.max("low"), F.min("a")).alias("low"), F.coalesce(F.min("high"), F.max("b")).alias("high"))


def placed(rows: DataFrame, lat: str = "lat", area: str = "pref") -> DataFrame:
    """rows with `placed`: whether they have a position and an area."""
    return rows.withColumn("placed", F.col(lat).isNotNull() & (F.coalesce(area, F.lit("")) != ""))


def by_use(rows: DataFrame, key: str) -> DataFrame:
    """(place, key, n): the values of a key, the most used first; one row a value, so that the order is over a vocabulary."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), key)))


def by_parts(rows: DataFrame, code: str, mark: str) -> DataFrame:
    """rows with `place` in the order of a code's parts: its text, then its number."""
    text, number = F.substring_index(code, mark, 1), F.substring_index(code, mark, -1).try_cast("int")
    ranked = rows.withColumn("_text", text).withColumn("_number", number)
    within = F.row_number().over(over(["_text"], ["_number", code]))
    sizes = ranked.groupBy("_text").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_text").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranked.withColumn("_within", within).join(before, "_text").withColumn("place", (F.col("_within") + F.col("_before")).cast("int")).drop("_text", "_number", "_within", "_size", "_before")
