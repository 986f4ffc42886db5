"""Lookup joins: first hit of ordered candidates, leave-one-out peers, imputation from functional dependencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_hit(rows: DataFrame, id_col: str, candidates: str, table: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """(id, query, values) of the first of a row's candidate keys that the table has; all null where none has."""
    asked = rows.select(id_col, F.posexplode(candidates).alias("_at", "query"))
    hits = asked.join(table.withColumnRenamed(key, "query"), "query")
    best = hits.groupBy(id_col).agg(F.min_by(F.struct("query", *values), "_at").alias("_hit"))
    return rows.select(id_col).join(best, id_col, "left").select(id_col, "_hit.query", *[f"_hit.{v}" for v in values])


def others_median(rows: DataFrame, id_col: str, key: str, values: Sequence[str]) -> DataFrame:
    """(id, n, values): the upper median of each value over the other rows of the same key, and how many they are.

    From ranks in the key: without the row itself, the middle is the row at n // 2 of the rest, so one window per value
    gives what a join of all pairs would.
    """
    from pyspark.sql import Window

    out = rows.select(id_col, key, *values)
    size = Window.partitionBy(key)
    out = out.withColumn("_n", F.count(F.lit(1)).over(size))
    for v in values:
        w = Window.partitionBy(key).orderBy(v, id_col)
        half = F.floor((F.col("_n") - 1) / 2).cast("int")  # place of the middle among the others, from 0
        out = out.withColumn("_r", F.row_number().over(w) - 1)
        # The values at two places of the sorted key: the middle if the row stands behind it, the next if before.
        mid = Window.partitionBy(key)
        a, b = F.max(F.when(F.col("_r") == half, F.col(v))).over(mid), F.max(F.when(F.col("_r") == half + 1, F.col(v))).over(mid)
        out = out.withColumn(f"_m_{v}", F.when(F.col("_n") > 1, F.when(F.col("_r") <= half, b).otherwise(a)))
    return out.select(id_col, (F.col("_n") - 1).alias("n"), *[F.col(f"_m_{v}").alias(v) for v in values])


def imputed(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """rows with the column `name`: the value, or where it is null the only value that its key has elsewhere."""
    only = rows.where(F.col(value).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias("_least"), F.max(value).alias("_most")).where("_least = _most").select(key, "_least")
    return rows.join(only, key, "left").withColumn(name, F.coalesce(value, "_least")).drop("_least")


def completed(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """All rows of left, and the rows of right whose key left lacks."""
    return left.unionByName(right.join(left.select(*on), [*on], "left_anti"), allowMissingColumns=True)


def patched(rows: DataFrame, patch: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """rows with the columns that the patch sets; it has set_<column> booleans, so that a null can be set too."""
    p = patch.select(F.col(id_col), *[F.col(c).alias(f"_p_{c}") for c in columns], *[F.col(f"set_{c}") for c in columns])
    out = rows.join(p, id_col, "left")
    for c in columns:
        out = out.withColumn(c, F.when(F.col(f"set_{c}"), F.col(f"_p_{c}")).otherwise(F.col(c)))
    return out.drop(*[f"_p_{c}" for c in columns], *[f"set_{c}" for c in columns])
