"""Stand-ins for the directory's tables over the driver's tables, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dims import FLAGS


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lat_of(key: Column) -> Column:
    return F.lit(24) + (key * 37 % 2150) / F.lit(100.0)


def lon_of(key: Column) -> Column:
    return F.lit(123) + (key * 91 % 2250) / F.lit(100.0)


SQL_LAT = "24 + ({0} * 37 % 2150) / 100.0::DOUBLE"
SQL_LON = "123 + ({0} * 91 % 2250) / 100.0::DOUBLE"


def places(spark: SparkSession, sf_dir: str, missing: int = 7) -> DataFrame:
    """Customers as listings: (id, name, key, pref, la, lo); every so many-th has no position."""
    c = read(spark, sf_dir, "customer")
    there = F.col("c_custkey") % missing != 0
    return c.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_custkey") % 97).alias("key"), F.col("c_nationkey").alias("pref"),
        F.when(there, lat_of(F.col("c_custkey"))).alias("la"), F.when(there, lon_of(F.col("c_custkey"))).alias("lo"),
    )


SQL_PLACES = f"""places AS (SELECT c_custkey AS id, c_name AS name, c_custkey % 97 AS key, c_nationkey AS pref,
  CASE WHEN c_custkey % 7 <> 0 THEN {SQL_LAT.format('c_custkey')} END AS la, CASE WHEN c_custkey % 7 <> 0 THEN {SQL_LON.format('c_custkey')} END AS lo FROM customer)"""

SQL_DIST = "sqrt(power(radians({3} - {1}) * cos(radians(({0} + {2}) / 2)), 2) + power(radians({2} - {0}), 2)) * 6371.0"


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search table: customers as entities, their nation and region as area, the types of parts bought as targets."""
    c, n, r = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    entities = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    cents = F.greatest(F.lit(0), F.floor(F.col("c_acctbal")).cast("int"))
    flags = F.when(F.col("c_acctbal") > 0, FLAGS["PLANS"]).otherwise(0) + F.when(F.col("c_custkey") % 3 == 0, FLAGS["WEB"]).otherwise(0)
    flags = flags + F.when(F.col("c_mktsegment") == "BUILDING", FLAGS["NORIAI"]).when(F.col("c_mktsegment") == "MACHINERY", FLAGS["SHITATE"]).when(F.col("c_mktsegment") == "FURNITURE", FLAGS["TOSEN"]).otherwise(0)
    k = F.col("c_custkey")
    words = F.array(*[F.concat(F.lit("t"), ((k * m) % 11).cast("string")) for m in (1, 3, 7)])
    out = entities.select(
        k.alias("idx"), F.col("c_name").alias("name"), F.lower(F.concat_ws(" ", "c_name", "n_name", "c_mktsegment")).alias("text"), (F.col("c_nationkey") + 1).alias("pref"), F.col("r_name").alias("region"),
        flags.cast("int").alias("flags"), cents.alias("price"), F.array_distinct(words).alias("targets"), lat_of(k).alias("lat"), lon_of(k).alias("lon"),
    )
    cat = F.when(F.col("flags").bitwiseAND(FLAGS["PLANS"]) != 0, 0).when(F.col("flags").bitwiseAND(FLAGS["WEB"] | FLAGS["LISTED"]) != 0, 1).otherwise(2)
    return out.withColumn("cat", cat)


SQL_INDEX = f"""raw AS (SELECT c_custkey AS idx, c_name AS name, lower(concat_ws(' ', c_name, n_name, c_mktsegment)) AS text, c_nationkey + 1 AS pref, r_name AS region,
    CAST((CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) + (CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 0 END)
       + (CASE c_mktsegment WHEN 'BUILDING' THEN 8 WHEN 'MACHINERY' THEN 16 WHEN 'FURNITURE' THEN 32 ELSE 0 END) AS INTEGER) AS flags,
    CAST(greatest(0, floor(c_acctbal)) AS INTEGER) AS price,
    ['t' || (c_custkey % 11), 't' || (c_custkey * 3 % 11), 't' || (c_custkey * 7 % 11)] AS targets,
    {SQL_LAT.format('c_custkey')} AS lat, {SQL_LON.format('c_custkey')} AS lon
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
idx AS (SELECT *, CASE WHEN flags & 1 <> 0 THEN 0 WHEN flags & 258 <> 0 THEN 1 ELSE 2 END AS cat FROM raw)"""
