"""Queries that merge records into entities: survivorship, votes, unions, dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.offers import price_unit
from ..operators import survivorship as s
from .registry import query
from .tables import SQL_LAT, SQL_LON, lat_of, lon_of, read


def _rank():
    return F.substring("o_orderpriority", 1, 1).cast("int")


@query(
    """SELECT o_custkey AS cust, arg_min(v, (pr, o_orderkey)) FILTER (WHERE v IS NOT NULL AND v <> '') AS first_status, max(o_totalprice) AS top
FROM (SELECT *, CAST(o_orderpriority[1] AS INTEGER) AS pr, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus || (o_orderkey % 3) END AS v FROM orders) GROUP BY o_custkey"""
)
def survivor_first_nonempty(spark, d):
    """Per customer the first present value by priority."""
    k = F.col("o_orderkey")
    v = F.when(k % 7 == 0, None).when(k % 5 == 0, "").otherwise(F.concat("o_orderstatus", (k % 3).cast("string")))
    rows = read(spark, d, "orders").withColumn("v", v)
    return rows.groupBy(F.col("o_custkey").alias("cust")).agg(s.first_present(F.col("v"), _rank(), k).alias("first_status"), F.max("o_totalprice").alias("top"))


@query(
    """WITH v AS (SELECT l_orderkey AS ord, l_returnflag AS f, count(*) AS n, min(l_linenumber) AS first FROM lineitem GROUP BY ALL)
SELECT ord, arg_min(f, (-n, first, f)) AS flag FROM v GROUP BY ord"""
)
def majority_vote_tiebreak(spark, d):
    """The most frequent flag of each order; ties go to the earliest line."""
    out = s.majority(read(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", [F.col("l_linenumber")], "flag")
    return out.select(F.col("l_orderkey").alias("ord"), "flag")


@query(
    f"""WITH r AS (SELECT c_nationkey AS pref, c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN 'site' WHEN 1 THEN 'port' WHEN 2 THEN 'town' WHEN 3 THEN 'city' END AS geo, c_custkey % 2 AS reg FROM customer),
t AS (SELECT *, CASE WHEN reg = 0 AND geo = 'site' THEN 0 WHEN reg = 0 AND geo = 'port' THEN 1 WHEN reg = 0 AND geo = 'town' THEN 2 WHEN reg = 1 AND geo = 'town' THEN 3 WHEN reg = 0 AND geo = 'city' THEN 4 WHEN reg = 1 AND geo = 'city' THEN 5 END AS tier FROM r)
SELECT pref, arg_min(k, (tier, k)) AS chosen, arg_min(geo, (tier, k)) AS geo, round(arg_min({SQL_LAT.format('k')}, (tier, k)), 4) AS lat, round(arg_min({SQL_LON.format('k')}, (tier, k)), 4) AS lon FROM t WHERE tier IS NOT NULL GROUP BY pref"""
)
def tiered_location(spark, d):
    """The position of each area from the most precise pool of sources."""
    k = F.col("c_custkey")
    geo = F.when(k % 5 == 0, "site").when(k % 5 == 1, "port").when(k % 5 == 2, "town").when(k % 5 == 3, "city")
    rows = read(spark, d, "customer").select(F.col("c_nationkey").alias("pref"), k.alias("k"), geo.alias("geo"), (k % 2 == 1).alias("reg"))
    ladder = [(False, "site"), (False, "port"), (False, "town"), (True, "town"), (False, "city"), (True, "city")]
    tier = F.coalesce(*[F.when((F.col("reg") == r) & (F.col("geo") == g), F.lit(i)) for i, (r, g) in enumerate(ladder)])
    best = rows.groupBy("pref").agg(s.tiered(F.struct("k", "geo"), tier, F.col("k")).alias("b"))
    return best.select("pref", F.col("b.k").alias("chosen"), "b.geo", F.round(lat_of(F.col("b.k")), 4).alias("lat"), F.round(lon_of(F.col("b.k")), 4).alias("lon"))


@query(
    """WITH b AS (SELECT o_custkey AS cust, split_part(p_type, ' ', 3) AS t, o_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
f AS (SELECT cust, t, min((o_orderkey, l_linenumber)) AS pos FROM b GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY pos, t) AS n FROM f)
SELECT cust, string_agg(t, ',' ORDER BY n) AS types FROM r WHERE n <= 4 GROUP BY cust"""
)
def ordered_union_capped(spark, d):
    """The first four kinds of material that each customer bought, in order."""
    out = s.ordered_union(_bought(spark, d), ["cust"], "t", ["o_orderkey", "l_linenumber"], 4, "types")
    return out.select("cust", F.array_join("types", ",").alias("types"))


def _bought(spark, d):
    l, o, p = read(spark, d, "lineitem"), read(spark, d, "orders"), read(spark, d, "part")
    rows = l.join(p, F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.col("o_custkey").alias("cust"), F.coalesce(F.get(F.split("p_type", " "), F.lit(2)), F.lit("")).alias("t"), "o_orderkey", "l_linenumber")


@query(
    """WITH b AS (SELECT o_custkey AS cust, split_part(p_type, ' ', 3) AS t, o_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
f AS (SELECT cust, t, count(*) AS c, min((o_orderkey, l_linenumber)) AS pos FROM b GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY c DESC, pos, t) AS n FROM f)
SELECT cust, string_agg(t, ',' ORDER BY n) AS types FROM r WHERE n <= 3 GROUP BY cust"""
)
def frequency_ranked_union(spark, d):
    """The materials that each customer buys most."""
    out = s.ranked_union(_bought(spark, d), ["cust"], "t", ["o_orderkey", "l_linenumber"], 3, "types")
    return out.select("cust", F.array_join("types", ",").alias("types"))


@query(
    """WITH o AS (SELECT l_suppkey AS supp, l_partkey AS part, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS price, l_returnflag AS kind, l_orderkey, l_linenumber FROM lineitem),
a AS (SELECT *, row_number() OVER (PARTITION BY supp, price, kind ORDER BY l_orderkey, l_linenumber, part) AS n FROM o),
b AS (SELECT *, row_number() OVER (PARTITION BY supp ORDER BY l_orderkey, l_linenumber, part) AS m FROM a WHERE n = 1) SELECT supp, price, kind, part, m AS place FROM b WHERE m <= 40"""
)
def distinct_offers_keep_first_cap(spark, d):
    """Offers of each supplier, the first of equal ones, forty at most (the cap is part of the published table)."""
    from pyspark.sql import Window

    l = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("supp"), F.col("l_partkey").alias("part"), F.floor(F.col("l_extendedprice") / 1000).alias("price"), F.col("l_returnflag").alias("kind"), "l_orderkey", "l_linenumber")
    out = s.keep_first(l, ["supp", "price", "kind"], ["l_orderkey", "l_linenumber", "part"], 40, ["supp"])
    return out.withColumn("place", F.row_number().over(Window.partitionBy("supp").orderBy("l_orderkey", "l_linenumber", "part")).cast("bigint")).select("supp", "price", "kind", "part", "place")


@query(
    """WITH o AS (SELECT l_orderkey AS ord, CAST(floor(l_extendedprice) AS BIGINT) AS price, CASE l_returnflag WHEN 'A' THEN '乗合' WHEN 'R' THEN '仕立' END AS kind, CASE WHEN l_linenumber % 2 = 0 THEN '1名 ' ELSE '1隻 ' END AS t FROM lineitem)
SELECT ord, coalesce(min(price) FILTER (WHERE price BETWEEN 1000 AND 80000 AND (kind = '乗合' OR (kind IS NULL AND t = '1名 '))), 0) AS min_price FROM o GROUP BY ord"""
)
def conditional_min_price(spark, d):
    """The lowest fare per person of each entity; 0 without one."""
    kind = F.when(F.col("l_returnflag") == "A", "乗合").when(F.col("l_returnflag") == "R", "仕立")
    text = F.when(F.col("l_linenumber") % 2 == 0, "1名 ").otherwise("1隻 ")
    o = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("ord"), F.floor("l_extendedprice").alias("price"), price_unit(kind, text).alias("unit"))
    fits = F.col("price").between(1000, 80000) & (F.col("unit") == "person")
    return o.groupBy("ord").agg(F.coalesce(F.min(F.when(fits, F.col("price"))), F.lit(0)).cast("bigint").alias("min_price"))


@query(f"SELECT c_nationkey AS pref, round(list_sort(list({SQL_LAT.format('c_custkey')}))[count(*) // 2 + 1], 4) AS lat, round(list_sort(list({SQL_LON.format('c_custkey')}))[count(*) // 2 + 1], 4) AS lon FROM customer GROUP BY c_nationkey")
def upper_median_point(spark, d):
    """The upper median of each axis, per area, from ranks (no area is gathered)."""
    rows = read(spark, d, "customer").select(F.col("c_nationkey").alias("pref"), lat_of(F.col("c_custkey")).alias("la"), lon_of(F.col("c_custkey")).alias("lo"))
    lat, lon = (s.median_by_rank(rows, ["pref"], v, n) for v, n in (("la", "lat"), ("lo", "lon")))
    return lat.join(lon, "pref").select("pref", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"))


@query(
    """WITH t AS (SELECT p_type AS item, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type)
SELECT item, n, CAST(row_number() OVER (ORDER BY n DESC, first, item) - 1 AS INTEGER) AS code FROM t WHERE n >= 3"""
)
def dictionary_encode_min_support(spark, d):
    """Codes of the part types in use, the most frequent first."""
    l, p = read(spark, d, "lineitem"), read(spark, d, "part")
    rows = l.join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_type", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return s.dictionary(rows, "p_type", "at").withColumnRenamed("p_type", "item")


@query(
    """WITH k AS (SELECT c_custkey % 50 AS tel FROM customer GROUP BY 1 HAVING count(DISTINCT c_custkey % 4) > 3), n AS (SELECT c_custkey, c_custkey % 50 AS tel FROM customer)
SELECT tel, count(*) AS n FROM n WHERE tel NOT IN (SELECT tel FROM k) GROUP BY tel"""
)
def shared_key_guard(spark, d):
    """Keys that few names share; the over-shared ones drop out before any pair is made."""
    c = read(spark, d, "customer").select((F.col("c_custkey") % 50).alias("tel"), (F.col("c_custkey") % 4).alias("nkey"))
    return c.join(s.shared_keys(c, "tel", "nkey", 3), "tel", "left_anti").groupBy("tel").agg(F.count("*").alias("n"))
