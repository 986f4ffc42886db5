"""Queries of the lookup, anti, completion and imputation joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookup
from .registry import query
from .tables import SQL_LAT, SQL_LON, lat_of, lon_of, read


@query(
    """WITH t AS (SELECT 'n' || n_nationkey AS k, n_name AS v FROM nation WHERE n_name < 'M' UNION ALL SELECT 'r' || r_regionkey, r_name FROM region WHERE r_name <> 'EUROPE'),
q AS (SELECT c_custkey AS id, unnest(['c' || c_custkey, 'n' || c_nationkey, 'r' || (c_nationkey % 5)]) AS k, unnest([0, 1, 2]) AS pos FROM customer),
h AS (SELECT id, arg_min(k, pos) AS query, arg_min(v, pos) AS v FROM q JOIN t USING (k) GROUP BY id) SELECT c_custkey AS id, query, v FROM customer LEFT JOIN h ON id = c_custkey"""
)
def lookup_cascade_first_hit(spark, d):
    """The most exact of a customer's lookups that the gazetteer knows."""
    n, r, c = read(spark, d, "nation"), read(spark, d, "region"), read(spark, d, "customer")
    t = n.where("n_name < 'M'").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("k"), F.col("n_name").alias("v"))
    t = t.unionByName(r.where("r_name <> 'EUROPE'").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("k"), F.col("r_name").alias("v")))
    text = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    asked = F.array(text("c", F.col("c_custkey")), text("n", F.col("c_nationkey")), text("r", F.col("c_nationkey") % 5))
    return lookup.first_hit(c.select(F.col("c_custkey").alias("id"), asked.alias("asked")), "id", "asked", t, "k", ["v"])


@query(
    f"""WITH s AS (SELECT s_suppkey AS id, s_nationkey AS port, {SQL_LAT.format('s_suppkey')} AS la, {SQL_LON.format('s_suppkey')} AS lo FROM supplier),
p AS (SELECT a.id, list_sort(list(b.la)) AS las, list_sort(list(b.lo)) AS los FROM s a JOIN s b ON a.port = b.port AND a.id <> b.id GROUP BY a.id)
SELECT s.id, coalesce(len(las), 0) AS n, round(las[len(las) // 2 + 1], 4) AS la, round(los[len(los) // 2 + 1], 4) AS lo FROM s LEFT JOIN p ON s.id = p.id"""
)
def leave_one_out_median(spark, d):
    """For each place the median position of the others at its port, from ranks instead of all pairs."""
    k = F.col("s_suppkey")
    s = read(spark, d, "supplier").select(k.alias("id"), F.col("s_nationkey").alias("port"), lat_of(k).alias("la"), lon_of(k).alias("lo"))
    out = lookup.others_median(s, "id", "port", ["la", "lo"])
    return out.select("id", "n", F.round("la", 4).alias("la"), F.round("lo", 4).alias("lo"))


@query(
    """SELECT o_custkey AS cust, count(*) AS stale FROM orders a WHERE year(o_orderdate) = 1996 AND NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND year(b.o_orderdate) = 1997) GROUP BY o_custkey"""
)
def season_anti_join(spark, d):
    """Customers of one year's list that are missing from the next."""
    o = read(spark, d, "orders")
    now = o.where(F.year("o_orderdate") == 1997).select("o_custkey")
    return o.where(F.year("o_orderdate") == 1996).join(now, "o_custkey", "left_anti").groupBy(F.col("o_custkey").alias("cust")).agg(F.count("*").alias("stale"))


@query("SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995")
def except_listed(spark, d):
    """Ids that the index has and no list names."""
    return read(spark, d, "customer").select(F.col("c_custkey").alias("id")).exceptAll(read(spark, d, "orders").where(F.year("o_orderdate") == 1995).select(F.col("o_custkey").alias("id")).distinct())


@query(
    """SELECT s_suppkey AS k, s_name AS name, 'a' AS list FROM supplier UNION ALL SELECT c_custkey, c_name, 'b' FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)"""
)
def full_outer_completion(spark, d):
    """One list, completed by the rows that only the other has."""
    a = read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit("a").alias("list"))
    b = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.lit("b").alias("list"))
    return lookup.completed(a, b, ["k"])


@query(
    """WITH r AS (SELECT c_custkey AS id, c_custkey % 40 AS city, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 40 < 20 THEN c_custkey % 40 ELSE c_nationkey END AS pref FROM customer),
f AS (SELECT city, min(pref) AS sole FROM r WHERE pref IS NOT NULL GROUP BY city HAVING count(DISTINCT pref) = 1) SELECT id, city, CAST(coalesce(pref, sole) AS BIGINT) AS pref FROM r LEFT JOIN f USING (city)"""
)
def fd_imputation(spark, d):
    """Missing areas filled in where all other rows of the city agree."""
    k = F.col("c_custkey")
    pref = F.when(k % 4 == 0, None).when(k % 40 < 20, k % 40).otherwise(F.col("c_nationkey").cast("bigint"))
    rows = read(spark, d, "customer").select(k.alias("id"), (k % 40).alias("city"), pref.alias("p"))
    return lookup.imputed(rows, "city", "p", "pref").select("id", "city", "pref")


@query(
    """WITH a AS (SELECT o_custkey AS c, o_orderpriority AS p, min(o_orderkey) AS k, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), b AS (SELECT o_custkey AS c, o_orderpriority AS p, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL)
SELECT a.c AS cust, a.p AS priority, a.k AS id, greatest(a.v, b.v) AS price FROM a JOIN b ON a.c = b.c AND a.p = b.p WHERE a.v > 1000 OR b.v > 1000"""
)
def cross_list_merge(spark, d):
    """Rows of two lists of one source that name the same entity, merged."""
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("priority"), "o_orderstatus", "o_orderkey", "o_totalprice")
    a = o.where("o_orderstatus = 'F'").groupBy("cust", "priority").agg(F.min("o_orderkey").alias("id"), F.max("o_totalprice").alias("va"))
    b = o.where("o_orderstatus = 'O'").groupBy("cust", "priority").agg(F.max("o_totalprice").alias("vb"))
    return a.join(b, ["cust", "priority"]).where("va > 1000 OR vb > 1000").select("cust", "priority", "id", F.greatest("va", "vb").alias("price"))


@query(
    """WITH p AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 9500 THEN NULL ELSE c_name END AS name, c_mktsegment AS kind FROM customer WHERE c_acctbal > 9000)
SELECT c_custkey AS id, CASE WHEN p.id IS NOT NULL THEN p.name ELSE c_name END AS name, CASE WHEN p.id IS NOT NULL THEN p.kind || '!' ELSE c_mktsegment END AS kind FROM customer LEFT JOIN p ON p.id = c_custkey WHERE c_acctbal >= -900"""
)
def overrides_apply(spark, d):
    """Rows dropped by a list, and fields set by hand, also to null."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kind"), "c_acctbal")
    drop = c.where("c_acctbal < -900").select("id")
    patch = c.where("c_acctbal > 9000").select("id", F.when(F.col("c_acctbal") <= 9500, F.col("name")).alias("name"), F.concat("kind", F.lit("!")).alias("kind"), F.lit(True).alias("set_name"), F.lit(True).alias("set_kind"))
    return lookup.patched(c.join(drop, "id", "left_anti").drop("c_acctbal"), patch, "id", ["name", "kind"])


@query("SELECT l_orderkey AS ord, l_linenumber AS line, s AS slot FROM lineitem, (SELECT unnest(['a', 'b', 'c']) AS s)")
def kinds_by_sessions(spark, d):
    """Each offer with each session (nested explode, no cross join)."""
    l = read(spark, d, "lineitem")
    return l.select(F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("line"), F.explode(F.array(*map(F.lit, "abc"))).alias("slot"))


@query(
    """WITH o AS (SELECT o_custkey AS cust, bool_or(o_orderstatus <> 'F') AS alive, bool_or(o_orderpriority LIKE '1%') AS booked, max(o_orderdate) AS seen FROM orders GROUP BY 1)
SELECT cust, alive, booked, CASE WHEN alive THEN CAST(seen AS DATE) END AS site FROM o WHERE alive OR booked"""
)
def closed_filter_with_exception(spark, d):
    """Closed entities go unless a booking source still has them; those only lose their site."""
    o = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("cust")).agg(F.bool_or(F.col("o_orderstatus") != "F").alias("alive"), F.bool_or(F.col("o_orderpriority").like("1%")).alias("booked"), F.max("o_orderdate").alias("seen"))
    return o.where("alive OR booked").select("cust", "alive", "booked", F.when(F.col("alive"), F.to_date("seen")).alias("site"))


@query("SELECT o_custkey AS cust, count(*) AS n FROM orders GROUP BY 1 HAVING bool_or(o_orderdate >= TIMESTAMP '1997-01-01')")
def stale_only_clusters(spark, d):
    """Entities of which some record isn't stale."""
    o = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("cust")).agg(F.count("*").alias("n"), F.bool_or(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp")).alias("fresh"))
    return o.where("fresh").drop("fresh")
