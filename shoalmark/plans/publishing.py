"""Queries of the published tables and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import FLAGS
from .registry import query
from .tables import read


@query(
    """WITH a AS (SELECT o_custkey AS cust, bool_or(o_totalprice > 100000) AS plans, bool_or(o_orderstatus = 'F') AS web, bool_or(o_orderpriority LIKE '1%') AS book, bool_and(o_orderstatus = 'O') AS reg, count(*) AS n FROM orders GROUP BY 1)
SELECT cust, CAST((CASE WHEN plans THEN 1 ELSE 0 END) + (CASE WHEN web THEN 2 ELSE 0 END) + (CASE WHEN book THEN 4 ELSE 0 END) + (CASE WHEN reg THEN 64 ELSE 0 END) + (CASE WHEN NOT web AND NOT reg THEN 256 ELSE 0 END) AS INTEGER) AS flags, n FROM a"""
)
def flags_bitmask(spark, d):
    """The flags of each entity from its records."""
    o = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("cust")).agg(
        F.bool_or(F.col("o_totalprice") > 100000).alias("plans"), F.bool_or(F.col("o_orderstatus") == "F").alias("web"), F.bool_or(F.col("o_orderpriority").like("1%")).alias("book"), F.bool_and(F.col("o_orderstatus") == "O").alias("reg"), F.count("*").alias("n"),
    )
    bits = {"PLANS": F.col("plans"), "WEB": F.col("web"), "BOOK": F.col("book"), "REG": F.col("reg"), "LISTED": ~F.col("web") & ~F.col("reg")}
    flags = sum((F.when(c, FLAGS[k]).otherwise(0) for k, c in bits.items()), F.lit(0))
    return o.select("cust", flags.cast("int").alias("flags"), "n")


@query("SELECT c_custkey AS id, row_number() OVER (ORDER BY c_nationkey, -(c_custkey % 13), c_name) AS place FROM customer")
def publish_order(spark, d):
    """The build order of all entities: by area, number of offers, name."""
    from pyspark.sql import Window

    c = read(spark, d, "customer").withColumn("n", F.col("c_custkey") % 13)
    # Places within each area, and the areas' sizes before it: no one task orders all rows.
    within = F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("n"), "c_name"))
    sizes = c.groupBy("c_nationkey").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("c_nationkey").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = c.withColumn("place", within).join(before.select("c_nationkey", "before"), "c_nationkey")
    return out.select(F.col("c_custkey").alias("id"), (F.col("place") + F.col("before")).alias("place"))


@query(
    """SELECT 'source' AS metric, source AS value, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus"""
)
def build_report(spark, d):
    """Counts of the build."""
    parts = [("source", "documents", "source"), ("lang", "documents", "lang"), ("segment", "customer", "c_mktsegment"), ("status", "orders", "o_orderstatus")]
    out = [read(spark, d, t).groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).select(F.lit(m).alias("metric"), "value", "n") for m, t, c in parts]
    total = out[0]
    for x in out[1:]:
        total = total.unionByName(x)
    return total


@query("SELECT source AS src FROM documents UNION SELECT regexp_replace(regexp_extract(url, '^https?://([^/?#:]+)', 1), '^www\\.', '') FROM pages UNION SELECT role FROM conversations")
def used_sources_union(spark, d):
    """Sources that anything published names."""
    from ..functions.web import host_of

    a, b, c = read(spark, d, "documents").select(F.col("source").alias("src")), read(spark, d, "pages").select(host_of(F.col("url")).alias("src")), read(spark, d, "conversations").select(F.col("role").alias("src"))
    return a.unionByName(b).unionByName(c).distinct()


@query("""SELECT c_custkey AS id, '{"id":' || c_custkey || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',"name":"' || c_name || '"' END || CASE WHEN c_custkey % 2 = 0 THEN ',"tags":["' || c_mktsegment || '"]' ELSE '' END || '}' AS js FROM customer""")
def sparse_json_rows(spark, d):
    """Rows as JSON without empty fields."""
    k = F.col("c_custkey")
    name = F.nullif(F.when(k % 3 == 0, "").otherwise(F.col("c_name")), F.lit(""))
    tags = F.when(k % 2 == 0, F.array("c_mktsegment"))
    return read(spark, d, "customer").select(k.alias("id"), F.to_json(F.struct(k.alias("id"), name.alias("name"), tags.alias("tags"))).alias("js"))


@query("SELECT l_returnflag AS flag, l_linestatus AS status, CAST(sum(l_quantity) AS DOUBLE) AS qty, round(sum(l_extendedprice), 2) AS total, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def price_summary(spark, d):
    """Totals of offers by flag and status."""
    l = read(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return l.groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.sum("l_quantity").alias("qty"), F.round(F.sum("l_extendedprice"), 2).alias("total"), F.count("*").alias("n"))


@query("SELECT event_type AS kind, CAST(props->>'$.k' AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def json_field_counts(spark, d):
    """Counts by a field inside a JSON text."""
    e = read(spark, d, "events").select(F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return e.groupBy("kind", "k").agg(F.count("*").alias("n"))
