"""Queries of the search layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import FLAGS
from ..operators import ordered, search
from .registry import query
from .tables import SQL_INDEX, index, read

SPEC = search.QuerySpec(words=("customer",), targets=frozenset({"t1", "t4"}), kinds=frozenset("ns"), cap=7000, plans=True)
_WHERE = {
    "words": "text LIKE '%customer%'",
    "targets": "(list_contains(targets, 't1') OR list_contains(targets, 't4'))",
    "kinds": "flags & 24 <> 0",
    "cap": "price > 0 AND price <= 7000",
    "plans": "flags & 1 <> 0",
}


def _sql(ignore: str = "") -> str:
    return " AND ".join(v for k, v in _WHERE.items() if k != ignore)


@query(f"WITH {SQL_INDEX} SELECT idx, name, pref, region, price, flags, cat FROM idx WHERE {_sql()}")
def index_search(spark, d):
    """Entities that a query state matches, by category and then build order."""
    return search.search(index(spark, d), SPEC).select("idx", "name", "pref", "region", "price", "flags", "cat")


@query(
    f"WITH {SQL_INDEX}, f AS ("
    + " UNION ALL ".join(
        [f"SELECT 'kinds' AS facet, '{k}' AS value, count(*) AS n FROM idx WHERE {_sql('kinds')} AND flags & {b} <> 0" for k, b in search.KINDS.items()]
        + [f"SELECT 'cap', '{c}', count(*) FROM idx WHERE {_sql('cap')} AND price > 0 AND price <= {c}" for c in (7000, 10000, 13000, 16000)]
        + [f"SELECT 'targets', 't{t}', count(*) FROM idx WHERE {_sql('targets')} AND list_contains(targets, 't{t}')" for t in range(11)]
    )
    + ") SELECT facet, value, n FROM f"
)
def facet_counts_leave_one_out(spark, d):
    """What each facet value would give with its own group left out."""
    return search.facet_counts(index(spark, d), SPEC, [f"t{i}" for i in range(11)])


@query(
    f"WITH {SQL_INDEX} "
    + " UNION ALL ".join(
        f"SELECT 't{t}' AS value, {str(t in (1, 4)).lower()} AS pressed, count(*) AS n FROM idx WHERE {_sql('targets')} AND "
        + (_WHERE["targets"] if t in (1, 4) else f"({_WHERE['targets']} OR list_contains(targets, 't{t}'))")
        for t in range(11)
    )
)
def facet_or_whatif(spark, d):
    """How many entities match if one more target is pressed."""
    return search.what_if(index(spark, d), SPEC, [f"t{i}" for i in range(11)])


@query(f"WITH {SQL_INDEX} SELECT idx, round(lat, 4) AS lat, round(lon, 4) AS lon FROM idx WHERE lat BETWEEN 30 AND 36 AND lon BETWEEN 130 AND 138 ORDER BY cat, idx LIMIT 100")
def viewport_page(spark, d):
    """The first page of what the map shows (the page is the feature)."""
    out = search.viewport(index(spark, d), 30, 130, 36, 138).orderBy("cat", "idx").limit(100)
    return out.select("idx", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"))


@query(f"WITH {SQL_INDEX} SELECT count(*) AS total, count(*) FILTER (WHERE {_sql()}) AS matching, count(*) FILTER (WHERE {_sql()} AND lat BETWEEN 30 AND 36 AND lon BETWEEN 130 AND 138) AS in_view FROM idx")
def count_line(spark, d):
    """Entities in view, matching and in all, in one pass."""
    inside = F.col("lat").between(30, 36) & F.col("lon").between(130, 138)
    return index(spark, d).agg(F.count("*").alias("total"), F.count_if(SPEC.matches()).alias("matching"), F.count_if(SPEC.matches() & inside).alias("in_view"))


@query(
    f"""WITH {SQL_INDEX}, v AS (SELECT CASE WHEN idx % 50 = 0 THEN lat + 20 ELSE lat END AS v FROM idx), n AS (SELECT CAST(floor(count(*) * 0.1) AS BIGINT) AS most FROM v),
lo AS (SELECT v, row_number() OVER (ORDER BY v) AS rn, lag(v) OVER (ORDER BY v) AS p FROM v), hi AS (SELECT v, row_number() OVER (ORDER BY v DESC) AS rn, lag(v) OVER (ORDER BY v DESC) AS p FROM v)
SELECT round(coalesce((SELECT max(v) FROM lo, n WHERE rn <= most + 1 AND v - p >= 3), (SELECT min(v) FROM v)), 4) AS low,
  round(coalesce((SELECT min(v) FROM hi, n WHERE rn <= most + 1 AND p - v >= 3), (SELECT max(v) FROM v)), 4) AS high"""
)
def extent_trimmed(spark, d):
    """The range of latitudes without far outliers."""
    v = index(spark, d).select(F.when(F.col("idx") % 50 == 0, F.col("lat") + 20).otherwise(F.col("lat")).alias("v"))
    out = ordered.trimmed_extent(v, "v")
    return out.select(F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


@query(f"WITH {SQL_INDEX} SELECT t AS target, count(*) AS n FROM (SELECT idx, unnest(list_distinct(targets)) AS t FROM idx) GROUP BY t")
def target_totals(spark, d):
    """Entities of each target."""
    return index(spark, d).select(F.explode("targets").alias("target")).groupBy("target").agg(F.count("*").alias("n"))


@query(f"WITH {SQL_INDEX} SELECT flags, cat, count(*) AS n, CAST(sum(CASE WHEN flags & 2 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS with_site FROM idx GROUP BY flags, cat")
def flags_and_category(spark, d):
    """Counts by flags and the category that follows from them."""
    return index(spark, d).groupBy("flags", "cat").agg(F.count("*").alias("n"), F.count_if(F.col("flags").bitwiseAND(FLAGS["WEB"]) != 0).alias("with_site"))


@query(f"WITH {SQL_INDEX} SELECT CAST(floor(lat * 4) AS INTEGER) AS ty, CAST(floor(lon * 4) AS INTEGER) AS tx, count(*) AS n, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM idx GROUP BY ALL")
def map_clusters(spark, d):
    """Entities by map tile, with the middle of each."""
    out = index(spark, d).groupBy(F.floor(F.col("lat") * 4).cast("int").alias("ty"), F.floor(F.col("lon") * 4).cast("int").alias("tx"))
    return out.agg(F.count("*").alias("n"), F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"))


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey AS pref FROM customer WHERE c_nationkey = 7")
def detail_lookup(spark, d):
    """The entities of one area, read from its partition alone; the condition reaches the scan."""
    return read(spark, d, "customer").where("c_nationkey = 7").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("pref"))
