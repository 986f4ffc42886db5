"""Queries of the spatial operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.places import dist_km, near
from ..operators import ordered, spatial
from ..operators.graph import spread
from .registry import query
from .tables import SQL_DIST, SQL_LAT, SQL_LON, SQL_PLACES, lat_of, lon_of, places, read


def _dist(a: str, b: str) -> str:
    return SQL_DIST.format(f"{a}.la", f"{a}.lo", f"{b}.la", f"{b}.lo")


@query(
    f"WITH {SQL_PLACES}, j AS (SELECT a.id AS a, b.id AS b, {_dist('a', 'b')} AS d FROM places a JOIN places b ON a.pref = b.pref AND a.key = b.key AND a.id < b.id) "
    "SELECT a, b, coalesce(d <= 900, true) AS unless_far, coalesce(d <= 900, false) AS if_near, coalesce(d > 900, false) AS known_far FROM j"
)
def self_join_three_valued(spark, d):
    """Pairs of one key and area with the three ways to take an unknown distance."""
    p = places(spark, d)
    a, b = p.select(F.col("id").alias("a"), "key", "pref", F.col("la").alias("la1"), F.col("lo").alias("lo1")), p.select(F.col("id").alias("b"), "key", "pref", F.col("la").alias("la2"), F.col("lo").alias("lo2"))
    j = spread(a, "pref", "key").join(spread(b, "pref", "key").hint("shuffle_hash"), ["pref", "key"]).where("a < b")
    dist = dist_km(F.col("la1"), F.col("lo1"), F.col("la2"), F.col("lo2"))
    return j.select("a", "b", near(dist, 900, True).alias("unless_far"), near(dist, 900, False).alias("if_near"), F.coalesce(dist > 900, F.lit(False)).alias("known_far"))


_SUPPLIERS = f"sup AS (SELECT s_suppkey AS id, {SQL_LAT.format('s_suppkey')} AS la, {SQL_LON.format('s_suppkey')} AS lo FROM supplier)"


def _suppliers(spark, d):
    k = F.col("s_suppkey")
    return read(spark, d, "supplier").select(k.alias("rid"), lat_of(k).alias("la"), lon_of(k).alias("lo"))


@query(
    f"""WITH {SQL_PLACES}, {_SUPPLIERS}, j AS (SELECT p.id AS lid, s.id AS rid, {_dist('p', 's')} AS d FROM places p, sup s WHERE p.la IS NOT NULL), k AS (SELECT * FROM j WHERE d <= 120),
r AS (SELECT *, row_number() OVER w AS n, lead(d) OVER w AS second FROM k WINDOW w AS (PARTITION BY lid ORDER BY d, rid)) SELECT lid, rid, round(d, 3) AS d, coalesce(second < d * 1.5 + 5, false) AS ambiguous FROM r WHERE n = 1"""
)
def nearest_with_ambiguity(spark, d):
    """The nearest port of each place within 120 km, and whether another is nearly as near."""
    return spatial.nearest_within_km(places(spark, d).withColumnRenamed("id", "lid"), _suppliers(spark, d), 120, size=1.0, latitude=46).select("lid", "rid", F.round("d", 3).alias("d"), "ambiguous")


@query(
    f"""WITH {SQL_PLACES}, j AS (SELECT a.id, bool_or(a.pref = b.pref) AS same, bool_or(a.pref <> b.pref) AS other, count(*) AS n FROM places a JOIN places b ON a.id <> b.id AND {_dist('a', 'b')} <= 60 GROUP BY a.id)
SELECT id, same, other, n FROM j"""
)
def grid_distance_flags(spark, d):
    """Whether places within 60 km are of the same or another area."""
    return spatial.areas_within_km(places(spark, d).withColumnRenamed("pref", "area"), 60, latitude=46)


@query(
    f"""WITH {SQL_PLACES}, j AS (SELECT a.id, a.pref, bool_or(a.pref = b.pref) AS same, bool_or(a.pref <> b.pref) AS other FROM places a JOIN places b ON a.id <> b.id AND {_dist('a', 'b')} <= 60 GROUP BY a.id, a.pref)
SELECT p.id, CASE WHEN other AND NOT same THEN NULL ELSE round(la, 4) END AS la FROM places p LEFT JOIN j ON p.id = j.id"""
)
def misplaced_discard(spark, d):
    """Positions go where only places of other areas lie around."""
    flags = grid_distance_flags(spark, d).select("id", "same", "other")
    out = places(spark, d).join(flags, "id", "left")
    return out.select("id", F.when(~F.coalesce(F.col("other") & ~F.col("same"), F.lit(False)), F.round("la", 4)).alias("la"))


# A square with a corner cut off, and a triangle; (latitude, longitude).
_RINGS = {"square": [(25.0, 124.0), (35.0, 124.0), (35.0, 134.0), (30.0, 136.0), (25.0, 134.0)], "triangle": [(30.0, 136.0), (40.0, 137.0), (33.0, 143.0)], "neighbour": [(25.0, 134.0), (30.0, 136.0), (26.0, 140.0)]}
_EDGES = [(a, *p, *q) for a, ps in _RINGS.items() for p, q in zip(ps, ps[1:] + ps[:1])]
_SQL_EDGES = "edges(area, la1, lo1, la2, lo2) AS (VALUES " + ", ".join(f"('{a}', {b}::DOUBLE, {c}::DOUBLE, {e}::DOUBLE, {f}::DOUBLE)" for a, b, c, e, f in _EDGES) + ")"


def _edges(spark):
    rings = spark.createDataFrame([(a, 0, [{"la": x, "lo": y} for x, y in ps]) for a, ps in _RINGS.items()], "area string, ring int, points array<struct<la: double, lo: double>>")
    return spatial.ring_edges(rings)


@query(
    f"""WITH {SQL_PLACES}, {_SQL_EDGES}, x AS (SELECT id, area, count(*) AS n FROM places, edges WHERE (la1 > la) <> (la2 > la) AND lo < (lo2 - lo1) * (la - la1) / (la2 - la1) + lo1 GROUP BY id, area)
SELECT id, area FROM x WHERE n % 2 = 1"""
)
def point_in_polygon(spark, d):
    """The areas that places lie in, by the parity of the edges to their east."""
    return spatial.in_areas(places(spark, d).select(F.col("id").alias("pid"), "la", "lo").where("la IS NOT NULL"), _edges(spark)).select(F.col("pid").alias("id"), "area")


_SEG = """sqrt(power(ax + t * (bx - ax), 2) + power(ay + t * (by_ - ay), 2))"""
_SQL_SEGMENT = f"""g AS (SELECT id, area, (lo1 - lo) * cos(radians(la)) * 111.320 AS ax, (la1 - la) * 110.574 AS ay, (lo2 - lo) * cos(radians(la)) * 111.320 AS bx, (la2 - la) * 110.574 AS by_ FROM places, edges WHERE la IS NOT NULL),
t AS (SELECT *, greatest(0, least(1, -(ax * (bx - ax) + ay * (by_ - ay)) / (power(bx - ax, 2) + power(by_ - ay, 2)))) AS t FROM g), s AS (SELECT id, min({_SEG}) AS km FROM t GROUP BY id)"""


@query(f"WITH {SQL_PLACES}, {_SQL_EDGES}, {_SQL_SEGMENT} SELECT id, round(km, 3) AS km FROM s WHERE km <= 150")
def nearest_segment_km(spark, d):
    """Distance to the nearest boundary within 150 km; exact."""
    out = spatial.nearest_segment(places(spark, d).select(F.col("id").alias("pid"), "la", "lo").where("la IS NOT NULL"), _edges(spark), 150, size=1.0, latitude=46)
    return out.select(F.col("pid").alias("id"), F.round("km", 3).alias("km"))


@query(
    f"""WITH {SQL_PLACES}, {_SQL_EDGES}, x AS (SELECT id, area, count(*) AS n FROM places, edges WHERE area = 'square' AND (la1 > la) <> (la2 > la) AND lo < (lo2 - lo1) * (la - la1) / (la2 - la1) + lo1 GROUP BY id, area),
{_SQL_SEGMENT.replace('FROM places, edges WHERE', "FROM places, edges WHERE area = 'square' AND")}
SELECT s.id, coalesce(x.n % 2 = 1, false) AS inside, coalesce(x.n % 2 = 1, false) OR km <= 30 AS within_margin FROM s LEFT JOIN x ON s.id = x.id WHERE coalesce(x.n % 2 = 1, false) OR km <= 30"""
)
def polygon_margin(spark, d):
    """Places inside an area or within 30 km of it."""
    points = places(spark, d).select(F.col("id").alias("pid"), "la", "lo").where("la IS NOT NULL")
    edges = _edges(spark).where("area = 'square'")
    inside = spatial.in_areas(points, edges).select("pid", F.lit(True).alias("inside"))
    close = spatial.nearest_segment(points, edges, 30, latitude=46)
    both = inside.join(close, "pid", "full")
    return both.select(F.col("pid").alias("id"), F.coalesce("inside", F.lit(False)).alias("inside"), F.lit(True).alias("within_margin"))


_SQL_CELLS = f"""cells AS (SELECT DISTINCT CAST(floor(la) AS INTEGER) AS y, CAST(floor(lo) AS INTEGER) AS x FROM (SELECT {SQL_LAT.format('s_suppkey')} AS la, {SQL_LON.format('s_suppkey')} AS lo FROM supplier)),
edges AS (SELECT y AS la1, x AS lo1, y AS la2, x + 1 AS lo2 FROM cells UNION ALL SELECT y, x + 1, y + 1, x + 1 FROM cells UNION ALL SELECT y + 1, x + 1, y + 1, x FROM cells UNION ALL SELECT y + 1, x, y, x FROM cells)"""


@query(
    f"""WITH {_SQL_CELLS}, c AS (SELECT least((la1, lo1), (la2, lo2)) AS a, greatest((la1, lo1), (la2, lo2)) AS b FROM edges), n AS (SELECT a, b FROM c GROUP BY a, b HAVING count(*) = 1)
SELECT a[1]::DOUBLE AS la1, a[2]::DOUBLE AS lo1, b[1]::DOUBLE AS la2, b[2]::DOUBLE AS lo2 FROM n"""
)
def edge_multiplicity_boundary(spark, d):
    """The outer boundary of the map cells in which suppliers lie: borders between two of them vanish."""
    s = F.col("s_suppkey")
    cells = read(spark, d, "supplier").select(F.floor(lat_of(s)).alias("y"), F.floor(lon_of(s)).alias("x")).distinct()
    corner = lambda y, x: F.struct((F.col("y") + y).cast("double").alias("la"), (F.col("x") + x).cast("double").alias("lo"))
    rings = cells.select(F.concat_ws(",", "y", "x").alias("area"), F.lit(0).alias("ring"), F.array(corner(0, 0), corner(0, 1), corner(1, 1), corner(1, 0)).alias("points"))
    return spatial.boundary(spatial.ring_edges(rings))


@query(
    f"""WITH p AS (SELECT s_suppkey AS id, s_nationkey AS port, {SQL_LAT.format('s_suppkey')} AS la, {SQL_LON.format('s_suppkey')} AS lo, CASE s_suppkey % 3 WHEN 0 THEN 'site' WHEN 1 THEN 'town' ELSE 'port' END AS geo FROM supplier),
m AS (SELECT port, count(*) AS n, list_sort(list(la))[count(*) // 2 + 1] AS mla, list_sort(list(lo))[count(*) // 2 + 1] AS mlo FROM p GROUP BY port), j AS (SELECT p.*, n, mla, mlo, {SQL_DIST.format('la', 'lo', 'mla', 'mlo')} AS d FROM p JOIN m USING (port))
SELECT id, CASE WHEN (geo = 'town' AND d > 3) OR (geo = 'site' AND d > 500) OR (geo = 'port' AND n >= 3 AND d > 1000) THEN round(mla, 4) ELSE round(la, 4) END AS la,
 CASE WHEN (geo = 'town' AND d > 3) OR (geo = 'site' AND d > 500) OR (geo = 'port' AND n >= 3 AND d > 1000) THEN 'moved' ELSE geo END AS geo FROM j"""
)
def coordinate_repair(spark, d):
    """Positions moved to the median of their port where their precision and distance ask for it."""
    from ..operators.survivorship import median_by_rank

    k = F.col("s_suppkey")
    geo = F.when(k % 3 == 0, "site").when(k % 3 == 1, "town").otherwise("port")
    p = read(spark, d, "supplier").select(k.alias("id"), F.col("s_nationkey").alias("port"), lat_of(k).alias("la"), lon_of(k).alias("lo"), geo.alias("geo"))
    m = p.groupBy("port").agg(F.count("*").alias("n")).join(median_by_rank(p, ["port"], "la", "mla"), "port").join(median_by_rank(p, ["port"], "lo", "mlo"), "port")
    j = p.join(m, "port").withColumn("d", dist_km(F.col("la"), F.col("lo"), F.col("mla"), F.col("mlo")))
    move = F.expr("(geo = 'town' AND d > 3) OR (geo = 'site' AND d > 500) OR (geo = 'port' AND n >= 3 AND d > 1000)")
    return j.select("id", F.when(move, F.round("mla", 4)).otherwise(F.round("la", 4)).alias("la"), F.when(move, "moved").otherwise(F.col("geo")).alias("geo"))


@query(
    f"""WITH p AS (SELECT c_custkey AS id, round({SQL_LAT.format('c_custkey % 300')}, 1) AS la, round({SQL_LON.format('c_custkey % 300')}, 1) AS lo FROM customer), n AS (SELECT *, CAST(row_number() OVER (PARTITION BY la, lo ORDER BY id) - 1 AS DOUBLE) AS i FROM p),
a AS (SELECT id, i, lo, CASE WHEN i > 0 THEN round_even(la + sqrt(i) * 0.00028 * sin(i * 2.39996), 6) ELSE la END AS la FROM n)
SELECT id, la, CASE WHEN i > 0 THEN round_even(lo + sqrt(i) * 0.00028 * cos(i * 2.39996) / cos(radians(la)), 6) ELSE lo END AS lo FROM a"""
)
def jitter_spiral(spark, d):
    """Places that share a position, moved apart on a spiral."""
    k = F.col("c_custkey")
    p = read(spark, d, "customer").select(k.alias("id"), F.round(lat_of(k % 300), 1).alias("la"), F.round(lon_of(k % 300), 1).alias("lo"))
    return ordered.spiral(p, "id", "la", "lo").select("id", "la", "lo")


@query(
    f"""WITH p AS (SELECT c_custkey AS id, c_nationkey AS city, c_custkey % 1000 AS spot FROM customer), b AS (SELECT spot FROM p GROUP BY spot HAVING count(DISTINCT city) >= 2)
SELECT id, CASE WHEN spot IN (SELECT spot FROM b) THEN NULL ELSE spot END AS spot FROM p"""
)
def shared_coord_invalidated(spark, d):
    """Positions that rows of several cities share are dropped."""
    p = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("city"), (F.col("c_custkey") % 1000).alias("spot"))
    bad = p.groupBy("spot").agg(F.count_distinct("city").alias("n")).where("n >= 2").select("spot", F.lit(True).alias("bad"))
    return p.join(bad, "spot", "left").select("id", F.when(F.col("bad").isNull(), F.col("spot")).alias("spot"))
