"""Choosing among candidate positions: geocoder answers, ports, cascades of sources, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.places import dist_km
from .cover import covered, within_box, within_km

# Classes of map features that are harbours or water.
HARBOURS = {"natural": None, "man_made": None, "waterway": None, "leisure": ("marina", "slipway"), "amenity": ("ferry_terminal",), "landuse": ("harbour", "port")}


def shared_prefix(a: Column, b: Column) -> Column:
    """How many letters two texts begin with alike."""
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(a), F.length(b))))
    first_difference = F.get(F.filter(places, lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))), F.lit(0))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.coalesce(first_difference - 1, F.least(F.length(a), F.length(b))))


def best_answers(answers: DataFrame, pref: Column) -> DataFrame:
    """(q, title, la, lo, level) of the answer (q, n, title, la, lo) that begins most like its query; ties to the first.

    Answers of another prefecture, and those that name a prefecture only, don't count.
    """
    rest = F.substring("title", F.length(pref) + 1, F.length("title"))
    rows = answers.withColumn("_pref", pref).withColumn("_rest", rest)
    rows = rows.where((F.col("_pref").isNull() | F.col("title").startswith(F.col("_pref"))) & (F.length(F.coalesce("_rest", "title")) >= 2))
    rows = rows.withColumn("_like", shared_prefix(F.col("title"), F.col("q")))
    best = rows.groupBy("q").agg(F.min_by(F.struct("title", "la", "lo", "_rest", "_like", "_pref"), F.struct(-F.col("_like"), F.col("n"))).alias("b")).select("q", "b.*")
    city = F.col("_rest").rlike("(市|郡.+?[町村]|区)$") | F.col("_rest").rlike("^.+?[市町村区]$")
    level = F.when(F.col("_like") >= F.length("q") - 1, "town").when(city, "city").when(F.col("_like") >= F.coalesce(F.length("_pref"), F.lit(0)) + 3, "town").otherwise("city")
    return best.select("q", "title", F.round("la", 6).alias("la"), F.round("lo", 6).alias("lo"), level.alias("level"))


def tier(kind: Column, what: Column) -> Column:
    """1 for harbours and water, 2 for place names, 3 for buildings and roads."""
    harbour = F.lit(False)
    for k, types in HARBOURS.items():
        harbour = harbour | ((kind == k) & (F.lit(True) if types is None else what.isin(*types)))
    return F.when(harbour, 1).when(kind == "place", 2).otherwise(3)


# Classes of map features that can be where a port is.
USABLE = ("place", "natural", "man_made", "waterway", "leisure", "landuse", "amenity", "boundary", "building")


def port_picks(answers: DataFrame) -> DataFrame:
    """(pref, key, n, la, lo, tier) of the first answer (pref, key, n, display, class, type, la, lo and, where it is known, inside)
    of each port whose full name holds the prefecture, whose class is usable and that lies inside the prefecture."""
    inside = F.coalesce("inside", F.lit(False)) if "inside" in answers.columns else F.lit(True)
    rows = answers.where(F.col("display").contains(F.col("pref")) & F.col("class").isin(*USABLE) & inside)
    best = rows.groupBy("pref", "key").agg(F.min_by(F.struct("n", "la", "lo", "class", "type"), "n").alias("b")).select("pref", "key", "b.*")
    return best.select("pref", "key", "n", "la", "lo", tier(F.col("class"), F.col("type")).alias("tier"))


def rejections(ports: DataFrame) -> DataFrame:
    """ports (key, name, tier, in_pref, coast_km, users_km, watery) with the column `rejected`: why, or null if kept."""
    coast, users, dry = F.col("coast_km"), F.col("users_km"), ~F.col("watery")
    why = (
        F.when(~F.col("in_pref"), "outside its prefecture")
        .when((F.col("tier") == 3) & (F.length("name") <= 2), "short name of a building or road")
        .when((F.col("tier") == 3) & (((coast > 5) & dry) | (users > 20)), "building or road too far away")
        .when((F.col("tier") == 2) & (((coast > 10) & dry) | (users > 50)), "place name too far away")
        .when((coast > 20) & dry, "too far inland")
    )
    return ports.withColumn("rejected", why)


def port_positions(rows: DataFrame) -> DataFrame:
    """rows with the position (la, lo, basis) of their port from the first of: median and official within 5 km, official,
    median of two listings or more, looked-up name, map feature.  Columns: m_la, m_lo, n, o_la, o_lo, g_la, g_lo, f_la, f_lo."""
    median, official = (F.col("n") >= 2) & F.col("m_la").isNotNull(), F.col("o_la").isNotNull()
    agree = median & official & (dist_km(F.col("m_la"), F.col("m_lo"), F.col("o_la"), F.col("o_lo")) <= 5)
    basis = F.when(agree, "median").when(official, "official").when(median, "median").when(F.col("g_la").isNotNull(), "name").when(F.col("f_la").isNotNull(), "feature")
    pick = lambda c: F.when(basis == "median", F.col(f"m_{c}")).when(basis == "official", F.col(f"o_{c}")).when(basis == "name", F.col(f"g_{c}")).when(basis == "feature", F.col(f"f_{c}"))
    return rows.withColumn("la", pick("la")).withColumn("lo", pick("lo")).withColumn("basis", basis)


def thinned(points: DataFrame, key: str, order: str, km: float = 1.5, box: float | None = None) -> DataFrame:
    """(key, order, la, lo) of the points of each key, taken in order, that aren't within so many km of one taken before, or
    in a box of so many degrees either way around it.  The order has no ties within a key."""
    rows = points.select(F.col(key).alias("_key"), F.col(order).alias("_order"), "la", "lo")
    named = rows.select("_key", F.struct("_key", "_order").alias("id"), F.col("_order").alias("rank"), F.col("la").alias("y"), F.col("lo").alias("x"))
    kept = covered(named, within_box(box) if box else within_km(km), ["_key"]).where("id = centre").select("id.*")
    return rows.join(kept, ["_key", "_order"]).withColumnsRenamed({"_key": key, "_order": order})


def doubtful(places: DataFrame, inland_km: float = 3.0) -> DataFrame:
    """Places (id, coast_km, port_km) far inland without a port close by, the farthest first."""
    return places.where((F.col("coast_km") >= inland_km) & (F.coalesce("port_km", F.lit(1e9)) >= inland_km)).orderBy(F.desc("coast_km"), "id")


def common_position(rows: DataFrame, keys: list[str], most: int) -> Column:
    """Whether at most so many rows share a row's values of the keys (a window count)."""
    return F.count(F.lit(1)).over(Window.partitionBy(*keys)) <= most
