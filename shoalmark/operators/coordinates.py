"""Positions of places from their ports: candidates chosen, gaps filled, misplaced records moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.places import cell, dist_km
from ..functions.text import port_key
from .graph import spread
from .lookup import others_median
from .survivorship import median_by_rank

# Words of ports that are waters, classes of map features that are, and other names of some.
WATER_PORT = "湖|ダム|沼|貯水池"
WATERS = (
    ("natural", "water"), ("water", "lake"), ("water", "reservoir"), ("landuse", "reservoir"), ("waterway", "river"), ("waterway", "dam"), ("man_made", "dam"), ("natural", "wetland"), ("water", "river"), ("water", "pond"),
)
WATER_NAMES = {"八郎潟": ("八郎潟調整池", "八郎潟残存湖"), "神流湖": ("下久保ダム",), "七色ダム": ("七色貯水池", "七色湖")}


def pick(candidates: DataFrame, strict_km: float = 30.0) -> DataFrame:
    """(rid, la, lo, name) of the candidate of each row that is surely meant; rows without one are missing.

    candidates (rid, city, ref_la, ref_lo, most_km, strict, n, c_city, la, lo, name).  Those of the row's city come first;
    without one a strict row reaches no further than strict_km.  The nearest to the reference point has to be within
    reach, and the second 1.5 times and 5 km further off.  Without a reference only the one of the city counts.
    """
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    own = ~blank(F.col("city")) & ~blank(F.col("c_city")) & (F.col("city").contains(F.col("c_city")) | F.col("c_city").contains(F.col("city")))
    w = Window.partitionBy("rid")
    rows = candidates.withColumn("_own", F.coalesce(own, F.lit(False))).withColumn("_any", F.max("_own").over(w)).where("_own OR NOT _any")
    rows = rows.withColumn("_d", dist_km(F.col("ref_la"), F.col("ref_lo"), F.col("la"), F.col("lo"))).withColumn("_size", F.count(F.lit(1)).over(w))
    by = w.orderBy(F.asc_nulls_last("_d"), "n")
    rows = rows.withColumn("_n", F.row_number().over(by)).withColumn("_second", F.lead("_d").over(by)).where("_n = 1")
    reach = F.when(~F.col("_any") & F.col("strict"), F.least(F.col("most_km"), F.lit(strict_km))).otherwise(F.col("most_km"))
    sure = F.when(F.col("_d").isNull(), F.col("_any") & (F.col("_size") == 1)).otherwise((F.col("_d") <= reach) & ~F.coalesce(F.col("_second") < F.col("_d") * 1.5 + 5, F.lit(False)))
    return rows.where(sure).select("rid", "la", "lo", "name")


def _medians(points: DataFrame, name: str) -> DataFrame:
    """(pref, pkey, <name>_la, <name>_lo, <name>_n): the upper medians of the points of each port."""
    keys = ["pref", "pkey"]
    n = points.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{name}_n"))
    return n.join(median_by_rank(points, keys, "la", f"{name}_la"), keys).join(median_by_rank(points, keys, "lo", f"{name}_lo"), keys)


def port_points(rows: DataFrame, sites: DataFrame, official: DataFrame, named: DataFrame, features: DataFrame) -> DataFrame:
    """(rid, la, lo, basis, n): where each row's port lies and by what, the first of: the median of two other records or more
    that is within 5 km of the official place, the official place, that median, a looked-up name, a map feature.

    rows (rid, pref, pkey, city, ref_la, ref_lo, most_km, strict).  sites (rid, pref, pkey, la, lo): records whose source
    shows them; a row's own position doesn't count.  official and named (pref, pkey, n, c_city, la, lo, name), features
    (pkey, ...).  Waters are too wide for a position.
    """
    keyed = sites.withColumn("_key", F.struct("pref", "pkey"))
    own = others_median(keyed, "rid", "_key", ["la", "lo"]).select("rid", F.col("la").alias("_ola"), F.col("lo").alias("_olo"), F.col("n").alias("_on"))
    rows = rows.join(_medians(sites, "m"), ["pref", "pkey"], "left").join(own, "rid", "left")
    member = F.col("_on").isNotNull()
    rows = rows.withColumn("n", F.coalesce(F.when(member, F.col("_on")).otherwise(F.col("m_n")), F.lit(0)))
    median = lambda a, b: F.when(F.col("n") >= 2, F.when(member, F.col(a)).otherwise(F.col(b)))
    rows = rows.withColumn("mla", median("_ola", "m_la")).withColumn("mlo", median("_olo", "m_lo")).drop("_ola", "_olo", "_on", "m_la", "m_lo", "m_n")
    asked = rows.withColumn("ref_la", F.coalesce("ref_la", "mla")).withColumn("ref_lo", F.coalesce("ref_lo", "mlo"))

    def found(table: DataFrame, keys: list[str], name: str, most: float | None, strict: bool) -> DataFrame:
        side = asked.withColumn("most_km", F.least(F.col("most_km"), F.lit(most))) if most else asked
        side = side.withColumn("strict", F.lit(True)) if strict else side
        got = pick(side.select("rid", "city", "ref_la", "ref_lo", "most_km", "strict", *keys).join(table, keys))
        return got.where(~F.coalesce(F.col("name"), F.lit("")).rlike(WATER_PORT)).select("rid", F.col("la").alias(f"{name}_la"), F.col("lo").alias(f"{name}_lo"))

    for part in (found(official, ["pref", "pkey"], "o", None, False), found(named, ["pref", "pkey"], "g", None, True), found(features, ["pkey"], "f", 80.0, True)):
        rows = rows.join(part, "rid", "left")
    has = lambda c: F.col(f"{c}_la").isNotNull()
    agree = has("o") & (dist_km(F.col("mla"), F.col("mlo"), F.col("o_la"), F.col("o_lo")) <= 5)
    basis = F.when(agree, "median").when(has("o"), "jp").when(F.col("mla").isNotNull(), "median").when(has("g"), "name").when(has("f"), "osm")
    rows = rows.withColumn("basis", basis).where("basis IS NOT NULL")
    at = lambda c: F.when(F.col("basis") == "median", F.col(f"m{c}")).when(F.col("basis") == "jp", F.col(f"o_{c}")).when(F.col("basis") == "name", F.col(f"g_{c}")).otherwise(F.col(f"f_{c}"))
    return rows.select("rid", at("la").alias("la"), at("lo").alias("lo"), "basis", F.when(F.col("basis").isin("name", "osm"), 0).otherwise(F.col("n")).alias("n"))


def moved_to_ports(rows: DataFrame, targets: DataFrame, inland: DataFrame) -> DataFrame:
    """rows (rid, pref, port, city, la, lo, geo) with la, lo, geo and city as they are after moves to the port, and `moved`.

    targets: what port_points gives; inland (rid, km), 0 where unknown.  What an address gave moves if it is over 3 km off;
    what a source shows, if over 5 km off and 3 km inland; what a port gave, if over 10 km off, 3 km inland, and the port's
    place is official or a median of three or more.  Further than 15 km, the city isn't the port's.
    """
    t = targets.select("rid", F.col("la").alias("_la"), F.col("lo").alias("_lo"), F.col("basis").alias("_basis"), F.col("n").alias("_n"))
    both = rows.join(t, "rid", "left").join(inland.select("rid", F.col("km").alias("_km")), "rid", "left")
    d, deep = dist_km(F.col("la"), F.col("lo"), F.col("_la"), F.col("_lo")), F.coalesce("_km", F.lit(0.0)) >= 3
    move = F.when(F.col("geo").isin("town", "city"), d > 3).when(F.col("geo") == "site", (d > 5) & deep).otherwise(F.col("_basis").isin("jp", "median") & (F.col("_n") >= 3) & (d > 10) & deep)
    move = F.coalesce(move & ~F.coalesce(F.col("port"), F.lit("")).rlike(WATER_PORT) & (F.coalesce("pref", F.lit("")) != ""), F.lit(False))
    both = both.withColumn("moved", move).withColumn("_far", d > 15)
    took = lambda new, old: F.when(F.col("moved"), new).otherwise(F.col(old))
    return both.select("rid", took(F.col("_la"), "la").alias("la"), took(F.col("_lo"), "lo").alias("lo"), took(F.lit("port"), "geo").alias("geo"), F.when(~(F.col("moved") & F.col("_far")), F.col("city")).alias("city"), "moved")


def with_port_positions(rows: DataFrame, waters: DataFrame, points: DataFrame) -> DataFrame:
    """rows (rid, src, pref, pkey, port, la, lo, geo) where those with a port and no position get one: the median of what
    sources show at the port, else of what addresses of others than licence rows gave, else the water's own place, else
    the port's (points: what port_points gives for them).

    waters (pref, port, la, lo, name, type): a river counts only if the port has exactly its name.
    """
    known = rows.where((F.coalesce("pkey", F.lit("")) != "") & (F.coalesce("pref", F.lit("")) != "") & F.col("la").isNotNull())
    site = _medians(known.where("geo = 'site'"), "s")
    town = _medians(known.where("geo = 'town' AND src <> 'registry'"), "t")
    w = waters.select("pref", "port", F.col("la").alias("w_la"), F.col("lo").alias("w_lo"), F.col("name").alias("w_name"), F.col("type").alias("w_type"))
    out = rows.join(site, ["pref", "pkey"], "left").join(town, ["pref", "pkey"], "left").join(w, ["pref", "port"], "left")
    out = out.join(points.select("rid", F.col("la").alias("p_la"), F.col("lo").alias("p_lo")), "rid", "left")
    plain = F.regexp_replace("port", "[（(].*?[)）]", "")
    river = (F.col("w_type") == "river") & F.col("w_name").endswith("川") & (F.col("w_name") != plain)
    usable = F.col("w_la").isNotNull() & ~F.coalesce(river, F.lit(False))
    take = lambda c: F.coalesce(f"s_{c}", f"t_{c}", F.when(usable, F.col(f"w_{c}")), f"p_{c}")
    lacks = F.col("la").isNull() & (F.coalesce("pkey", F.lit("")) != "") & (F.coalesce("pref", F.lit("")) != "")
    filled = lacks & take("la").isNotNull()
    new = lambda c: F.when(lacks, take(c)).otherwise(F.col(c))
    return out.select("rid", new("la").alias("la"), new("lo").alias("lo"), F.when(filled, "port").otherwise(F.col("geo")).alias("geo"))


def water_picks(answers: DataFrame) -> DataFrame:
    """(pref, port, la, lo, name, type) of the first answer (pref, port, q, n, class, type, display, la, lo, name) that is a
    water and whose full name holds the prefecture; q and n: the place of its query and its own."""
    fits = F.lit(False)
    for kind, what in WATERS:
        fits = fits | ((F.col("class") == kind) & (F.col("type") == what))
    rows = answers.where(fits & F.col("display").contains(F.col("pref")))
    best = rows.groupBy("pref", "port").agg(F.min_by(F.struct(F.round("la", 5).alias("la"), F.round("lo", 5).alias("lo"), "name", "type"), F.struct("q", "n")).alias("b"))
    return best.select("pref", "port", "b.*")


def water_queries(port: Column, pref: Column) -> Column:
    """What to look up for a water: its name and its other names, each with the prefecture and alone."""
    name = F.regexp_replace(port, "[（(].*?[)）]", "")
    others = F.array().cast("array<string>")
    for known, more in WATER_NAMES.items():
        others = F.when(name == known, F.array(*map(F.lit, more))).otherwise(others)
    names = F.concat(F.array(name), others)
    return F.flatten(F.transform(names, lambda n: F.array(F.concat_ws(" ", n, pref), n)))


def inland(places: DataFrame, coast: DataFrame | None) -> DataFrame:
    """(rid, km): the distance of places (rid) to the coast (rid, km), 0 where it isn't known."""
    if coast is None:
        return places.select("rid", F.lit(0.0).alias("km"))
    return places.select("rid").join(coast, "rid", "left").select("rid", F.coalesce("km", F.lit(0.0)).alias("km"))


def nearest_in_box(places: DataFrame, ports: DataFrame, half: float = 0.1) -> DataFrame:
    """(rid, km): the distance of places (rid, la, lo) to the nearest of the ports (la, lo) in a box of so many degrees
    either way; null without one.  Their positions, each once, meet in cells of the box's half."""
    p = places.select(F.col("la").alias("a"), F.col("lo").alias("o")).distinct().select("a", "o", cell(F.col("a"), half).alias("cy"), cell(F.col("o"), half).alias("cx"))
    around = F.explode(F.array(*[F.struct((cell(F.col("la"), half) + y).alias("cy"), (cell(F.col("lo"), half) + x).alias("cx")) for y in (-1, 0, 1) for x in (-1, 0, 1)]))
    q = ports.select("la", "lo").distinct().select("la", "lo", around.alias("at")).select("la", "lo", "at.cy", "at.cx")
    met = spread(p, "cy", "cx").join(spread(q, "cy", "cx").hint("shuffle_hash"), ["cy", "cx"]).where((F.abs(F.col("la") - F.col("a")) < half) & (F.abs(F.col("lo") - F.col("o")) < half))
    best = met.groupBy("a", "o").agg(F.min(dist_km(F.col("a"), F.col("o"), F.col("la"), F.col("lo"))).alias("km"))
    return places.select("rid", F.col("la").alias("a"), F.col("lo").alias("o")).join(best, ["a", "o"], "left").select("rid", "km")


def port_gazetteer(ports: DataFrame) -> DataFrame:
    """(pref, pkey, n, la, lo, name): each port (n, pref, name, la, lo) by its key, and by that without a part in brackets;
    keys of under two letters go, and ports within 0.01 degrees of one taken before."""
    from .gazetteer import thinned

    bare = F.regexp_replace("name", "[（(].*?[)）]", "")
    keys = F.array_distinct(F.array(port_key(F.col("name"), plain=True), port_key(bare, plain=True)))
    rows = ports.select("n", "pref", "name", "la", "lo", F.explode(keys).alias("pkey")).where(F.length("pkey") >= 2)
    kept = thinned(rows.withColumn("_at", F.concat_ws("|", "pref", "pkey")), "_at", "n", box=0.01)
    return rows.withColumn("_at", F.concat_ws("|", "pref", "pkey")).join(kept.select("_at", "n"), ["_at", "n"], "left_semi").select("pref", "pkey", "n", "la", "lo", "name")
