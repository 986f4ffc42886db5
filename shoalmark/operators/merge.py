"""The merged record of an entity from the records of its cluster, by priority, and policies for merging records.

Scalars are aggregates with partial results; lists are exploded, deduplicated by first place and cut before they are
gathered, so no record of a large cluster is held for its lists.  All parts are grouped by the cluster, so that joining
them needs no other shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.places import town_level
from ..functions.text import name_key
from .resolve import entity_id
from .survivorship import first_by, first_present, keep_first, majority, ordered_union, ranked_union, tiered

#: A list as long as it is.
ALL = 1 << 30
REGISTRY = "registry"
PLACED = ("site", "port", "town", "city")


def bare_listing(src: Column, tel: Column, ukey: Column) -> Column:
    """A record of a regional list without phone and site: such lists repeat a boat under other ports."""
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    return (src.startswith("gap") | (src == "regalt")) & blank(tel) & blank(ukey)


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_o1", -F.col("prio")).withColumn("_o2", F.col("src_id")).withColumn("_o3", F.col("src"))


_ORDER = ("_o1", "_o2", "_o3")


def _in_order(rows: DataFrame, item: str, most: int, name: str, extra: Sequence[str] = ()) -> DataFrame:
    """(cluster, name): items as an array in order, repeated ones too, at most so many."""
    w = Window.partitionBy("cluster").orderBy(*_ORDER, *extra)
    kept = rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    return kept.groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", item))), lambda x: x[item]).alias(name))


def merged(records: DataFrame, plans: DataFrame) -> DataFrame:
    """One row for each cluster.

    records (cluster, src, src_id, prio and the fields of a prepared listing, boats, registry) and plans (cluster, src,
    src_id, prio, pos and the fields of a cleaned offer).  Records rank by priority, then id.  The name, phone and address
    are of the best record that is no licence row; a licence row's address is published up to the town.
    """
    r, p = _placed(records), _placed(plans)
    order = [F.col(c) for c in _ORDER]
    web, reg = F.col("src") != REGISTRY, F.col("src") == REGISTRY
    only = lambda condition, c: F.when(condition, F.col(c))
    first = lambda c: first_present(c if isinstance(c, Column) else F.col(c), *order)
    ladder = [(web, "site"), (web, "port"), (web, "town"), (reg, "town"), (web, "city"), (reg, "city")]
    tier = None
    for i, (pool, geo) in enumerate(ladder):
        fits = pool & (F.col("geo") == geo) & F.col("lat").isNotNull()
        tier = F.when(fits, i) if tier is None else tier.when(fits, i)
    rank = F.struct(*order)
    one = r.groupBy("cluster").agg(
        entity_id(F.min_by("src", rank), F.min_by("src_id", rank)).alias("id"),
        F.coalesce(first_by(only(web, "name"), F.when(web, rank)), first_by(only(reg, "name"), F.when(reg, rank))).alias("name"),
        *[first(c).alias(c) for c in ("kana", "city", "port", "website", "holidays", "access", "description", "schedule_text")],
        first(only(web, "address")).alias("_web_address"), first(only(reg, "address")).alias("_reg_address"),
        F.coalesce(first(only(web, "tel_shown")), first(only(reg, "tel_shown"))).alias("tel"),
        tiered(F.struct("lat", "lon", "geo"), tier, *order).alias("_at"), F.max("capacity").alias("capacity"), F.max("fetched").alias("fetched"), F.bool_and("stale").alias("stale"),
    )
    one = one.select("*", F.coalesce("_web_address", town_level(F.col("_reg_address"))).alias("address"), "_at.lat", "_at.lon", "_at.geo").drop("_web_address", "_reg_address", "_at")
    items = lambda rows, c: rows.select("cluster", *_ORDER, F.posexplode(c).alias("_pos", c))
    union = lambda rows, c, most: ordered_union(items(rows, c), ["cluster"], c, [*_ORDER, "_pos"], most, c)
    targets = items(r, "targets").withColumn("_part", F.lit(0)).withColumn("_plan", F.lit(0))
    of_plans = p.select("cluster", *_ORDER, F.lit(1).alias("_part"), F.col("pos").alias("_plan"), F.posexplode("targets").alias("_pos", "targets"))
    links = keep_first(r.where(web & (F.col("src") != "official") & (F.coalesce("src_url", F.lit("")) != "")), ["cluster", "src_url"], order).withColumn("link", F.struct("src", F.col("src_url").alias("url")))
    licence = r.where(reg & (F.coalesce("registry.reg_no", "registry.src_url").isNotNull()))
    fields = ("name", "kind", "targets", "price", "price_text", "depart", "return", "meet", "season", "days", "includes", "url", "src")
    offers = keep_first(p.withColumn("_nkey", name_key(F.coalesce("name", F.lit("")))), ["cluster", "_nkey", "price", "depart", "kind"], [*order, F.col("pos")]).withColumn("plan", F.struct(*fields))
    parts = [
        majority(r, ["cluster"], "pref", order, "pref"), union(r, "sns", 5), union(r, "types", ALL), ranked_union(targets.unionByName(of_plans), ["cluster"], "targets", [*_ORDER, "_part", "_plan", "_pos"], 60, "targets"),
        union(r, "methods", 12), union(r, "facilities", 20), _in_order(offers, "plan", 40, "plans", ["pos"]), _in_order(links, "link", ALL, "links"), union(r.where(reg), "boats", 10), _in_order(licence, "registry", 4, "registry"),
        _in_order(r.withColumn("member", F.concat_ws(":", "src", "src_id")), "member", ALL, "members"),
    ]
    for part in parts:
        one = one.join(part, "cluster", "left")
    return one


def absorbed(rows: DataFrame, keys: Sequence[str], order: Sequence[str], fill: Sequence[str] = (), union: Sequence[str] = (), every: Sequence[str] = (), latest: Sequence[str] = ()) -> DataFrame:
    """Rows of equal keys as one: `fill` takes the first value in order, `union` the lists' items in order, `every` is true
    if all are, `latest` takes the greatest."""
    kinds = dict(rows.dtypes)
    by = [F.col(c) for c in order]
    aggs = [first_present(F.col(c), *by, kind=kinds[c]).alias(c) for c in fill] + [F.bool_and(F.coalesce(c, F.lit(False))).alias(c) for c in every] + [F.max(c).alias(c) for c in latest]
    out = rows.groupBy(*keys).agg(*aggs) if aggs else rows.select(*keys).distinct()
    for c in union:
        items = rows.select(*keys, *order, F.posexplode(c).alias("_pos", c))
        out = out.join(ordered_union(items, list(keys), c, [*order, "_pos"], ALL, c), list(keys), "left")
    return out


def minimum_fare(plans: DataFrame, noriai: DataFrame, key: str = "id") -> DataFrame:
    """(key, price): the lowest fare for one person on a shared boat, between 1,000 and 80,000 yen.

    plans (key, name, kind, price, price_text), noriai (key, noriai): an offer without a kind counts only where the entity
    has shared boats and it isn't a ferry's.
    """
    from ..functions.offers import FERRY, price_unit

    rows = plans.join(noriai, key, "left")
    ferry = F.concat(F.coalesce("name", F.lit("")), F.coalesce("price_text", F.lit(""))).rlike(FERRY)
    kind, text = F.coalesce("kind", F.lit("")), F.coalesce("price_text", F.lit(""))
    fits = F.col("price").between(1000, 80000) & (price_unit(kind, text) == "person") & ((kind == "乗合") | ((kind == "") & F.coalesce("noriai", F.lit(False)) & ~ferry))
    return rows.groupBy(key).agg(F.coalesce(F.min(F.when(fits, F.col("price"))), F.lit(0)).alias("price"))


def with_tours(boats: DataFrame, tours: DataFrame) -> DataFrame:
    """(boat, n, name, kind, price): the offers of boats: those of their tours, then those of their own page (boat, n, tour,
    name, kind, price) that no tour gives, by the tour's number or, without one, by its name; equal ones once."""
    of_tours = tours.select("boat", F.lit(0).alias("_part"), F.col("tour").alias("_place"), "name", "kind", "price")
    same_tour = boats.join(tours.select("boat", "tour").distinct(), ["boat", "tour"], "left_semi").select("boat", "n")
    same_name = boats.where("tour IS NULL").join(tours.select("boat", "name").distinct(), ["boat", "name"], "left_semi").select("boat", "n")
    own = boats.join(same_tour.unionByName(same_name), ["boat", "n"], "left_anti").select("boat", F.lit(1).alias("_part"), F.col("n").alias("_place"), "name", "kind", "price")
    rows = keep_first(of_tours.unionByName(own), ["boat", "name", "kind", "price"], ["_part", "_place"])
    return rows.select("boat", (F.row_number().over(Window.partitionBy("boat").orderBy("_part", "_place")) - 1).alias("n"), "name", "kind", "price")


def enriched(listing: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Rows of detail with what they lack from the listing that names them; listings without a detail stay as they are."""
    columns = [c for c in listing.columns if c != key]
    both = detail.select(key, *[F.col(c).alias(f"_d_{c}") for c in detail.columns if c != key]).join(listing, key, "full")
    kinds = dict(listing.dtypes)
    blank = lambda c, kind: F.nullif(c, F.lit("")) if kind == "string" else F.when(F.size(c) > 0, c) if kind.startswith("array") else c
    own = lambda c: blank(F.col(f"_d_{c}"), kinds[c]) if c in detail.columns else F.lit(None)
    return both.select(key, *[F.coalesce(own(c), F.col(c)).alias(c) for c in columns])


def season_changes(now: DataFrame, before: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """now and the rows that only before has, which are stale; notes: what has changed, by column."""
    old = before.select(key, *[F.col(c).alias(f"_b_{c}") for c in columns])
    note = lambda c: F.when(F.col(f"_b_{c}").isNotNull() & ~F.col(f"_b_{c}").eqNullSafe(F.col(c)), F.concat(F.lit(f"{c}: "), F.col(f"_b_{c}").cast("string")))
    same = now.join(old, key, "left").select(*now.columns, F.lit(False).alias("stale"), F.array_compact(F.array(*map(note, columns))).alias("notes"))
    gone = before.join(now.select(key), key, "left_anti").select(*now.columns, F.lit(True).alias("stale"), F.array().cast("array<string>").alias("notes"))
    return same.unionByName(gone)


def known_to(rows: DataFrame, entities: DataFrame, id_col: str = "id", least: int = 3) -> DataFrame:
    """(id_col, hit): the entity that a row (tel, host, nkey, pref) is, by phone, else by host, else by name: equal in its
    prefecture, or one of `least` letters or more inside the other.  Names meet in blocks of a prefecture and a trigram, each
    name of a prefecture once, however many rows bear it."""
    asked = rows.select(F.col(id_col).alias("_id"), "tel", "host", "nkey", "pref")
    by = lambda c, n: asked.where(F.coalesce(c, F.lit("")) != "").join(entities.groupBy(c).agg(F.min("entity").alias("hit")), c).select("_id", F.lit(n).alias("_n"), "hit")
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - least + 1)), lambda i: F.substring(c, i, F.lit(least))))
    names = entities.where(F.length("nkey") >= least).groupBy(F.col("nkey").alias("_name"), "pref").agg(F.min("entity").alias("entity"))
    whole = asked.where(F.length("nkey") >= least).select("nkey", "pref").distinct()
    # A shorter name lies inside a longer one only if its first letters are one of that one's grams.
    head = lambda c: F.substring(c, 1, least)
    inside = whole.withColumn("g", head(F.col("nkey"))).join(names.withColumn("g", F.explode(grams(F.col("_name")))), ["pref", "g"]).where(F.col("_name").contains(F.col("nkey")))
    around = whole.withColumn("g", F.explode(grams(F.col("nkey")))).join(names.withColumn("g", head(F.col("_name"))), ["pref", "g"]).where(F.col("nkey").contains(F.col("_name")))
    alike = inside.select("nkey", "pref", "entity").unionByName(around.select("nkey", "pref", "entity")).groupBy("nkey", "pref").agg(F.min("entity").alias("hit"))
    similar = asked.join(alike, ["nkey", "pref"]).select("_id", F.lit(3).alias("_n"), "hit")
    hits = by("tel", 1).unionByName(by("host", 2)).unionByName(similar).groupBy("_id").agg(F.min_by("hit", "_n").alias("hit"))
    return asked.select("_id").join(hits, "_id", "left").select(F.col("_id").alias(id_col), "hit")


def across_lists(rows: DataFrame, key: Sequence[str], kind: str, id_col: str = "id") -> DataFrame:
    """(id_col, partner): of each row the first one before it of another list with its key that agrees with it.

    They agree if their phones are equal or both unknown, or their ports or sites are equal.  No pairs are made: of the rows
    that agree in one of these, the first one and the first one of another list than its own are all that a row can have
    for a partner, however many share a key.
    """
    text = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    sign = lambda x, known: F.when(known, F.struct(F.lit(x).alias("by"), text(x).alias("value")))
    signs = F.array_compact(F.array(sign("tel", F.lit(True)), sign("port", text("port") != ""), sign("ukey", text("ukey") != "")))
    at = [*key, "by", "value"]
    named = rows.where(F.col(kind).isNotNull()).select(*key, F.col(id_col).alias("_id"), F.col(kind).alias("_kind"), F.explode(signs).alias("_s")).select(*key, "_id", "_kind", "_s.by", "_s.value")
    firsts = named.groupBy(*at, "_kind").agg(F.min("_id").alias("_id"))
    first = firsts.groupBy(*at).agg(F.min(F.struct("_id", "_kind")).alias("_f")).select(*at, F.col("_f._id").alias("_one"), F.col("_f._kind").alias("_one_kind"))
    other = firsts.join(first, at).where("_kind <> _one_kind").groupBy(*at).agg(F.min("_id").alias("_two"))
    met = named.join(first.join(other, at), at).withColumn("partner", F.when(F.col("_kind") != F.col("_one_kind"), F.col("_one")).otherwise(F.col("_two")))
    return met.where("partner < _id").groupBy(F.col("_id").alias(id_col)).agg(F.min("partner").alias("partner"))
