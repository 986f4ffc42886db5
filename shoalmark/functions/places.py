"""Addresses and geometry as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import PREFS

EARTH_KM, KM_PER_LON, KM_PER_LAT = 6371.0, 111.320, 110.574


def prefecture(c: Column) -> Column:
    """The prefecture with whose name, or name without its last sign, a text begins."""
    full = F.regexp_extract(c, f"^({'|'.join(PREFS)})", 1)
    short = {p if p == "北海道" else p[:-1]: p for p in PREFS}
    names = F.create_map(*[F.lit(x) for kv in short.items() for x in kv])
    return F.coalesce(F.nullif(full, F.lit("")), F.try_element_at(names, F.regexp_extract(c, f"^({'|'.join(short)})", 1)))


def clean_address(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"〒?\s*\d{3}-?\d{4}\s*", ""), r"\s+", " "))


def town_level(c: Column) -> Column:
    """An address up to its first house number, if four signs stand before it."""
    a = clean_address(c)
    at = F.regexp_instr(a, F.lit("[0-9]|[一二三四五六七八九十百]+(?:丁目|番地?|号)|[〇一二三四五六七八九]{2,}"))
    return F.when(at >= 5, F.regexp_replace(F.substring(a, F.lit(1), at - 1), r"[字大\-ー 　]+$", "")).otherwise(a)


def address_queries(address: Column, pref: Column, city: Column, port: Column) -> Column:
    """What to look up for a place, the most exact first, each once."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit(""))
    a, pref, city, port = blank(clean_address(address)), blank(pref), blank(city), blank(port)
    whole = F.when(a == "", "").when((pref != "") & prefecture(a).isNull(), F.concat(pref, a)).otherwise(a)
    head = F.substring_index(whole, " ", 1)
    whole = F.when(prefecture(head).isNotNull(), head).otherwise(F.replace(whole, F.lit(" "), F.lit("")))
    town = town_level(whole)
    base = F.when((pref == "") | (city == ""), "").when(prefecture(city).isNotNull(), city).otherwise(F.concat(pref, city))
    with_port = F.when((base != "") & (port != ""), F.concat(base, port)).otherwise("")
    town = F.when((town != whole) & (F.length(town) > 4), town).otherwise("")
    return F.array_distinct(F.filter(F.array(whole, town, with_port, base), lambda x: x != ""))


def dist_km(la1: Column, lo1: Column, la2: Column, lo2: Column) -> Column:
    """Equirectangular distance; null if a coordinate is."""
    x = F.radians(lo2 - lo1) * F.cos(F.radians((la1 + la2) / 2))
    y = F.radians(la2 - la1)
    return F.sqrt(x * x + y * y) * EARTH_KM


def near(d: Column, km: float, unknown: bool | None = None) -> Column:
    """d <= km; where d is null: null, or what `unknown` says."""
    out = d <= km
    return out if unknown is None else F.coalesce(out, F.lit(unknown))


def segment_km(lat: Column, lon: Column, la1: Column, lo1: Column, la2: Column, lo2: Column) -> Column:
    """Distance from a point to a segment on the plane that touches at the point."""
    kx = F.cos(F.radians(lat)) * KM_PER_LON
    ax, ay, bx, by = (lo1 - lon) * kx, (la1 - lat) * KM_PER_LAT, (lo2 - lon) * kx, (la2 - lat) * KM_PER_LAT
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    t = F.when(size == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / F.when(size == 0, 1.0).otherwise(size))))
    return F.sqrt(F.pow(ax + t * dx, 2) + F.pow(ay + t * dy, 2))


def cell(x: Column, size: float = 0.5) -> Column:
    return F.floor(x / size).cast("int")


def cells_for(km: float, size: float, latitude: float) -> tuple[int, int]:
    """How many cells around its own a point within so many km can lie in, north and east, up to that latitude."""
    return math.ceil(km / (KM_PER_LAT * size)), math.ceil(km / (KM_PER_LON * math.cos(math.radians(latitude)) * size))


def area_of_signals(*signals: Column) -> Column:
    """struct<area, conflict>: the first known of several signals by trust, and whether two of them differ."""
    known = F.array_distinct(F.array_compact(F.array(*signals)))
    return F.struct(F.coalesce(*signals).alias("area"), (F.size(known) > 1).alias("conflict"))


# Cities and towns whose names hold a sign of a city, county or town.
WHOLE_NAMES = (
    "四日市市 廿日市市 市川市 市原市 野々市市 町田市 大町市 十日町市 村上市 村山市 東村山市 武蔵村山市 羽村市 大村市 田村市 中新川郡上市町 余市郡余市町 市貝町 上市町 余市町 玉村町 木曽郡上松町".split()
)


def city_of(address: Column) -> Column:
    """The city, ward or county town that an address names after its prefecture; null without one."""
    rest = F.regexp_replace(clean_address(address), f"^({'|'.join(PREFS)})", "")
    forms = (
        f"^({'|'.join(WHOLE_NAMES)})",
        r"^((?:北|西|東)村山郡[^町村]{1,6}[町村])",
        r"^([^市区町村]{1,6}市[^市区町村]{1,4}区)", r"^([^市]{1,6}市)", r"^([^区]{1,6}区)", r"^([^郡]{1,5}郡[^町村]{1,6}[町村])", r"^([^町村]{1,6}[町村])")
    return F.coalesce(*[F.nullif(F.regexp_extract(rest, p, 1), F.lit("")) for p in forms])
