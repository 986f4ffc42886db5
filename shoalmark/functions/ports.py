"""Harbours in texts and areas of listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import PREFS

# What the name of a harbour looks like in a text, and what looks like one.
HARBOUR = "漁港|港|マリーナ|ボートパーク"
TOKEN = rf"([^\s\d,、()・/]{{1,12}}?(?:{HARBOUR}))(?![区町通丁目市\d一二三四五六七八九十]|[東西南北中新本上下](?:[\d一二三四五六七八九十町丁]|$))"
NO_HARBOUR = "港区|港町|港南|港北|空港"
BESIDE = "^.*?(?:係留場|桟橋|岸壁|地先)"


def port_in(text: Column) -> Column:
    """The first harbour that a composed text names, without the towns and moorings before it; null without one."""

    def plain(t: Column) -> Column:
        t = F.regexp_replace(t, "^.*[都道府県市区町村郡](?=.)", "")
        t = F.regexp_replace(F.regexp_replace(t, "^(?:大字|字)", ""), BESIDE, "")
        return F.regexp_replace(t, r"^(.{2,4})\1", "$1")  # a name written twice

    found = F.filter(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)), lambda t: ~t.rlike(NO_HARBOUR))
    return F.get(F.filter(F.transform(found, plain), lambda t: (F.length(t) >= 2) & ~t.rlike(f"^(?:{HARBOUR})$")), F.lit(0))


def port_of_areas(areas: Column) -> Column:
    """The port that the last area of a listing names: of its parts the last that ends like a port, else all of it."""
    names = [*PREFS, *(p[:-1] for p in PREFS if p != "北海道")]
    known = F.filter(areas, lambda a: (a != "") & ~a.isin(*names))
    last = F.when(F.size(known) > 0, F.element_at(known, -1)).otherwise("")
    parts = F.reverse(F.filter(F.split(last, "[・/／]"), lambda p: p.rlike("(港|漁港|浦|湾)$")))
    return F.coalesce(F.get(parts, F.lit(0)), last)


def plain_port(port: Column) -> Column:
    """A port's name without what stands in brackets behind it; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(port, r"\s*[(（][^()（）]*[)）]\s*$", "")), F.lit(""))
