"""What the client shows of offers, links and queries, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import SNS_NAMES
from .offers import price_unit

# The order of kinds, and ways of saying that a price is for one person.
KIND_ORDER = {"乗合": 0, "仕立": 1, "渡船": 2}
ONE_PERSON = "/1名|/1人|/人|1名様|1人|1名|一人|お一人様?|おひとり様?|人あたり"
TAXED = r"（税込）|\(税込\)|税込"
#: Offers that are shown before the rest is asked for, fish of an entry of the list, and entries of the list.
OFFERS_SHOWN, FISH_SHOWN, PAGE = 6, 3, 100


def yen(n: Column) -> Column:
    return F.concat(F.format_number(n, 0), F.lit("円"))


def in_order(plans: Column) -> Column:
    """Offers (array of structs with kind and price) by kind, then price; unknown prices last; equal ones as they are."""
    place = F.lit(3)
    rank = lambda p: F.coalesce(*[F.when(p["kind"] == k, n) for k, n in KIND_ORDER.items()], place)
    keyed = F.transform(plans, lambda p, i: F.struct(rank(p).alias("k"), F.when(p["price"] > 0, p["price"]).otherwise(1_000_000_000).alias("price"), i.alias("i"), p.alias("p")))
    return F.transform(F.array_sort(keyed), lambda x: x["p"])


def price_shown(price: Column, text: Column, kind: Column) -> Column:
    """struct<price, unit, note>: the price, '1人' where it is for one person, and the text of the price if that says more."""
    text = F.coalesce(text, F.lit(""))
    unit = price_unit(F.coalesce(kind, F.lit("")), text)
    known = F.coalesce(price, F.lit(0)) > 0
    bare = F.regexp_replace(text, TAXED, "")
    bare = F.when(unit == "person", F.regexp_replace(bare, ONE_PERSON, "")).otherwise(bare)
    rest = F.regexp_replace(bare, r"[\d,，.．円¥￥\s]", "")
    more = (text != "") & (~known | (rest != "") | (F.regexp_replace(bare, r"[^\d]", "") != price.cast("string")))
    return F.struct(F.when(known, yen(price)).otherwise("").alias("price"), F.when(known & (unit == "person"), "1人").alias("unit"), F.when(more, text).alias("note"))


def network_name(host: Column) -> Column:
    """The name of a network by its host; another host as it is."""
    out = host
    for part, name in reversed(SNS_NAMES.items()):
        out = F.when(host.contains(part), name).otherwise(out)
    return out


def link_label(kind: Column, label: Column, url: Column) -> Column:
    """The text of the button of a listing: booking, catches, or its page."""
    return F.concat(label, F.when(kind == "booking", "で予約").when(url.contains("/choka/"), "の釣果").otherwise("の掲載ページ"))


def entry_line(pref: Column, place: Column, fish: Column) -> Column:
    """The second line of an entry of the list: area and place, then the first fish."""
    where = F.concat(pref, F.when(F.coalesce(place, F.lit("")) != "", F.concat(F.lit(" "), place)).otherwise(""))
    return F.array_join(F.filter(F.array(where, F.array_join(F.slice(fish, 1, FISH_SHOWN), "・")), lambda x: x != ""), " · ")


def more_label(total: Column, shown: Column) -> Column:
    """The button for the rest of a list; null if all is shown."""
    return F.when(total > shown, F.concat(F.lit("さらに表示（残り "), F.format_number(total - shown, 0), F.lit(" 件）")))
