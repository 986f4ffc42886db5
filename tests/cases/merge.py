"""Cases of entity resolution, merged records, joins of lists, and positions."""

from __future__ import annotations

from hashlib import sha1

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoalmark.operators import coordinates, gazetteer, lookup, merge, prepare, resolve, spatial, survivorship
from shoalmark.schema import LISTING
from . import case

c = F.col


def _sha(text: str, n: int) -> str:
    return sha1(text.encode()).hexdigest()[:n]


_RECORD = "idx bigint, src string, nkey string, pref string, city string, pkey string, tel string, ukey string, page string, geo string, lat double, lon double"


def _r(idx, src, nkey, pref="P", city="", pkey="", tel="", ukey="", page="", geo="port", lat=None, lon=None):
    return (idx, src, nkey, pref, city, pkey, tel, ukey, page, geo, lat, lon)


_RECORDS = [
    # 1: phone and name; an address may lie anywhere in the prefecture, two prefectures may not be 80 km apart; empty names are equal.
    _r(1, "a", "aa", tel="01", geo="site", lat=35.0, lon=140.0), _r(2, "b", "aa", tel="01", geo="town", lat=37.0, lon=140.0), _r(3, "a", "ab", tel="02", geo="site", lat=35.0, lon=140.0), _r(4, "b", "ab", pref="Q", tel="02", geo="site", lat=37.0, lon=140.0), _r(5, "a", "", tel="03"), _r(6, "b", "", tel="03"),
    # 2: phone alone, unless four names share it.
    _r(7, "a", "ca", tel="04"), _r(8, "b", "cb", tel="04"), _r(9, "a", "da", tel="05"), _r(10, "b", "db", tel="05"), _r(11, "c", "dc", tel="05"), _r(12, "d", "dd", tel="05"),
    # 3 and 4: one page on a site that four names share; one site that two share; too far apart.
    _r(13, "a", "ea", ukey="h/x", page="h/x/p"), _r(14, "b", "eb", ukey="h/x", page="h/x/p"), _r(15, "c", "ec", ukey="h/x", page="h/x/q"), _r(16, "d", "ed", ukey="h/x", page="h/x/r"), _r(17, "a", "fa", ukey="i", page="i/1"), _r(18, "b", "fb", ukey="i", page="i/2"),
    _r(19, "a", "ga", ukey="j", page="j/1", lat=35.0, lon=140.0), _r(20, "b", "gb", ukey="j", page="j/2", lat=36.0, lon=140.0),
    # 5: name in one prefecture: near; conflicting phones apart and in one port; one letter; unknown positions in one city; licences.
    _r(21, "a", "ha", lat=35.0, lon=140.0), _r(22, "b", "ha", lat=35.2, lon=140.0), _r(23, "a", "hb", tel="06", lat=35.0, lon=140.0), _r(24, "b", "hb", tel="07", lat=35.1, lon=140.0), _r(25, "a", "hc", tel="08", pkey="k"), _r(26, "b", "hc", tel="09", pkey="k"),
    _r(27, "a", "h", lat=35.0, lon=140.0), _r(28, "b", "h", lat=35.02, lon=140.0), _r(29, "a", "hd", city="x"), _r(30, "b", "hd", city="x"), _r(31, "registry", "he", lat=35.0, lon=140.0), _r(32, "registry", "he", lat=35.0, lon=140.0), _r(33, "a", "hf", geo="site", lat=35.0, lon=140.0), _r(34, "b", "hf", geo="site", lat=35.13, lon=140.0),
    # 6: name across prefectures within 3.5 km.
    _r(35, "a", "ia", lat=34.0, lon=139.0), _r(36, "b", "ia", pref="Q", lat=34.02, lon=139.0), _r(37, "a", "ib", lat=34.0, lon=139.0), _r(38, "b", "ib", pref="Q", lat=34.05, lon=139.0),
    # 7: phone and a name inside the other, within one source too, but not within the booking of guides; by hand.
    _r(39, "a", "永宝丸", tel="10"), _r(40, "a", "知床永宝丸", tel="10"), _r(41, "reserver", "ja", tel="11"), _r(42, "reserver", "jaj", tel="11"), _r(43, "a", "ka"), _r(44, "b", "kb"),
    # One source once in a cluster: weak pairs are refused, strong ones of one name are not; a bare listing within 3 km is strong.
    _r(45, "a", "la", tel="12"), _r(46, "a", "lb", tel="12"), _r(47, "a", "lc", pkey="m", lat=33.0, lon=135.0), _r(48, "a", "lc", pkey="m", lat=33.1, lon=135.0), _r(49, "gap01", "ld", lat=33.0, lon=135.0), _r(50, "gap01", "ld", lat=33.02, lon=135.0), _r(51, "a", "le", lat=33.0, lon=135.0), _r(52, "a", "le", lat=33.02, lon=135.0),
]
_JOINED = {2: 1, 6: 5, 8: 7, 14: 13, 18: 17, 22: 21, 26: 25, 30: 29, 36: 35, 40: 39, 44: 43, 48: 47, 50: 49}


def _records(rows):
    return rows.withColumn("src_id", c("idx").cast("string")).withColumn("bare", merge.bare_listing(c("src"), c("tel"), c("ukey")))


@case((_RECORD, _RECORDS), ("a bigint, b bigint, place int", [(43, 44, 0)]), ddl="idx bigint, cluster bigint", expected=[(r[0], _JOINED.get(r[0], r[0])) for r in _RECORDS])
def clusters_by_rules(rows, merges):
    """Every rule that joins records, its guards, and the source that a cluster may hold once."""
    r = _records(rows)
    return resolve.cluster(r, resolve.candidates(r, merges))


@case(
    (_RECORD, _RECORDS), ("a bigint, b bigint, place int", [(43, 44, 0)]),
    ddl="rule int, a bigint, b bigint, strength int",
    expected=[
        (1, 1, 2, 1), (1, 5, 6, 1), (2, 5, 6, 0), (2, 7, 8, 0), (2, 39, 40, 0), (2, 41, 42, 0), (2, 45, 46, 0), (3, 13, 14, 0), (4, 17, 18, 0), (5, 21, 22, 0), (5, 25, 26, 1), (5, 29, 30, 0), (5, 47, 48, 1), (5, 49, 50, 1), (5, 51, 52, 0),
        (6, 35, 36, 0), (7, 39, 40, 2), (8, 43, 44, 1),
    ],
)
def pairs_by_rules(rows, merges):
    """The pairs that each rule proposes, and how strong they are."""
    return resolve.candidates(_records(rows), merges).select("rule", "a", "b", "strength")


@case(
    ("rule int, key_first bigint, a bigint, b bigint, strength int", [(2, 1, 1, 3, 0), (2, 1, 2, 3, 0), (5, 1, 1, 2, 1), (2, 4, 4, 5, 0), (7, 4, 4, 6, 2), (2, 5, 5, 6, 0)]),
    ("idx bigint, src string, nkey string", [(1, "s", "x"), (2, "s", "y"), (3, "t", "x"), (4, "s", "p"), (5, "t", "q"), (6, "s", "r"), (7, "u", "z")]),
    ddl="idx bigint, cluster bigint", expected=[(1, 1), (2, 2), (3, 1), (4, 4), (5, 4), (6, 4), (7, 7)],
)
def replay_in_order(edges, rows):
    """A cluster takes a source once unless names meet or force is used; what comes first decides."""
    return resolve.cluster(rows, edges)


_DETAIL = (
    "cluster int, src string, src_id string, prio int, name string, kana string, pref string, city string, port string, address string, lat double, lon double, geo string, tel_shown string, website string, sns array<string>, types array<string>, targets array<string>, methods array<string>, holidays string, access string, description string, "
    "schedule_text string, facilities array<string>, capacity int, src_url string, boats array<string>, reg_no string, fetched string, stale boolean"
)
_PLAN = "cluster int, src string, src_id string, prio int, pos int, name string, kind string, targets array<string>, price int, depart string"


@case(
    (_DETAIL, [
        (1, "tsuree", "t1", 60, "海丸", None, "千葉県", "いすみ市", "大原", "千葉県いすみ市大原1-2", 35.1, 140.1, "town", "0470-62-1", "https://umi.jp/", ["s1", "s2"], ["乗合"], ["マダイ", "アジ"], ["コマセ"], "火曜", "", None, "", ["トイレ"], 10, "https://t/1", [], None, "2026-01-01", False),
        (1, "chowari", "c1", 100, "釣船 海丸", "うみまる", "東京都", None, None, None, 35.2, 140.2, "site", None, None, ["s2"], ["仕立", "乗合"], ["アジ"], [], None, "駅から5分", "", "", [], 12, "https://c/1", [], None, "2026-02-01", False),
        (1, "registry", "r1", 10, "海丸水産", "カイマル", "千葉県", "勝浦市", None, "千葉県勝浦市浜3", 35.0, 140.0, "town", "0470-99-9", None, [], [], [], [], None, None, None, None, [], None, None, ["海丸", "第二海丸"], "1-2", "2025-01-01", True),
        (1, "official", "o1", 5, "海丸", None, None, None, None, None, None, None, None, None, None, [], [], ["ヒラメ"], ["コマセ", "泳がせ"], "月曜", None, "説明", None, [], None, "https://umi.jp/", [], None, "2025-09-15", False),
        (2, "registry", "r9", 10, "山丸", None, None, None, None, "千葉県いすみ市大原12-3", None, None, None, "03-1", None, [], [], [], [], None, None, None, None, [], None, None, [], None, "2025-01-01", True),
    ]),
    (_PLAN, [
        (1, "tsuree", "t1", 60, 0, "午前アジ", "乗合", ["アジ"], 9000, "05:00"), (1, "tsuree", "t1", 60, 1, "夜", None, [], None, "18:00"), (1, "chowari", "c1", 100, 0, "午前 アジ", "乗合", ["マダイ"], 9000, "05:00"), (1, "official", "o1", 5, 0, "午前アジ", "乗合", [], 9500, "05:00"),
    ]),
    ddl="id string, name string, kana string, pref string, city string, port string, address string, lat double, geo string, tel string, website string, sns string, types string, targets string, methods string, holidays string, access string, description string, schedule_text string, facilities string, capacity int, plans string, links string, boats string, registry string, fetched string, members string",
    expected=[
        ("b" + _sha("chowari:c1", 9), "釣船 海丸", "うみまる", "千葉県", "いすみ市", "大原", "千葉県いすみ市大原1-2", 35.2, "site", "0470-62-1", "https://umi.jp/", "s2,s1", "仕立,乗合", "アジ,マダイ,ヒラメ", "コマセ,泳がせ", "火曜", "駅から5分", "説明", None, "トイレ", 12, "chowari 午前 アジ 9000,tsuree 夜,official 午前アジ 9500", "chowari https://c/1,tsuree https://t/1", "海丸,第二海丸", "1-2", "2026-02-01", "chowari:c1,tsuree:t1,registry:r1,official:o1"),
        ("b" + _sha("registry:r9", 9), "山丸", None, None, None, None, "千葉県いすみ市大原", None, None, "03-1", None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, "2025-01-01", "registry:r9"),
    ],
)
def merged_records(records, plans):
    """All columns of merged records: by priority, by vote, by ladder, as unions, with their caps and privacy."""
    full = records.withColumn("registry", F.when(c("reg_no").isNotNull(), F.struct("pref", "reg_no", F.lit(None).cast("string").alias("valid_until"), F.lit(None).cast("string").alias("as_of"), F.lit(None).cast("string").alias("src_url"))))
    empty = ("price_text", "return", "meet", "season", "days", "includes", "url")
    out = merge.merged(full, plans.select("*", *[F.lit(None).cast("string").alias(x) for x in empty]))
    joined = lambda x: F.array_join(x, ",").alias(x)
    plan = F.transform("plans", lambda p: F.concat_ws(" ", p["src"], p["name"], p["price"].cast("string")))
    return out.select(
        "id", "name", "kana", "pref", "city", "port", "address", "lat", "geo", "tel", "website", joined("sns"), joined("types"), joined("targets"), joined("methods"), "holidays", "access", "description", "schedule_text", joined("facilities"), "capacity", F.array_join(plan, ",").alias("plans"),
        F.array_join(F.transform("links", lambda l: F.concat_ws(" ", l["src"], l["url"])), ",").alias("links"), joined("boats"), F.array_join(F.transform("registry", lambda g: g["reg_no"]), ",").alias("registry"), "fetched", joined("members"),
    )


@case(
    ("k int, n int, website string, types array<string>, stale boolean, as_of string", [(1, 1, None, ["a"], True, "2024"), (1, 2, "w2", ["b", "a"], True, "2025"), (1, 3, "w3", [], False, None), (2, 1, "", None, True, None), (2, 2, None, ["c"], True, None)]),
    ddl="k int, website string, types array<string>, stale boolean, as_of string", expected=[(1, "w2", ["a", "b"], False, "2025"), (2, None, ["c"], True, None)],
)
def merge_policies(rows):
    """Fill what is empty, unite lists, stale only if all are, the latest day."""
    return merge.absorbed(rows, ["k"], ["n"], fill=["website"], union=["types"], every=["stale"], latest=["as_of"])


@case(
    ("id int, name string, kind string, price int, price_text string", [
        (1, "午前", "乗合", 9000, "9,000円"), (1, "午後", "乗合", 900, "900円"), (1, "仕立", "仕立", 1000, "1人"), (2, "午前", None, 8000, "1人8,000円"), (2, "渡船", None, 3000, "1人3,000円"), (3, "午前", None, 8000, "1人8,000円"), (4, "午前", None, 8000, "8,000円"), (5, "半日", "ガイド", 9000, "1人9,000円"), (6, "午前", "乗合", 90000, ""), (7, "午前", None, 50000, "1名様〜4名様"),
    ]),
    ("id int, noriai boolean", [(1, True), (2, True), (3, False), (4, True), (5, True), (6, True), (7, True)]),
    ddl="id int, price int", expected=[(1, 9000), (2, 8000), (3, 0), (4, 0), (5, 0), (6, 0), (7, 0)],
)
def lowest_shared_fares(plans, noriai):
    """The lowest fare for one on a shared boat, with and without a kind."""
    return merge.minimum_fare(plans, noriai)


@case(
    ("i int, src string, tel string, ukey string", [(1, "gap01", None, ""), (2, "regalt", "", None), (3, "gap01", "03", None), (4, "theboat", None, None), (5, "gap47", None, "x")]),
    ddl="i int, bare boolean", expected=[(1, True), (2, True), (3, False), (4, False), (5, False)],
)
def bare_listings(rows):
    """Records of regional lists without phone and site."""
    return rows.select("i", merge.bare_listing(c("src"), c("tel"), c("ukey")).alias("bare"))


@case(
    ("boat int, n int, tour int, name string, kind string, price int", [(1, 0, 7, "昼", "乗合", 9000), (1, 1, None, "夜", "乗合", 8000), (1, 2, None, "貸切", "仕立", 60000), (1, 3, None, "貸切", "仕立", 60000), (2, 0, None, "朝", "乗合", 7000), (1, 4, 9, "夜", "乗合", 8500)]),
    ("boat int, tour int, name string, kind string, price int", [(1, 7, "昼便", "乗合", 9500), (1, 8, "夜", "乗合", 8200)]),
    ddl="boat int, n int, name string, price int", expected=[(1, 0, "昼便", 9500), (1, 1, "夜", 8200), (1, 2, "貸切", 60000), (1, 3, "夜", 8500), (2, 0, "朝", 7000)],
)
def offers_of_tours(boats, tours):
    """Offers of a boat's tours before its own, which yield to them by number or name; equal ones once."""
    return merge.with_tours(boats, tours).select("boat", "n", "name", "price")


@case(
    ("k int, name string, tel string, tags array<string>", [(1, "海丸", "03", ["a"]), (2, "山丸", "04", []), (3, "星丸", None, ["c"])]),
    ("k int, name string, tel string, tags array<string>", [(1, "第一海丸", "", []), (3, "星丸", "05", ["d"]), (4, "波丸", "06", None)]),
    ddl="k int, name string, tel string, tags array<string>", expected=[(1, "第一海丸", "03", ["a"]), (2, "山丸", "04", []), (3, "星丸", "05", ["d"]), (4, "波丸", "06", None)],
)
def listings_fill_details(listing, detail):
    """What a detail page lacks comes from the list."""
    return merge.enriched(listing, detail, "k")


@case(
    ("k string, office string, tel string", [("1", "海", "03"), ("2", "山", "04")]),
    ("k string, office string, tel string", [("1", "海の家", "03"), ("2", "山", "09"), ("3", "星", "05")]),
    ddl="k string, office string, stale boolean, notes array<string>", expected=[("1", "海", False, ["office: 海の家"]), ("2", "山", False, ["tel: 09"]), ("3", "星", True, [])],
)
def changes_since_last_season(now, before):
    """What last season's list alone has is stale; what differs is noted."""
    return merge.season_changes(now, before, "k", ["office", "tel"]).select("k", "office", "stale", "notes")


@case(
    ("id int, tel string, host string, nkey string, pref string", [(1, "03", None, "あさなぎ", "P"), (2, None, "h.jp", "x", "P"), (3, "", "", "第三あさなぎ", "P"), (4, None, None, "あさな", "P"), (5, None, None, "第三あさなぎ", "Q"), (6, None, None, "あさ", "P"), (7, "09", "h.jp", "x", "P")]),
    ("entity string, tel string, host string, nkey string, pref string", [("e1", "03", "z.jp", "ひので", "P"), ("e2", None, "h.jp", "ゆうなぎ", "P"), ("e3", None, None, "あさなぎ", "P")]),
    ddl="id int, hit string", expected=[(1, "e1"), (2, "e2"), (3, "e3"), (4, "e3"), (5, None), (6, None), (7, "e2")],
)
def known_entities(rows, entities):
    """Whether a record is one of the entities: by phone, by host, by a name inside the other."""
    return merge.known_to(rows, entities)


@case(
    ("id int, pref string, nkey string, kind string, tel string, port string, ukey string", [(1, "P", "a", "s", "03", "", ""), (2, "P", "a", "y", "03", "", ""), (3, "P", "b", "s", "04", "k", ""), (4, "P", "b", "y", "05", "k", ""), (5, "P", "c", "s", None, "", ""), (6, "P", "c", "y", None, "", ""), (7, "P", "d", "s", "06", "", ""), (8, "P", "d", "y", "07", "", ""), (9, "P", "a", "s", "03", "", ""), (10, "P", "e", "s", "1", "", "u"), (11, "P", "e", "y", "2", "", "u")]),
    ddl="id int, partner int", expected=[(2, 1), (4, 3), (6, 5), (9, 2), (11, 10)],
)
def partners_in_other_lists(rows):
    """Rows of one name in two lists whose phone, port or site agrees."""
    return merge.across_lists(rows, ["pref", "nkey"], "kind")


@case(
    ("pref string, tel string, n int", [("千葉県", "03", 1), ("東京都", "03", 2), ("千葉県", "03", 3), ("東京都", "04", 4), ("東京都", None, 5)]),
    ("tel string, name string", [("03", "海丸"), ("03", "海丸"), ("03", "山丸"), ("04", "山丸"), ("04", "星丸"), (None, "星丸")]),
    ddl="what string, tel string, who string", expected=[("owner", "03", "海丸"), ("owner", "04", "山丸"), ("owner", "04", "星丸"), ("kept", "03", "1"), ("kept", "03", "3"), ("kept", "04", "4"), ("kept", None, "2"), ("kept", None, "5")],
)
def phones_and_owners(rows, uses):
    """A phone stays with those who use it most, and with the first prefecture that has it."""
    a = survivorship.owned(uses, "tel", "name").select(F.lit("owner").alias("what"), "tel", c("name").alias("who"))
    b = survivorship.used_in_one(rows, "tel", "pref", "n").select(F.lit("kept").alias("what"), "tel", c("n").cast("string").alias("who"))
    return a.unionByName(b)


@case(
    ("city string, port string, address string, pref string, town string, i int", [("いすみ市", "大原", None, "千葉県", None, 1), ("", "大原", None, "千葉県", None, 2), (None, None, "千葉県いすみ市大原1", "千葉県", "千葉県いすみ市大原", 3), (None, None, None, "千葉県", None, 4), ("一二三四五六七八九十一二三四五六七八九十", "一二三四五六七八九十一二", None, "千葉県", None, 5)]),
    ddl="i int, label string", expected=[(1, "いすみ市 大原"), (2, "大原"), (3, "いすみ市大原"), (4, ""), (5, "一二三四五六七八九十一二三四五六七八九十 一二三四五六七八九")],
)
def place_labels(rows):
    """City and port, else the town, 30 letters at most."""
    return rows.select("i", prepare.place_label(c("city"), c("port"), c("address"), c("pref"), c("town")).alias("label"))


def _raw(rows):
    made = {f: c(f) for f in rows.columns}
    fields = StructType.fromDDL(LISTING)
    return rows.select(*[(made[x.name].cast(x.dataType) if x.name in made else F.lit(None).cast(x.dataType)).alias(x.name) for x in fields])


@case(
    ("src string, src_id string, src_url string, name string, pref string, city string, address string, port string, lat double, lon double, tel string, website string, sns array<string>, types array<string>, targets array<string>, methods array<string>, capacity int, facilities array<string>, holidays string", [
        ("tsuree", " 1 ", "https://t/1#x", "釣船　海丸", "千葉", "いすみ市", "〒298-0004 いすみ市大原1", "大原漁港", 35.1, 140.1, "0470(62)1234", "https://www.facebook.com/umi", ["https://x.com/umi", "mailto:x"], ["乗合船", "貸切"], ["鯛", "ルアー", "アジ釣り"], ["a、b", "a"], 900, ["トイレ、氷"], "火曜"),
        ("gap01", None, None, "ﾔﾏ丸", None, None, "東京都江戸川区1", None, 5.0, 140.1, "なし", "https://www.chowari.jp/x", None, [], [], [], 12, None, ""),
        ("theboat", "", "https://b/9", "星丸（大原）", None, "千葉県館山市", None, "館山港", None, None, "03.1234.5678", "https://profile.ameba.jp/ameba/hoshi", [], None, None, None, None, None, None),
    ]),
    ddl="src string, src_id string, src_url string, name string, address string, pref string, tel string, tel_shown string, website string, sns string, lat double, geo string, types string, targets string, methods string, capacity int, facilities string, holidays string, nkey string, pkey string, ukey string",
    expected=[
        ("tsuree", "1", "https://t/1", "釣船 海丸", "千葉県いすみ市大原1", "千葉県", "0470621234", "0470-62-1234", None, "https://x.com/umi,https://www.facebook.com/umi", 35.1, "site", "乗合,仕立", "マダイ,アジ", "a,b", None, "トイレ,氷", "火曜", "海丸", "大原", None),
        ("gap01", _sha("ヤマ丸", 10), None, "ヤマ丸", "東京都江戸川区1", "東京都", None, None, None, "", None, None, "", "", "", 12, "", None, "やま丸", "", None),
        ("theboat", _sha("https://b/9", 10), "https://b/9", "星丸(大原)", None, "千葉県", "0312345678", "03-1234-5678", "https://ameblo.jp/hoshi/", "", None, None, "", "", "", None, "", None, "星丸", "館山", "ameblo.jp/hoshi"),
    ],
)
def prepared_listings(rows):
    """Listings with clean fields and keys."""
    out = prepare.listings(_raw(rows), "2026-01-01")
    joined = lambda x: F.array_join(F.coalesce(x, F.array().cast("array<string>")), ",").alias(x)
    return out.select("src", "src_id", "src_url", "name", "address", "pref", "tel", "tel_shown", "website", joined("sns"), "lat", "geo", joined("types"), joined("targets"), joined("methods"), "capacity", joined("facilities"), "holidays", "nkey", "pkey", "ukey")


@case(
    ("src string, src_id string, name string, types array<string>, n int, p_name string, kind string, price int, price_text string, depart string, targets array<string>, url string", [
        ("tsuree", "1", "海丸", ["乗合"], 0, "※午前アジ", "乗合船", 9000, "大人 9,000円", "5:30", ["鯵", "ジギング"], "https://t/1#p"), ("tsuree", "1", "海丸", ["乗合"], 1, "レンタル竿", None, 3000, "3,000円", None, None, None), ("tsuree", "1", "海丸", ["乗合"], 2, "", None, 5, None, None, None, None), ("tsuree", "1", "海丸", ["乗合"], 3, "夜", "チャーター", 70000, None, "25:00", [], None),
        ("chowari", "2", "筏の海", [], 0, "レンタル竿", "体験コース", 3000, "3,000円", None, None, None), ("gap01", "3", "筏の海", [], 0, "半日", None, 1500, "1,500円", None, None, None),
    ]),
    ddl="src string, pos int, name string, kind string, price int, price_text string, depart string, targets string, url string",
    expected=[("tsuree", 0, "午前アジ", "乗合", 9000, "大人 9,000円", "05:30", "アジ", "https://t/1"), ("tsuree", 3, "夜", "仕立", 70000, None, "01:00", "", None), ("chowari", 0, "レンタル竿", "体験コース", 3000, "3,000円", None, "", None), ("gap01", 0, "半日", None, 1500, "1,500円", None, "", None)],
)
def cleaned_offers(rows):
    """Offers with clean fields; amounts that are no fares go unless the source is verified."""
    plan = F.struct(c("p_name").alias("name"), "kind", "targets", "price", "price_text", "depart", *[F.lit(None).cast("string").alias(x) for x in ("return", "meet", "season", "days", "includes")], "url")
    listings = rows.groupBy("src", "src_id", "name", "types").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", plan.alias("p")))), lambda x: x["p"]).alias("plans"))
    out = prepare.offers(listings)
    return out.select("src", "pos", "name", "kind", "price", "price_text", "depart", F.array_join(F.coalesce("targets", F.array().cast("array<string>")), ",").alias("targets"), "url")


@case(
    ("rid int, city string, ref_la double, ref_lo double, most_km double, strict boolean", [(1, None, 35.0, 140.0, 150.0, True), (2, None, 35.0, 140.0, 150.0, False), (3, "x市", None, None, 150.0, True), (4, "x市", 35.0, 140.0, 150.0, True), (5, None, None, None, 150.0, True), (6, None, 35.0, 140.0, 150.0, True), (7, "y市", 35.0, 140.0, 150.0, True)]),
    ("rid int, n int, c_city string, la double, lo double, name string", [(1, 1, None, 35.1, 140.0, "a"), (1, 2, None, 37.0, 140.0, "b"), (2, 1, None, 36.0, 140.0, "c"), (3, 1, "x市", 36.0, 140.0, "d"), (3, 2, "z市", 35.0, 140.0, "e"), (4, 1, "x", 36.0, 140.0, "f"), (4, 2, "z市", 35.01, 140.0, "g"), (5, 1, None, 35.0, 140.0, "h"), (6, 1, None, 35.1, 140.0, "i"), (6, 2, None, 35.15, 140.0, "j"), (7, 1, None, 35.5, 140.0, "k")]),
    ddl="rid int, name string", expected=[(1, "a"), (2, "c"), (3, "d"), (4, "f")],
)
def ports_among_candidates(rows, candidates):
    """The port that is surely meant: of the city, within reach, with no second one near by."""
    return coordinates.pick(rows.join(candidates, "rid")).select("rid", "name")


_PORT_ROW = "rid int, pref string, pkey string, city string, ref_la double, ref_lo double, most_km double, strict boolean"
_SITE_ROW = "rid int, pref string, pkey string, la double, lo double"
_OFFICIAL = "pref string, pkey string, n int, c_city string, la double, lo double, name string"
_FEATURE = "pkey string, n int, c_city string, la double, lo double, name string"


@case(
    (_PORT_ROW, [(i, "P", k, None, 35.0, 140.0, 150.0, True) for i, k in ((1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f"), (7, "g"), (11, "a"))]),
    (_SITE_ROW, [(11, "P", "a", 35.0, 140.0), (12, "P", "a", 35.02, 140.0), (13, "P", "a", 35.04, 140.0), (14, "P", "b", 35.2, 140.0), (15, "P", "b", 35.2, 140.0), (16, "P", "c", 35.1, 140.0), (17, "P", "c", 35.12, 140.0), (18, "P", "d", 35.1, 140.0)]),
    (_OFFICIAL, [("P", "a", 1, None, 35.03, 140.0, "a港"), ("P", "b", 1, None, 35.1, 140.0, "b港"), ("P", "f", 1, None, 35.1, 140.0, "f湖港")]),
    (_OFFICIAL, [("P", "d", 1, None, 35.05, 140.0, "d"), ("P", "f", 1, None, 36.0, 140.0, "f")]),
    (_FEATURE, [("e", 1, None, 35.06, 140.0, "e港"), ("f", 1, None, 35.07, 140.0, "f港"), ("d", 1, None, 35.08, 140.0, "d港")]),
    ddl="rid int, la double, basis string, n int",
    expected=[(1, 35.02, "median", 3), (2, 35.1, "jp", 2), (3, 35.12, "median", 2), (4, 35.05, "name", 0), (5, 35.06, "osm", 0), (6, 35.07, "osm", 0), (11, 35.04, "median", 2)],
)
def port_positions(rows, sites, official, named, features):
    """Where ports lie: medians without the row itself, official places, names, features; waters don't count."""
    return coordinates.port_points(rows, sites, official, named, features).select("rid", "la", "basis", c("n").cast("int").alias("n"))


@case(
    ("rid int, pref string, port string, city string, la double, lo double, geo string", [(1, "P", "a", "x", 35.0, 140.0, "town"), (2, "P", "a", "x", 35.0, 140.0, "site"), (3, "P", "a", "x", 35.0, 140.0, "site"), (4, "P", "a", "x", 35.0, 140.0, "port"), (5, "P", "a", "x", 35.0, 140.0, "port"), (6, "P", "琵琶湖", "x", 35.0, 140.0, "town"), (7, "P", "a", "x", 35.0, 140.0, "city"), (8, "P", "b", "x", 35.0, 140.0, "town"), (9, "P", "a", "x", 35.0, 140.0, "port")]),
    ("rid int, la double, lo double, basis string, n int", [(1, 35.04, 140.0, "osm", 0), (2, 35.06, 140.0, "jp", 0), (3, 35.06, 140.0, "jp", 0), (4, 35.1, 140.0, "jp", 3), (5, 35.1, 140.0, "jp", 2), (6, 35.9, 140.0, "jp", 9), (7, 35.2, 140.0, "name", 0), (9, 35.1, 140.0, "osm", 3)]),
    ("rid int, km double", [(2, 3.0), (3, 2.0), (4, 5.0), (5, 5.0), (9, 5.0)]),
    ddl="rid int, la double, geo string, city string, moved boolean",
    expected=[(1, 35.04, "port", "x", True), (2, 35.06, "port", "x", True), (3, 35.0, "site", "x", False), (4, 35.1, "port", "x", True), (5, 35.0, "port", "x", False), (6, 35.0, "town", "x", False), (7, 35.2, "port", None, True), (8, 35.0, "town", "x", False), (9, 35.0, "port", "x", False)],
)
def moves_to_ports(rows, targets, inland):
    """Which positions move to their port, and what becomes of their city."""
    return coordinates.moved_to_ports(rows, targets, coordinates.inland(rows, inland)).select("rid", "la", "geo", "city", "moved")


@case(
    ("rid int, src string, pref string, pkey string, port string, la double, lo double, geo string", [
        (1, "a", "P", "k", "k", 35.0, 140.0, "site"), (2, "b", "P", "k", "k", 35.2, 140.2, "site"), (3, "c", "P", "k", "k", None, None, None), (4, "a", "P", "l", "l", 36.0, 141.0, "town"), (5, "registry", "P", "l", "l", 30.0, 130.0, "town"), (6, "c", "P", "l", "l", None, None, None), (7, "c", "P", "m", "m湖", None, None, None), (8, "c", "P", "n", "沼津内浦", None, None, None),
        (9, "c", "P", "o", "那珂川", None, None, None), (10, "c", "P", "", "", None, None, None), (11, "c", "P", "q", "七色ダム", None, None, None), (12, "c", "P", "r", "r", None, None, None),
    ]),
    ("pref string, port string, la double, lo double, name string, type string", [("P", "m湖", 34.0, 139.0, "m湖", "water"), ("P", "沼津内浦", 33.0, 138.0, "西浦河内川", "river"), ("P", "那珂川", 32.0, 137.0, "那珂川", "river"), ("P", "七色ダム", 31.0, 136.0, "七色貯水池", "river")]),
    ("rid int, la double, lo double", [(8, 30.5, 135.0), (7, 1.0, 1.0)]),
    ddl="rid int, la double, geo string", expected=[(1, 35.0, "site"), (2, 35.2, "site"), (3, 35.2, "port"), (4, 36.0, "town"), (5, 30.0, "town"), (6, 36.0, "port"), (7, 34.0, "port"), (8, 30.5, "port"), (9, 32.0, "port"), (10, None, None), (11, 31.0, "port"), (12, None, None)],
)
def positions_filled(rows, waters, points):
    """Positions of records with a port and none: medians of sources, of addresses, waters (rivers by their exact name), ports."""
    return coordinates.with_port_positions(rows, waters, points).select("rid", "la", "geo")


@case(
    ("pref string, port string, q int, n int, class string, type string, display string, la double, lo double, name string", [("秋田県", "八郎潟", 1, 1, "place", "town", "八郎潟町, 秋田県", 1.0, 1.0, "x"), ("秋田県", "八郎潟", 2, 1, "natural", "water", "八郎潟, 青森県", 2.0, 2.0, "y"), ("秋田県", "八郎潟", 2, 2, "water", "lake", "八郎潟調整池, 秋田県", 39.9123456, 140.0, "八郎潟調整池"), ("秋田県", "八郎潟", 3, 1, "natural", "water", "z, 秋田県", 3.0, 3.0, "z"), ("茨城県", "霞ヶ浦", 1, 1, "highway", "road", "茨城県", 4.0, 4.0, "w")]),
    ddl="pref string, port string, la double, name string", expected=[("秋田県", "八郎潟", 39.91235, "八郎潟調整池")],
)
def waters_picked(answers):
    """The first answer that is a water of the prefecture."""
    return coordinates.water_picks(answers).select("pref", "port", "la", "name")


@case(
    ("i int, port string, pref string", [(1, "神流湖（下久保）", "群馬県"), (2, "霞ヶ浦", "茨城県")]),
    ddl="i int, q array<string>", expected=[(1, ["神流湖 群馬県", "神流湖", "下久保ダム 群馬県", "下久保ダム"]), (2, ["霞ヶ浦 茨城県", "霞ヶ浦"])],
)
def water_queries(rows):
    """What to look up for a water, its other names too."""
    return rows.select("i", coordinates.water_queries(c("port"), c("pref")).alias("q"))


@case(
    ("rid int, la double, lo double, coast double", [(1, 35.0, 140.0, 5.0), (2, 36.0, 140.0, 4.0), (3, 37.0, 140.0, 2.0), (4, 38.0, 140.0, None)]),
    ("la double, lo double", [(35.02, 140.0), (35.05, 140.0), (36.09, 140.0), (36.0, 140.11)]),
    ddl="rid int, km double, inland double, doubtful boolean", expected=[(1, 2.224, 5.0, False), (2, 10.008, 4.0, True), (3, None, 2.0, False), (4, None, 0.0, False)],
)
def doubtful_positions(places, ports):
    """Places far inland without a port close by; unknown coasts count as none."""
    inland = coordinates.inland(places, places.select("rid", c("coast").alias("km"))).withColumnRenamed("km", "coast_km")
    near = coordinates.nearest_in_box(places, ports).withColumnRenamed("km", "port_km")
    both = inland.join(near, "rid")
    flagged = gazetteer.doubtful(both.withColumnRenamed("rid", "id")).select(c("id").alias("rid"), F.lit(True).alias("doubtful"))
    return both.join(flagged, "rid", "left").select("rid", F.round("port_km", 3).alias("km"), c("coast_km").alias("inland"), F.coalesce("doubtful", F.lit(False)).alias("doubtful"))


@case(
    ("n int, pref string, name string, la double, lo double", [(1, "P", "三角東港（新）", 35.0, 140.0), (2, "P", "三角東港", 35.005, 140.0), (3, "P", "三角東漁港", 35.02, 140.0), (4, "P", "浦港", 35.0, 140.0)]),
    ddl="pref string, pkey string, n int", expected=[("P", "三角東港新", 1), ("P", "三角東", 1), ("P", "三角東", 3)],
)
def gazetteer_of_ports(ports):
    """Ports by their keys, with and without brackets, thinned by boxes; keys of one letter go."""
    return coordinates.port_gazetteer(ports).select("pref", "pkey", "n")


@case(
    ("pref string, key string, n int, display string, class string, type string, la double, lo double", [("千葉県", "a", 1, "x, 東京都", "natural", "bay", 1.0, 1.0), ("千葉県", "a", 2, "x, 千葉県", "shop", "x", 2.0, 2.0), ("千葉県", "a", 3, "x, 千葉県", "leisure", "marina", 35.0, 140.0), ("千葉県", "b", 1, "y, 千葉県", "place", "hamlet", 35.0, 140.0), ("千葉県", "c", 1, "z, 千葉県", "building", "yes", 35.0, 140.0)]),
    ddl="key string, n int, tier int", expected=[("a", 3, 1), ("b", 1, 2), ("c", 1, 3)],
)
def port_answers(answers):
    """The first answer of a usable class in the prefecture, and how far it is trusted."""
    return gazetteer.port_picks(answers).select("key", "n", "tier")


@case(
    ("area string, ring int, points array<string>", [("A", 0, ["35,135", "35,136", "36,136", "36,135"]), ("B", 0, ["35,136", "35,137", "36,137", "36,136"])]),
    ("pid int, la double, lo double", [(1, 35.5, 135.5), (2, 34.99, 136.5), (3, 30.0, 130.0), (4, 35.5, 136.5)]),
    ddl="pid int, area string, south double, east double", expected=[(1, "A", 35.0, 136.0), (2, "B", 35.0, 137.0), (4, "B", 35.0, 137.0)],
)
def areas_or_nearest(rings, points):
    """The area that a point lies in, else the nearest within 5 km, with the area's box."""
    at = F.transform("points", lambda p: F.struct(F.substring_index(p, ",", 1).cast("double").alias("la"), F.substring_index(p, ",", -1).cast("double").alias("lo")))
    edges = spatial.ring_edges(rings.withColumn("points", at))
    boxes = spatial.boxes(edges).toDF("area", "south", "west", "north", "east")
    return spatial.areas_or_nearest(points, edges).join(boxes, "area").select("pid", "area", "south", "east")


@case(
    ("k string, n int, la double, lo double", [("a", 1, 35.0, 140.0), ("a", 2, 35.001, 140.0), ("a", 3, 35.1, 140.0), ("b", 1, 35.0, 140.0)]),
    ddl="k string, n int", expected=[("a", 1), ("a", 3), ("b", 1)],
)
def candidates_thinned(points):
    """Candidates at least 1.5 km from those taken before."""
    return gazetteer.thinned(points, "k", "n").select("k", "n")


@case(
    ("pref string, city string, n int", [("千葉県", "いすみ市", 1), ("千葉県", "いすみ市", 2), (None, "いすみ市", 3), ("千葉県", "中央区", 4), ("東京都", "中央区", 5), (None, "中央区", 6), (None, "x", 7)]),
    ddl="n int, pref string", expected=[(1, "千葉県"), (2, "千葉県"), (3, "千葉県"), (4, "千葉県"), (5, "東京都"), (6, None), (7, None)],
)
def prefectures_of_cities(rows):
    """A city that lies in one prefecture gives it to rows that lack it."""
    return lookup.imputed(rows, "city", "pref", "full").select("n", c("full").alias("pref"))


@case(
    ("area string, ring int, points array<string>", [("A", 0, ["35,135", "35,136", "36,136", "36,135"]), ("B", 0, ["35,136", "35,137", "36,137", "36,136"])]),
    ("pid int, area string, la double, lo double", [(1, "A", 35.5, 135.5), (2, "A", 35.5, 136.005), (3, "A", 35.5, 136.5), (4, "B", 35.5, 136.5), (5, "A", 36.008, 135.5), (6, "A", 36.02, 135.5), (7, "C", 35.5, 135.5)]),
    ddl="pid int, inside boolean, within boolean", expected=[(1, True, True), (2, False, True), (3, False, False), (4, True, True), (5, False, True), (6, False, False), (7, False, False)],
)
def points_in_their_own_area(rings, points):
    """Points in the area that they say, or within a kilometre of it."""
    at = F.transform("points", lambda p: F.struct(F.substring_index(p, ",", 1).cast("double").alias("la"), F.substring_index(p, ",", -1).cast("double").alias("lo")))
    return spatial.within_own_area(points, spatial.ring_edges(rings.withColumn("points", at)))


@case(
    ("id int, links string", [(1, "a"), (2, "b"), (3, None)]), ("k int, src string", [(1, "x"), (2, "x"), (2, "y")]),
    ddl="id int, children array<string>, n int", expected=[(1, ["x"], 1), (2, ["x", "y"], 2), (3, [], 0)],
)
def parents_with_children(parents, children):
    """Parents with their children as arrays, those without any too."""
    of = children.groupBy(c("k").alias("id")).agg(F.array_sort(F.collect_set("src")).alias("children"))
    return parents.join(of, "id", "left").select("id", F.coalesce("children", F.array().cast("array<string>")).alias("children"), F.coalesce(F.size("children"), F.lit(0)).alias("n"))


@case(
    ("id int, name string, city string, website string, tel string", [(1, "海丸", None, None, "03"), (2, "海丸", "x", "w1", None), (3, "山丸", "x", "w1", "04"), (4, "山丸", "y", None, None), (5, "星丸", "y", None, None), (6, "山丸", "x", None, None)]),
    ddl="id int, name string, city string, website string, tel string, members array<int>", expected=[(1, "海丸", "x", "w1", "03", [1, 2, 3, 6]), (4, "山丸", "y", None, None, [4]), (5, "星丸", "y", None, None, [5])],
)
def merged_until_settled(rows):
    """Records of one list: equal names without other cities, or equal sites in one city, merged until none fit; a merge fills
    in what makes others fit."""

    def pairs(first, second):
        side = lambda n: (first if n == "a" else second).select(*[c(x).alias(f"{n}_{x}") for x in ("id", "names", "city", "website")])
        named = side("a").withColumn("k", F.explode("a_names")).join(side("b").withColumn("k", F.explode("b_names")), "k")
        sited = side("a").withColumn("k", c("a_website")).join(side("b").withColumn("k", c("b_website")), "k")
        by_name = named.where("a_id < b_id AND (a_city = b_city OR a_city IS NULL AND b_website IS NOT NULL)")
        by_site = sited.where("a_id < b_id AND a_city = b_city")
        return by_name.unionByName(by_site).select(c("a_id").alias("a"), c("b_id").alias("b"))

    def merge_rows(r):
        items = merge.absorbed(r, ["root"], ["id"], fill=["name", "city", "website", "tel"], union=["names", "members"])
        return items.withColumnRenamed("root", "id")

    start = rows.withColumn("names", F.array("name")).withColumn("members", F.array("id"))
    return resolve.agglomerated(start, pairs, merge_rows).select("id", "name", "city", "website", "tel", F.array_sort("members").alias("members"))
