"""Cases of the client's operators, and of lists, orders and machines over lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoalmark.functions import display
from shoalmark.operators import extract, ordered, search, survivorship
from shoalmark.operators.search import QuerySpec
from . import case

c = F.col


@case(
    ("i int, n int, kind string, price int", [(1, 0, None, 100), (1, 1, "渡船", 3000), (1, 2, "仕立", None), (1, 3, "乗合", 9000), (1, 4, "乗合", 8000), (1, 5, "仕立", 50000), (1, 6, "ガイド", 50), (1, 7, "乗合", 0)]),
    ddl="i int, shown array<int>, hidden int", expected=[(1, [4, 3, 7, 5, 2, 1], 2)],
)
def offers_as_shown(rows):
    """Offers by kind, then price, unknown prices last; the first six are shown."""
    plans = rows.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("n", "kind", "price"))).alias("p"))
    order = F.transform(display.in_order(c("p")), lambda p: p["n"])
    return plans.select("i", F.slice(order, 1, display.OFFERS_SHOWN).alias("shown"), F.greatest(F.lit(0), F.size("p") - display.OFFERS_SHOWN).alias("hidden"))


@case(
    ("i int, price int, t string, kind string", [(1, 9000, "1人9,000円（税込）", None), (2, 9000, "9,000円", "乗合"), (3, 60000, "6名まで60,000円〜", "仕立"), (4, None, "応相談", None), (5, 9000, None, None), (6, 9000, "大人1名 9,000円", None), (7, 9000, "9,500円", "乗合")]),
    ddl="i int, price string, unit string, note string", expected=[(1, "9,000円", "1人", None), (2, "9,000円", "1人", None), (3, "60,000円", None, "6名まで60,000円〜"), (4, "", None, "応相談"), (5, "9,000円", None, None), (6, "9,000円", "1人", "大人1名 9,000円"), (7, "9,000円", "1人", "9,500円")],
)
def prices_as_shown(rows):
    """A price with its unit; its text only where that says more."""
    return rows.select("i", display.price_shown(c("price"), c("t"), c("kind")).alias("p")).select("i", "p.*")


@case(
    ("i int, targets array<string>, cat int", [(1, ["a", "b"], 0), (2, ["b"], 0), (3, ["c"], 0), (4, ["c", "d"], 0), (5, ["d"], 2), (6, ["e"], 2), (7, ["c"], 0)]),
    ddl="place int, value string, pressed boolean, n bigint", expected=[(1, "c", False, 5), (2, "d", False, 3), (3, "b", True, 2)],
)
def facet_chips(rows):
    """The chips by what they add, then by how often they occur, and the pressed ones."""
    index = rows.withColumns({"text": F.lit(""), "flags": F.lit(0), "price": F.lit(0), "pref": F.lit(1), "region": F.lit("r")})
    spec = QuerySpec(targets=frozenset({"b"}), registry=False)
    return search.chips(search.chip_values(index, spec, ["a", "b", "c", "d", "e", "f"]), most=2)


@case(
    ("i int, asked boolean, auto boolean, words int, before int, now int", [(1, True, False, 0, 0, 0), (2, False, True, 1, 900, 400), (3, False, True, 0, 900, 400), (4, False, True, 1, 400, 400), (5, False, True, 1, 900, 501), (6, False, True, 1, 900, 0), (7, False, False, 1, 900, 4)]),
    ddl="i int, fit boolean", expected=[(1, True), (2, True), (3, False), (4, False), (5, False), (6, False), (7, False)],
)
def map_fits(rows):
    """When the map moves to what is found."""
    return rows.select("i", search.fits_map(c("asked"), c("auto"), c("words"), c("before"), c("now")).alias("fit"))


@case(
    ("i int, q string", [(1, "q=a+b&f=x%2Cy&k=ns&p=7000&pf=12&pl=1&w=1&r=0&b=id1"), (2, "g=east"), (3, "p=5&pf=99&k=zz"), (4, "#k=t&g=x&pf=3"), (5, "")]),
    ddl="i int, state string", expected=[(1, "b=id1&q=a+b&f=x%2Cy&k=ns&p=7000&pf=12&pl=1&w=1&r=0"), (2, "g=east"), (3, ""), (4, "k=t&pf=3"), (5, "")],
)
def query_states(rows):
    """States of the query as they are read from a URL and written again; unknown values are dropped."""
    return rows.select("i", F.udf(lambda q: QuerySpec.parse(q).url(), "string")("q").alias("state"))


@case(
    ("row string", [('["b1","海丸","カイマル",35.1,140.2,12,"いすみ市 大原",9,9000,[1,0]]',), ('["b2","Sea-Star","",34.0,139.0,13,"",0,0,[]]',)]),
    ddl="id string, name string, lat double, pref int, flags int, price int, targets array<string>, text string, cat int", expected=[("b1", "海丸", 35.1, 12, 9, 9000, ["アジ", "マダイ"], "海丸かいまるいすみ市大原あじまだい", 0), ("b2", "Sea-Star", 34.0, 13, 0, 0, [], "seastar", 2)],
)
def positional_rows(rows):
    """Positional rows of the client's script with names, search text and category."""
    out = search.decoded_index(rows, ["マダイ", "アジ"])
    cat = F.when(c("flags").bitwiseAND(1) != 0, 0).when(c("flags").bitwiseAND(2 | 256) != 0, 1).otherwise(2)
    return out.select("id", "name", "lat", "pref", "flags", "price", "targets", "text", cat.alias("cat"))


@case(
    ("i int, kind string, label string, url string, host string, pref string, place string, fish array<string>, total int", [(1, "booking", "釣割", "https://c/1", "instagram.com", "千葉県", "大原", ["a", "b", "c", "d"], 1250), (2, "catch", "釣りビジョン", "https://f/choka/1", "www.x.com", "千葉県", "", [], 100), (3, "catch", "THE BOAT", "https://t/1", "umi.jp", "東京都", None, ["a"], 101)]),
    ddl="i int, button string, network string, line string, more string, fare string", expected=[(1, "釣割で予約", "Instagram", "千葉県 大原 · a・b・c", "さらに表示（残り 1,150 件）", "1,250円"), (2, "釣りビジョンの釣果", "X", "千葉県", None, "100円"), (3, "THE BOATの掲載ページ", "umi.jp", "東京都 · a", "さらに表示（残り 1 件）", "101円")],
)
def labels_as_shown(rows):
    """Texts of buttons, networks, entries, the rest of a list, and money."""
    return rows.select("i", display.link_label(c("kind"), c("label"), c("url")).alias("button"), display.network_name(c("host")).alias("network"), display.entry_line(c("pref"), c("place"), c("fish")).alias("line"), display.more_label(c("total"), F.lit(display.PAGE)).alias("more"), display.yen(c("total")).alias("fare"))


@case(
    ("doc string, n int, header string, t string, value int", [("d", 1, "午前", "1名 9,000円", 9000), ("d", 2, "午前", "2名 16,000円", 16000), ("d", 3, None, "3名 24,000円", 24000), ("d", 4, "午前", "4名 8,000円", 8000), ("e", 1, "夜", "1名 5,000円", 5000)]),
    ddl="doc string, first int, name string, kind string, price_text string", expected=[("d", 1, "午前 人数別料金", "", "1名 9,000円 / 2名 16,000円"), ("d", 3, "人数別料金", "仕立", "3名 24,000円"), ("d", 4, "午前 人数別料金", "", "4名 8,000円"), ("e", 1, "夜 人数別料金", "", "1名 5,000円")],
)
def price_lists_rolled_up(rows):
    """Prices by number of people as one offer for each run of a header."""
    return extract.rolled_up(rows.withColumnRenamed("t", "text"), "doc")


@case(
    ("doc string, ln int, line string", [
        ("d", 1, "【乗合】"), ("d", 2, "集合4:30、出船5:00、帰港12:00"), ("d", 3, "大人 9,000円 女性 7,000円"), ("d", 4, "レンタル竿 1,000円"), ("d", 5, "午後アジ船 13:00~17:30 8,500円"), ("d", 6, "【仕立船】"), ("d", 7, "6名まで 60,000円"), ("d", 8, "出船は6時から、沖上がりは13時"), ("e", 1, "料金応談"), ("e", 2, "半日 5,000円/人"),
    ]),
    ddl="doc string, ln int, n int, kind string, name string, price int, unit string, depart string, back string, meet string",
    expected=[
        ("d", 3, 0, "乗合", "乗合", 9000, "person", "05:00", "12:00", "04:30"), ("d", 5, 0, "乗合", "午後アジ船", 8500, "person", "13:00", "17:30", None), ("d", 7, 0, "仕立", "仕立船", 60000, "boat", "06:00", "13:00", None), ("e", 2, 0, None, "半日", 5000, "person", None, None, None),
    ],
)
def fares_of_free_text(rows):
    """Offers of lines of free text: sections, kinds, times from above and below, several amounts; fares of women and gear go."""
    return extract.plans(rows, "doc", "ln", "line")


@case(
    ("g string, n int, v string", [("a", 1, None), ("a", 2, None), ("a", 3, "x"), ("a", 4, None), ("b", 1, None), ("b", 2, "y"), ("b", 3, "z")]),
    ddl="g string, n int, v string, whole string", expected=[("a", 1, "x", "x"), ("a", 2, "x", "x"), ("a", 3, "x", "x"), ("a", 4, None, "x"), ("b", 1, "y", "y"), ("b", 2, "y", "y"), ("b", 3, "z", "z")],
)
def times_from_below(rows):
    """Values found later given to the rows above them, and the first of a group to all that lack one."""
    w = ordered.over(["g"], ["n"])
    back = ordered.back_fill(c("v"), w)
    return rows.select("g", "n", back.alias("v"), F.coalesce(back, ordered.forward_fill(c("v"), w)).alias("whole"))


@case(
    ("pos int, office string, tel string, boat string", [(1, "海", "03-1", "b1"), (2, "山", "04", "b2"), (3, "海", "031", "b3"), (4, "海", None, "b4"), (5, "山", "04", "b2")]),
    ddl="place int, office string, boats array<string>, kinds int", expected=[(1, "海", ["b1", "b3"], 2), (2, "山", ["b2", "b2"], 1), (3, "海", ["b4"], 1)],
)
def rows_grouped_in_order(rows):
    """Rows of one office and phone as one, in the order in which they first come, with their boats."""
    return survivorship.grouped(rows.withColumn("digits", F.regexp_replace("tel", "[^0-9]", "")), ["office", "digits"], "pos", "boat").select("place", "office", c("items").alias("boats"), F.size("distinct_items").alias("kinds"))


@case(
    ("id string, pref string, lat double, port string, code string", [("a", "P", 35.0, "k", "b:10"), ("b", None, 35.0, "k", "b:9"), ("c", "P", None, "l", "a:2"), ("d", "P", 35.0, "k", "a:11")]),
    ddl="what string, place int, value string", expected=[("placed", None, "a"), ("placed", None, "d"), ("unplaced", None, "b"), ("unplaced", None, "c"), ("port", 1, "k"), ("port", 2, "l"), ("code", 1, "a:2"), ("code", 2, "a:11"), ("code", 3, "b:9"), ("code", 4, "b:10"), ("top", 1, "k")],
)
def orders_and_splits(rows):
    """Rows with and without a place; ports by use; codes by their parts; the most frequent."""
    placed = ordered.placed(rows)
    a = placed.select(F.when(c("placed"), "placed").otherwise("unplaced").alias("what"), F.lit(None).cast("int").alias("place"), c("id").alias("value"))
    ports = ordered.by_use(rows, "port")
    b = ports.select(F.lit("port").alias("what"), "place", c("port").alias("value"))
    codes = ordered.by_parts(rows, "code", ":")
    return a.unionByName(b).unionByName(codes.select(F.lit("code").alias("what"), "place", c("code").alias("value"))).unionByName(ports.where("place <= 1").select(F.lit("top").alias("what"), "place", c("port").alias("value")))


@case(
    ("i int, a array<string>, b array<int>", [(1, ["x", "y", "x"], [3, 1, 2]), (2, [], None), (3, None, [7])]),
    ddl="i int, uniq array<string>, top int, has boolean, first string", expected=[(1, ["x", "y"], 3, True, "x=3"), (2, [], None, False, None), (3, None, 7, None, None)],
)
def arrays_searched(rows):
    """Distinct items in order, greatest, membership, the first entry of an array of structs that fits."""
    pairs = F.arrays_zip(c("a").alias("k"), c("b").alias("v"))
    hit = F.get(F.filter(pairs, lambda p: p["k"] == "x"), F.lit(0))
    return rows.select("i", F.array_distinct("a").alias("uniq"), F.array_max("b").alias("top"), F.array_contains("a", "x").alias("has"), F.when(hit.isNotNull(), F.concat(hit["k"], F.lit("="), hit["v"].cast("string"))).alias("first"))
