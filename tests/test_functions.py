import pytest
from pyspark.sql import functions as F

from shoalmark.functions import offers, places, text, web


def values(spark, f, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("c")).alias("v")).collect()]


def test_name_key(spark):
    rows = ["第十八八竜丸", "釣船 龍丸（大原港）", "ﾋﾞｯｸﾞﾎﾞｰｲ", "有限会社 Sea-Star", None, ""]
    assert values(spark, text.name_key, rows) == ["18八竜丸", "竜丸", "びっぐぼい", "seastar", "", ""]


@pytest.mark.parametrize("s, n", [("十八", 18), ("百二十三", 123), ("二三", 23), ("", 0), ("十", 10), ("九百九十九", 999)])
def test_kanji_number(s, n):
    assert text.kanji_number(s) == n


def test_similar_names(spark):
    pairs = [("永宝丸", "知床永宝丸", True), ("びっぐぼい", "びっくぼい", True), ("丸", "大丸", False), ("", "", False), ("5嘉丸", "嘉丸", True), ("海", "山", False)]
    df = spark.createDataFrame(pairs, "a string, b string, e boolean")
    assert all(r.v == r.e for r in df.select("e", text.similar_name(F.col("a"), F.col("b")).alias("v")).collect())


def test_phone(spark):
    rows = ["電話 0470(62)1234 まで", "090-1234-5678", "0000000000", "abc", "受付 03.1234.5678", None]
    assert values(spark, web.phone_key, rows) == ["0470621234", "09012345678", None, None, "0312345678", None]


def test_urls(spark):
    rows = ["https://www.Example.com/index.html?utm_source=x#top", "http://ameblo.jp/Boat/entry.html", "https://user@a.jp:80/Boats/list", "mailto:x", None]
    assert values(spark, web.host_of, rows) == ["example.com", "ameblo.jp", "a.jp", "", ""]
    assert values(spark, web.site_key, rows) == ["example.com", "ameblo.jp/boat", "a.jp/boats", None, None]
    assert values(spark, web.url_class, ["https://m.facebook.com/x", "https://google.com/maps", "https://a.jp", ""]) == ["sns", "portal", "official", None]


def test_clock(spark):
    assert values(spark, offers.clock, ["5:30出船", "25時", "30:00", "7時5", "なし", None]) == ["05:30", "01:00", None, "07:00", None, None]


def test_amounts(spark):
    assert values(spark, offers.amounts, ["1万5千円", "1.5万円", "12,000円と¥9000", "なし"]) == [[15000], [15000], [12000, 9000], []]


def test_addresses(spark):
    rows = ["〒298-0004 千葉県いすみ市大原123-4", "東京都江戸川区西葛西三丁目5", "大原", "千葉いすみ"]
    assert values(spark, places.town_level, rows) == ["千葉県いすみ市大原", "東京都江戸川区西葛西", "大原", "千葉いすみ"]
    assert values(spark, lambda c: places.prefecture(places.clean_address(c)), rows) == ["千葉県", "東京都", None, "千葉県"]


def test_near_is_three_valued(spark):
    d = F.lit(None).cast("double")
    row = spark.range(1).select(places.near(d, 5).alias("a"), places.near(d, 5, True).alias("b"), places.near(d, 5, False).alias("c")).first()
    assert tuple(row) == (None, True, False)


def test_junk_offers(spark):
    rows = [
        ("乗合", "大人 9,000円", 9000, "乗合", False), ("プラン", "レンタル竿 3,000円", 3000, None, True), ("プラン", "エサ付き 9,000円", 9000, None, False), ("プラン", "小学生 6,000円", 6000, "乗合", True),
        ("渡船 磯", "磯 2,000円", 2000, "渡船", False), ("半日", "1,500円", 1500, None, True), ("【仮眠部屋】", "3,000円", 3000, None, True),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, name string, text string, price int, kind string, e boolean")
    got = df.orderBy("i").select("e", offers.junk_offer(F.col("name"), F.col("text"), F.col("price"), F.col("kind"), F.lit(False)).alias("v")).collect()
    assert [r.v for r in got] == [r.e for r in got]
