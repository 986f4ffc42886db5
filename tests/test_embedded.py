import datetime
import json

from pyspark.sql import functions as F

from shoalmark.functions import embedded as e
from shoalmark.operators import gazetteer, ordered, prepare, spatial
from shoalmark.schema import LISTING


def one(spark, c, text):
    return spark.createDataFrame([(text,)], "c string").select(c(F.col("c")).alias("v")).first().v


def test_positions(spark):
    assert tuple(one(spark, e.map_position, "x!2d139.5!3d35.25!y")) == (35.25, 139.5)
    assert tuple(one(spark, e.map_position, 'href="?q=35.5,139.75"')) == (35.5, 139.75)
    assert one(spark, e.map_position, "?q=5.5,139.75") is None


def test_json_ld_and_labels(spark):
    page = '<script type="application/ld+json">{"@graph":[{"name":"海丸","telephone":"03"}]}</script><dl><dt>電話番号</dt><dd>03-1</dd><dt>TEL</dt><dd>9</dd></dl><tr><th>住所 </th><td>千葉<b>県</b></td></tr>'
    assert one(spark, lambda c: e.json_ld(c, "name"), page) == "海丸"
    assert one(spark, lambda c: e.labelled(c, {"電話番号": "tel", "TEL": "tel", "住所": "address"}), page) == {"tel": "03-1", "address": "千葉 県"}


def test_small_parsers(spark):
    assert e.id_ranges("3,7-9, 12") == [3, 7, 8, 9, 12]
    assert one(spark, e.iso_date, "更新 2025年1月2日") == datetime.date(2025, 1, 2) and one(spark, e.iso_date, "2025/2/30") is None
    seasons = spark.createDataFrame([([1, 2, 11, 12],), (list(range(1, 13)),), ([3],), ([1, 2, 5, 6, 7],), ([],)], "m array<int>").select(e.season(F.col("m")).alias("v")).collect()
    assert [r.v for r in seasons] == ["11月~2月", "通年", "3月", "1月~2月、5月~7月", ""]
    assert one(spark, lambda c: e.vocabulary(c, ["アジ", "ライトアジ", "イカ"]), "ライトアジとイカとアジ") == ["ライトアジ", "イカ", "アジ"]
    items = F.array(*map(F.lit, ["アコウ(キジハタ)", "鯛", "ルアー", "真鯛釣り", "アジ2匹", "鯛"]))
    assert spark.range(1).select(e.canonical(items, {"鯛": "マダイ", "真鯛": "マダイ", "アコウ": "キジハタ", "ルアー": None}).alias("v")).first().v == ["キジハタ", "マダイ"]
    rules = F.array(F.struct(F.lit(False).alias("allow"), F.lit("/a").alias("prefix")), F.struct(F.lit(True).alias("allow"), F.lit("/a/b").alias("prefix")))
    assert [one(spark, lambda c: e.allowed(c, rules), p) for p in ("/a/b/c", "/a/x", "/z")] == [True, False, True]
    assert spark.range(1).select(e.pages_of(F.lit(31), 15).alias("v")).first().v == [1, 2, 3]


def test_prepare(spark):
    record = {
        "src": "tsuree", "src_id": " 1 ", "name": "釣船　海丸", "pref": "千葉", "address": "〒298-0004 いすみ市大原1", "tel": "0470(62)1234", "website": "https://www.facebook.com/umi", "sns": ["https://x.com/umi", "mailto:x"], "lat": 99.0, "lon": 140.0,
        "types": ["乗合船"], "methods": ["a、b", "a"], "capacity": 900, "port": "大原漁港",
        "plans": [{"name": "※午前アジ", "kind": "乗合船", "price": 9000, "price_text": "大人 9,000円", "depart": "5:30"}, {"name": "レンタル竿", "price": 3000, "price_text": "3,000円"}, {"name": "", "price": 5}, {"name": "夜", "kind": "仕立", "price": 70000, "depart": "25時"}],
    }
    raw = spark.read.schema(LISTING).json(spark.sparkContext.parallelize([json.dumps(record, ensure_ascii=False)]))
    r = prepare.listings(raw, "2026-01-01").first()
    assert (r.src_id, r.nkey, r.pref, r.address, r.pkey, r.tel) == ("1", "海丸", "千葉県", "千葉県いすみ市大原1", "大原", "0470621234")
    assert r.website is None and r.sns == ["https://x.com/umi", "https://www.facebook.com/umi"]
    assert (r.lat, r.geo, r.capacity, r.types, r.methods, r.fetched) == (None, None, None, ["乗合"], ["a", "b"], "2026-01-01")
    plans = prepare.offers(raw).orderBy("pos").collect()
    assert [(p.name, p.kind, p.price, p.depart) for p in plans] == [("午前アジ", "乗合", 9000, "05:30"), ("夜", "仕立", 70000, "01:00")]


def test_claims(spark):
    claims = spark.createDataFrame([("s", 1, 9000, "05:30"), ("s", 2, 15000, None), ("s", 3, 7000, None), ("s", 4, None, "13:00")], "key string, n int, price int, depart string")
    texts = spark.createDataFrame([("s", "乗合 9千円 出船5時半、仕立は1万5千円 午後1時")], "key string, text string")
    assert [(r.n, r.price_unstated, r.time_unstated) for r in prepare.false_claims(claims, texts, "key").collect()] == [(3, True, False)]


def test_gazetteer(spark):
    answers = spark.createDataFrame([("千葉県いすみ市大原", 0, "千葉県", 35.0, 140.0), ("千葉県いすみ市大原", 1, "千葉県いすみ市", 35.1, 140.1), ("千葉県いすみ市大原", 2, "千葉県いすみ市大原", 35.2, 140.2), ("千葉県いすみ市大原", 3, "東京都港区", 35.3, 140.3)], "q string, n int, title string, la double, lo double")
    r = gazetteer.best_answers(answers, F.lit("千葉県")).first()
    assert (r.title, r.la, r.level) == ("千葉県いすみ市大原", 35.2, "town")
    points = spark.createDataFrame([("a", 1, 35.0, 140.0), ("a", 2, 35.001, 140.0), ("a", 3, 35.1, 140.0)], "k string, n int, la double, lo double")
    assert sorted(r.n for r in gazetteer.thinned(points, "k", "n").collect()) == [1, 3]


def test_spatial_against_all_pairs(spark):
    import math
    import random

    rng = random.Random(1)
    a = [(i, rng.uniform(30, 40), rng.uniform(130, 140)) for i in range(80)]
    b = [(i, rng.uniform(30, 40), rng.uniform(130, 140)) for i in range(80)]

    def km(p, q):
        x = math.radians(q[2] - p[2]) * math.cos(math.radians((p[1] + q[1]) / 2))
        return math.hypot(x, math.radians(q[1] - p[1])) * 6371

    got = {(r.lid, r.rid) for r in spatial.within_km(spark.createDataFrame(a, "lid int, la double, lo double"), spark.createDataFrame(b, "rid int, la double, lo double"), 90, latitude=45).collect()}
    assert got == {(p[0], q[0]) for p in a for q in b if km(p, q) <= 90}


def test_gaps(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 5), ("b", 1)], "k string, n int")
    assert sorted((r.k, r.n) for r in ordered.missing_numbers(rows, ["k"], "n").collect()) == [("a", 1), ("a", 3), ("a", 4)]
