import json

from pyspark.sql import functions as F

from shoalmark.functions import places, text
from shoalmark.operators import pages, spatial, survivorship
from shoalmark.sources import geometry, json_listings, publish


def test_labels_and_samples(spark):
    assert json_listings.preferred(["x/a.json", "x/a.sample.json", "x/b.sample.json"]) == ["x/a.json", "x/b.sample.json"]
    rows = json_listings.with_labels(spark.createDataFrame([("a",), ("z",)], "src string"), spark.createDataFrame([("a", "A", "booking", 90)], "src string, label string, kind string, prio int"))
    assert sorted(tuple(r) for r in rows.select("src", "label", "kind", "prio").collect()) == [("a", "A", "booking", 90), ("z", "z", "directory", 40)]


def test_map_extract(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"elements": [{"lat": 1.0, "lon": 2.0, "tags": {"name": "港", "harbour": "yes"}}, {"center": {"lat": 3.0, "lon": 4.0}, "tags": {"name": "町", "place": "town"}}, {"lat": 1.0, "lon": 1.0, "tags": {}}]}))
    assert sorted((r.name, r.kind, r.la) for r in geometry.osm_places(spark, str(tmp_path / "o.json")).collect()) == [("港", "harbour=yes", 1.0), ("町", "place=town", 3.0)]


def test_charset(spark):
    files = spark.createDataFrame([(1, "海丸のひらがな".encode("cp932")), (2, "海丸のひらがな".encode("euc_jp")), (3, "海丸のひらがな".encode()), (4, None)], "i int, content binary")
    assert [r.text for r in geometry.decoded(files).orderBy("i").collect()] == ["海丸のひらがな"] * 3 + [None]


def test_public_and_blanked(spark):
    rows = spark.createDataFrame([(1, False, "x", 5), (2, True, "y", 6)], "id int, stale boolean, _k string, price int")
    assert [tuple(r) for r in publish.public(rows).orderBy("id").collect()] == [(1, None, 5), (2, True, 6)]
    flags = spark.createDataFrame([(2, True)], "id int, price_unstated boolean")
    assert [r.price for r in publish.blanked(rows, flags, ["id"], ["price"]).orderBy("id").collect()] == [5, None]


def test_votes(spark):
    rows = spark.createDataFrame([("t", "a", 1), ("t", "a", 2), ("t", "b", 3), ("u", "b", 4)], "v string, o string, n int")
    assert sorted(tuple(r) for r in survivorship.owned(rows, "v", "o").collect()) == [("t", "a"), ("u", "b")]
    assert [r.v for r in survivorship.used_in_one(rows, "v", "o", "n").orderBy("n").collect()] == ["t", "t", None, "u"]


def test_areas(spark):
    rings = spark.createDataFrame([("A", 0, [(35.0, 135.0), (35.0, 136.0), (36.0, 136.0), (36.0, 135.0)])], "area string, ring int, points array<struct<la: double, lo: double>>")
    edges = spatial.ring_edges(rings)
    points = spark.createDataFrame([(1, 35.5, 135.5), (2, 34.99, 135.5), (3, 30.0, 130.0)], "pid int, la double, lo double")
    assert sorted(tuple(r) for r in spatial.areas_or_nearest(points, edges).collect()) == [(1, "A"), (2, "A")]
    assert tuple(spatial.boxes(edges).first()) == ("A", 35.0, 135.0, 36.0, 136.0)


def test_texts(spark):
    df = spark.createDataFrame([("海丸（うみまる）",), ("山丸",)], "c string")
    assert [tuple(r.v) for r in df.select(text.reading_of(F.col("c")).alias("v")).collect()] == [("海丸", "うみまる"), ("山丸", None)]
    assert spark.range(1).select(text.summary(F.lit("釣れます。私がご案内します。" + "長い文。" * 40), 20).alias("v")).first().v == "釣れます。長い文。長い文。長い文。長い…"
    signal = spark.range(1).select(places.area_of_signals(F.lit(None).cast("string"), F.lit("a"), F.lit("b")).alias("v")).first().v
    assert tuple(signal) == ("a", True)
    cities = spark.createDataFrame([("千葉県いすみ市大原1",), ("神奈川県横浜市中区本町",), ("東京都江戸川区西葛西",), ("千葉県夷隅郡御宿町1",), ("大原",)], "c string")
    assert [r.v for r in cities.select(places.city_of(F.col("c")).alias("v")).collect()] == ["いすみ市", "横浜市中区", "江戸川区", "夷隅郡御宿町", None]


def test_page_rules(spark):
    c = lambda **k: [F.lit(k.get(n, d)) for n, d in (("text", ""), ("title", ""), ("href", "https://a.jp/x"), ("kind", "site"), ("body", "b" * 2000), ("evidence", 0), ("blog", False), ("dead", False))]
    cases = [({"text": "釣果"}, "text"), ({"body": ""}, "open_failed"), ({"href": "https://a.jp/choka/"}, "url"), ({"kind": "blog", "href": "https://b.jp/"}, "portal_top"), ({"evidence": 4}, "evidence"), ({}, "weak_evidence")]
    for given, want in cases:
        assert spark.range(1).select(pages.accepted(*c(**given)).alias("v")).first().v.why == want
    states = [("このドメインは", "", "suspect"), ("廃業しました", "", "closed"), ("船" + "あ" * 100, "", "ok"), ("x" * 300, "", "suspect"), ("x" * 300, "釣り船", "thin"), ("", "", "unreachable")]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(states)], "i int, t string, h string, e string")
    assert [r.s for r in df.orderBy("i").select(pages.health(F.col("t"), F.col("h"))["state"].alias("s")).collect()] == [s[2] for s in states]
    site = spark.createDataFrame([("s", 1, "x" * 20000), ("s", 2, "y" * 20000), ("s", 3, "9000円 " * 2000)], "site string, n int, text string")
    assert [(r.n, len(r.text)) for r in pages.ranked_pages(site, "site", "n", "text").orderBy("n").collect()] == [(1, 14000), (2, 6000), (3, 12000)]
