"""What larger or odd tables showed, as small ones: queries against their SQL over written-out tables, and steps against all pairs."""

import duckdb
from pyspark.sql import functions as F

from shoalmark.plans import registry


def plain(v):
    return repr(v) if isinstance(v, float) else v


def same_as_sql(spark, folder, name, **tables):
    """The rows of a query over tables ((rows, schema) each), which have to be those of its SQL."""
    con = duckdb.connect()
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df = registry.QUERIES[name](spark, str(folder))
    columns = sorted(df.columns)
    got = sorted(([plain(v) for v in r] for r in df.select(*columns).collect()), key=str)
    want = con.sql(registry.ORACLE_SQL[name]).select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert got == sorted(([plain(v) for v in r] for r in want), key=str)
    return got


def test_references_without_semicolon_stay(spark, tmp_path):
    pages = [(1, "<html><head><title>x</title></head><body><h1>tion&amp;&amp</h1><p>a &lt; b &am</p><p>c&amp;amp; d &lt</p></body></html>"), (2, "<p>plain</p>")]
    got = same_as_sql(spark, tmp_path, "html_to_text", pages=(pages, "page_id bigint, html string"))
    assert got[0] == [1, "tion&&amp\na < b &am\nc&amp; d &lt"]


def test_words_end_at_letters_beyond_ascii(spark, tmp_path):
    """"ñble" holds "ble" as a word of its own where words are of ASCII letters, as in SQL."""
    long = "the shop " * 60
    docs = [(1, "the ñble " * 12), (2, "the table " * 12), (3, long), (4, "the bleé " * 12), (5, long), (6, None)]
    pages = [(1, "<title>x</title>"), (3, "<title>eñble</title>"), (5, "<title>able</title>")]
    got = same_as_sql(spark, tmp_path, "site_health_classify", documents=(docs, "doc_id bigint, text string"), pages=(pages, "page_id bigint, html string"))
    assert dict(got) == {1: "thin", 2: "ok", 3: "thin", 4: "thin", 5: "ok", 6: "unreachable"}


def test_agreeing_records_make_stars(spark):
    """300 records of one name have eight edges each at most, not a pair with each other, and are connected by them."""
    from shoalmark.operators.graph import components
    from shoalmark.plans import scaling

    rows = spark.createDataFrame([(i, 1, None if i == 7 else i % 3, i % 2) for i in range(300)], "id bigint, name bigint, city bigint, site bigint")
    edges = scaling.agree(rows, rows).where("a <> b").distinct()
    assert edges.count() <= 8 * 300
    assert {r.root for r in components(edges).collect()} == {0}


def test_positions_stand_for_their_rows(spark):
    """Flags and the nearest of rows that share positions, against all pairs."""
    from shoalmark.operators import spatial

    rows = [(i, i % 3 if i % 5 else None, 30.0 + (i % 4) * 0.3, 130.0 + (i % 2) * 0.3) for i in range(40)] + [(90, 1, None, None), (91, 1, 20.0, 110.0)]
    p = spark.createDataFrame(rows, "id bigint, area int, la double, lo double")
    a, b = p.toDF("id", "area", "la1", "lo1"), p.toDF("other_id", "other_area", "la2", "lo2")
    from shoalmark.functions.places import dist_km

    pairs = a.join(b, F.col("id") != F.col("other_id")).where(dist_km(F.col("la1"), F.col("lo1"), F.col("la2"), F.col("lo2")) <= 60)
    want = pairs.groupBy("id").agg(F.bool_or(F.col("area") == F.col("other_area")).alias("same"), F.bool_or(F.col("area") != F.col("other_area")).alias("other"), F.count("*").alias("n"))
    assert sorted(map(tuple, spatial.areas_within_km(p, 60).collect())) == sorted(map(tuple, want.collect()))
    left, right = p.select(F.col("id").alias("lid"), "la", "lo"), p.where("id % 7 < 3").select(F.col("id").alias("rid"), "la", "lo")
    want = spatial.nearest(spatial.within_km(left, right, 60))
    assert sorted(map(tuple, spatial.nearest_within_km(left, right, 60).collect())) == sorted(map(tuple, want.collect()))


RECORD = "idx bigint, src string, src_id string, nkey string, pref string, city string, pkey string, tel string, ukey string, page string, geo string, lat double, lon double, bare boolean"


def test_linking_pairs_give_the_clusters_of_all_pairs(spark):
    """Crowded and small blocks with copies, refusals and unknown fields: fewer pairs, all of them proposed, and the clusters of a
    pass over all pairs."""
    import random

    from shoalmark.operators import resolve

    rng, pick, rows = random.Random(11), lambda *xs: rng.choice(xs), []
    for i in range(260):
        rows.append((i * 3 % 260, pick("a", "b", "registry", "reserver", None), str(i), pick("海丸", "大海丸", "皇", "北丸", f"n{i % 9}"), pick("1", "2", "", None), pick("", "x"), pick("", "p"), pick("", "", f"03{i % 7}"), pick("", "", f"s{i % 8}"), pick("", "", f"g{i % 8}"), pick("site", "town", "port", None), pick(None, 35.0, 35.01, 35.02, 39.0), 140.0, pick(True, False)))
    r = spark.createDataFrame(rows, RECORD)
    every, some = resolve.candidates(r), resolve.linking(r).distinct()
    assert not some.exceptAll(every.distinct()).count() and some.count() < every.count()
    e = [tuple(x) for x in every.select("rule", "key_first", "a", "b", "strength").collect()]
    want = resolve.replay(e, {x[0]: None if x[1] == "registry" else x[1] for x in rows}, {x[0]: x[3] for x in rows})
    assert {x.idx: x.cluster for x in resolve.cluster(r, some).collect()} == want


def test_a_crowded_name_is_linked_by_few_pairs(spark):
    from shoalmark.operators import resolve

    rows = [(i, f"s{i % 3}", str(i), "海丸", str(i % 4), "", "p", "", "", "", "port", 35.0, 140.0, False) for i in range(400)]
    edges = resolve.linking(spark.createDataFrame(rows, RECORD))
    assert edges.count() <= 4 * len(rows)
    assert {x.cluster for x in resolve.cluster(spark.createDataFrame(rows, RECORD), edges).collect()} == {0}


def test_repeated_lines_are_read_once(spark):
    """Lines of many documents are read as one row each; the kind that a document gives them still decides."""
    from shoalmark.operators import extract

    texts = ["◆渡船", "大人 1,000円", "◆仕立船", None, "大人 1,000円", "1隻 50,000円", "竿レンタル 2,000円"]
    lines = spark.createDataFrame([(d, n, t) for d in range(40) for n, t in enumerate(texts)] + [(99, 0, "大人 1,000円"), (99, 1, "1名 9,000円")], "doc int, ln int, line string")
    assert extract._read_once(lines, "line").count() == len({t for t in texts if t} | {"1名 9,000円"})
    got = {(r.doc, r.ln, r.kind, r.price, r.unit) for r in extract.offers(lines, "doc", "ln", "line").collect()}
    want = {(d, *x) for d in range(40) for x in [(1, "渡船", 1000, ""), (5, "仕立", 50000, "boat")]} | {(99, 1, None, 9000, "person")}
    assert got == want


def test_settled_clusters_leave_the_rounds(spark):
    """Sources and names of clusters without a pending edge aren't carried on, and moves of later rounds reach earlier ones."""
    from shoalmark.operators import constrained as k

    rows = spark.createDataFrame([(i, f"s{i}") for i in range(6)], "c bigint, v string")
    edges = spark.createDataFrame([((1, 0, 0, 2, 1), 0, 2, 1)], "o struct<rule: int, key_first: bigint, a: bigint, b: bigint, strength: int>, x bigint, y bigint, strength int")
    first = spark.createDataFrame([(1, 0), (3, 2), (5, 4)], "old bigint, new bigint")
    sources, _, _, left = k._carried(rows, rows, edges, first)
    assert left == 1 and {tuple(r) for r in sources.collect()} == {(0, "s0"), (0, "s1"), (2, "s2"), (2, "s3")}
    later = spark.createDataFrame([(2, 0)], "old bigint, new bigint")
    assert {tuple(r) for r in k._composed([first, later]).select("old", "new").collect()} == {(1, 0), (2, 0), (3, 0), (5, 4)}


def test_no_pair_of_candidates_is_shuffled(spark, monkeypatch):
    """Classes of several rows and blocks of several tasks give each pair once, and no join stands below an exchange."""
    from shoalmark.operators import resolve

    rows = [(i, f"s{i % 3}", str(i), "海丸", "1", "", "p", "03" if i % 2 else "", "", "", "port", 35.0, 140.0, False) for i in range(120)]
    r = spark.createDataFrame(rows, RECORD)
    monkeypatch.setattr(resolve, "TOGETHER", 9, raising=False)
    monkeypatch.setattr(resolve, "SHARE", 25, raising=False)
    found = resolve.candidates(r)
    pairs = [(x.a, x.b) for x in found.where("rule = 5").collect()]
    assert sorted(pairs) == [(a, b) for a in range(120) for b in range(a + 1, 120)]
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for i, line in enumerate(lines):
        if "Exchange" in line:
            below = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            assert not any("Join" in x for x in lines[i + 1 : below]), line
