"""Gram indexes and layouts for lookups against scans of everything."""

import random

import pytest
from pyspark.sql import functions as F

from shoalmark.operators import grams
from shoalmark.sources import publish


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdé漢😀 ") for _ in range(rng.randint(1, 9)))
    texts = [(i, rng.choice([None, "", "ab"]) if i % 9 == 0 else " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(80)]
    names = [word() for _ in range(120)] + ["a", "ab", "", None, "漢", "nowhere at all", "aaaa", "aa"]
    return texts, names


def frames(spark, corpus):
    texts, names = corpus
    return spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame([(n,) for n in names], "name string")


def test_grams(spark):
    df = spark.createDataFrame([("",), ("ab",), ("abcabc",), ("a😀漢é",), (None,)], "t string")
    assert [r.g for r in df.select(grams.grams(F.col("t")).alias("g")).collect()] == [[], [], ["abc", "bca", "cab"], ["a😀漢", "😀漢é"], None]


def test_numbers_stand_for_grams(spark, corpus):
    """Each text has the numbers of its distinct grams once, those of 8 characters by a hash; names only those of one size."""
    t, n = frames(spark, corpus)
    sizes = [1, 2, 3, 8]
    of = lambda text, ks: {grams.number_of(text[i : i + k]) for k in ks for i in range(len(text) - k + 1)}
    got = sorted(map(tuple, grams.numbered(t, sizes).collect()))
    assert got == sorted((i, g) for i, text in corpus[0] for g in of(text or "", sizes))
    named = n.where("name <> ''").distinct().select(F.col("name").alias("id"), F.col("name").alias("text"))
    want = {(x, g) for x in corpus[1] if x for g in of(x, [max(k for k in sizes if k <= len(x))])}
    assert {tuple(r) for r in grams.numbered(named, sizes, of_length=True).collect()} == want


def test_names_in_texts(spark, corpus):
    t, n = frames(spark, corpus)
    texts, names = corpus
    want = {(i, x) for i, text in texts if text is not None for x in set(names) if x and x in text}
    got = [tuple(r) for r in grams.names_in_texts(t, n, "id", "text", "name").collect()]
    assert len(got) == len(want) and set(got) == want
    assert grams.names_in_texts(t, n.limit(0), "id", "text", "name").collect() == []
    assert grams.names_in_texts(t.limit(0), n, "id", "text", "name").collect() == []


def test_longest_names_first(spark, corpus):
    t, n = frames(spark, corpus)
    texts, names = corpus
    want = {}
    for i, text in texts:
        rest, got = text or "", []
        for x in sorted({x for x in names if x}, key=lambda x: (-len(x), x.encode())):
            at = rest.find(x)
            if at >= 0:
                got.append((at, x))
                rest = rest.replace(x, "\0" * len(x))
        want[i] = [x for _, x in sorted(got, key=lambda g: (g[0], g[1].encode()))]
    assert {r.id: r.found for r in grams.longest_names(t, n, "id", "text", "name").collect()} == want


def test_names_cut_out(spark, corpus):
    t, n = frames(spark, corpus)
    texts, names = corpus
    want = {}
    for i, text in texts:
        for x in sorted({x for x in names if x and len(x) >= 3 and text and x in text}, key=lambda x: (-len(x), x.encode())):
            text = text.replace(x, "")
        want[i] = text
    assert {r.id: r.text for r in grams.without_names(t, n, "id", "text", "name").collect()} == want


@pytest.mark.parametrize("keywords", [["abc"], ["ab", "c"], ["d"], ["bad", "é漢"], ["zzzz"], ["a", "nothing"], []])
def test_keyword_search(spark, corpus, tmp_path_factory, keywords):
    t, _ = frames(spark, corpus)
    folder = str(tmp_path_factory.mktemp("index") / "i")
    index = grams.KeywordIndex(spark, folder).build(t, "id", "text", 3)
    want = {i for i, text in corpus[0] if text is not None and all(k in text for k in keywords)}
    found = index.search(t, keywords, "id", "text")
    assert found.columns == ["id", "text"] and {r.id for r in found.collect()} == (want if keywords else {i for i, _ in corpus[0]})


def scanned_files(df):
    """How many files the scans of a query have read."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves, out = plan.collectLeaves(), []
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        if metric.isDefined():
            out.append(metric.get().value())
    return out


def test_lookups_read_the_files_of_their_ranges(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(1, 5001).select(F.col("id"), (F.col("id") * 2).alias("v"))
    publish.write_by_ranges(rows, root, "id", 100)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = publish.looked_up_ids(spark, root, "id", 100, [7, 8, 4999, 9000])
        assert scanned_files(found) == [2] and {tuple(r) for r in found.collect()} == {(7, 14), (8, 16), (4999, 9998)}
        wanted = spark.createDataFrame([(3,), (3,), (250,), (None,), (77777,)], "id bigint")
        looked = publish.looked_up(wanted, root, "id", 100)
        assert "dynamicpruning" in looked._jdf.queryExecution().executedPlan().toString()
        assert max(scanned_files(looked)) == 2
        assert {tuple(r) for r in looked.collect()} == {(3, 6), (250, 500)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
