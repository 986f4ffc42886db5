"""Carries over blocks against plain passes over each group, for blocks of any size."""

import random

import pytest
from pyspark.sql import functions as F

from shoalmark.operators import scan

ROWS = 160


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [(rng.choice([None, "a", "a", "a", "b", "c"]), i, rng.choice([None, None, 1, 2, 3]), rng.choice("xyz")) for i in range(ROWS)]


def groups(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("block", [7, 60, 1000])
def test_carries(spark, rows, block):
    df = spark.createDataFrame(rows, "g string, n int, v int, s string").repartition(5)
    got = scan.carried(df, ["g"], ["n"], {"fill": scan.forward(F.col("v")), "next": scan.back(F.col("v")), "sum": scan.total(F.col("v")), "prev": scan.before(F.col("v")), "section": scan.total((F.col("s") == "x").cast("int"))}, block)
    want = set()
    for g, members in groups(rows).items():
        fill, sums, prev, section = None, 0, None, 0
        for k, (_, n, v, s) in enumerate(members):
            fill, sums, section = v if v is not None else fill, sums + (v or 0), section + (s == "x")
            following = next((m[2] for m in members[k:] if m[2] is not None), None)
            want.add((g, n, v, s, fill, following, sums, prev, section))
            prev = v
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("block", [9, 1000])
def test_runs(spark, rows, block):
    df = spark.createDataFrame(rows, "g string, n int, v int, s string")
    want = set()
    for g, members in groups(rows).items():
        run = 0
        for k, r in enumerate(members):
            run += k == 0 or members[k - 1][2] != r[2]
            want.add((*r, run))
    assert {tuple(r) for r in scan.runs(df, ["g"], ["n"], "v", "run", block).collect()} == want


MACHINE = scan.Machine(("out", "in", "deep"), "out", {("out", "x"): "in", ("in", "x"): "deep", ("deep", "y"): "in", ("in", "y"): "out"}, {"1": "deep"})


@pytest.mark.parametrize("block", [8, 50, 1000])
def test_machine(spark, rows, block):
    df = spark.createDataFrame(rows, "g string, n int, v int, s string")
    symbol = F.when(F.col("v") == 1, "1").otherwise(F.when(F.col("s") != "z", F.col("s")))
    want = set()
    for g, members in groups(rows).items():
        now = "out"
        for r in members:
            found = now
            sym = "1" if r[2] == 1 else r[3] if r[3] != "z" else None
            now = MACHINE.moves.get((now, sym), MACHINE.any.get(sym, now))
            want.add((*r, now, found))
    assert {tuple(r) for r in scan.run_machine(df, ["g"], ["n"], symbol, MACHINE, block_rows=block).collect()} == want


def test_a_crowded_group_lies_in_many_blocks(spark):
    df = spark.range(1000).select(F.lit("hot").alias("g"), "id")
    held = scan._blocks(df, ["g"], ["id"], 100)
    assert max(r["count"] for r in held.groupBy("_block").count().collect()) <= 300
    got = scan.carried(df, ["g"], ["id"], {"n": scan.total(F.lit(1))}, 100).agg(F.max("n"), F.sum("n")).first()
    assert tuple(got) == (1000, 500500)


def test_empty(spark):
    df = spark.createDataFrame([], "g string, n int")
    assert scan.carried(df, ["g"], ["n"], {"x": scan.total(F.lit(1))}).collect() == []
    assert scan.run_machine(df, ["g"], ["n"], F.lit("x"), MACHINE).collect() == []


def test_small_blocks_share_tasks(spark):
    """10,000 rows in blocks of 5: no more ranges than the session has cores, and blocks that ascend with the rows."""
    df = spark.range(10_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("n"))
    held = scan._blocks(df, ["g"], ["n"], 5)
    bounds = [tuple(r) for r in held.groupBy("_block").agg(F.min(F.struct("g", "n")).alias("a"), F.max(F.struct("g", "n")).alias("b"), F.count("*").alias("k")).orderBy("_block").select("a", "b", "k").collect()]
    assert all(k <= 5 for _, _, k in bounds) and all(x[1] < y[0] for x, y in zip(bounds, bounds[1:]))
    assert len({r._block >> 33 for r in held.select("_block").distinct().collect()}) <= spark.sparkContext.defaultParallelism
