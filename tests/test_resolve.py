"""Clusters by component and replay against one replay over all pairs, on random small graphs."""

import random

import pytest
from pyspark.sql import functions as F

from shoalmark.operators import graph, resolve
from shoalmark.plans import scaling


def test_replay_by_component_equals_global_replay(spark):
    rng = random.Random(3)
    records, edges = [], []
    for g in range(60):
        n = rng.randint(3, 9)
        base = g * 100
        for i in range(n):
            records.append((base + i, rng.choice(["a", "b", "c", "registry"]), rng.choice(["x", "y", "z"])))
        for _ in range(rng.randint(1, 14)):
            a, b = sorted(rng.sample(range(n), 2))
            edges.append((rng.randint(1, 7), base + rng.randint(0, n), base + a, base + b, rng.randint(0, 2)))
    r = spark.createDataFrame(records, "idx bigint, src string, nkey string")
    e = spark.createDataFrame(edges, "rule int, key_first bigint, a bigint, b bigint, strength int")
    got = {x.idx: x.cluster for x in resolve.cluster(r, e).collect()}
    want = resolve.replay(edges, {i: None if s == "registry" else s for i, s, _ in records}, {i: n for i, _, n in records})
    assert got == want


def as_frames(spark, records, edges):
    return spark.createDataFrame(records, "idx bigint, src string, nkey string"), spark.createDataFrame(edges, "rule int, key_first bigint, a bigint, b bigint, strength int")


def replay_all(records, edges):
    return resolve.replay(edges, {i: None if s == "registry" else s for i, s, _ in records}, {i: n for i, _, n in records})


def test_rounds_equal_replay_on_random_graphs(spark):
    """Dense and sparse graphs with refusals, names, forced edges and repeated edges; none is small enough to be replayed."""
    rng = random.Random(1)
    records, edges = [], []
    for g, (n, m) in enumerate([(25, 20), (12, 40), (2, 1)]):
        base = g * 1000
        records += [(base + i, rng.choice(["a", "b", "c", "d", "registry", None, ""]), rng.choice(["x", "y", "z"])) for i in range(n)]
        for _ in range(m):
            a, b = sorted(rng.sample(range(n), 2))
            edges.append((rng.randint(1, 4), rng.randint(0, 9), base + a, base + b, rng.choice([0, 0, 0, 1, 2])))
    edges += edges[:9]
    got = {x.idx: x.cluster for x in resolve.cluster(*as_frames(spark, records, edges), most_replayed=12).collect()}
    assert got == replay_all(records, edges)


@pytest.mark.parametrize("ascending", [False, True])
def test_a_chain_merges_without_a_task_that_holds_it(spark, ascending):
    """Ascending edges decide one pair a round, and go by prefixes of the pass."""
    n = 300
    rng = random.Random(4)
    order = list(range(n))
    if not ascending:
        rng.shuffle(order)
    records = [(i, f"s{rng.randint(0, 40)}", f"n{i % 5}") for i in range(n + 1)]
    edges = [(1, order[i], i, i + 1, rng.choice([0, 1])) for i in range(n)]
    got = {x.idx: x.cluster for x in resolve.cluster(*as_frames(spark, records, edges), most_replayed=60).collect()}
    assert got == replay_all(records, edges)


def plain_rounds(now):
    """{id: (name, city, site)} after rounds in which all records that agree, transitively, become one."""
    rounds = 0
    while True:
        by = {}
        for i, (name, city, site) in now.items():
            by.setdefault(("name", name), []).append(i)
            by.setdefault(("site", site, city), []).append(i)
        fit = lambda k, a, b: k[0] == "site" and None not in k or k[0] == "name" and (None in (now[a][1], now[b][1]) or now[a][1] == now[b][1])
        links = [(a, b) for k, ids in by.items() for a in ids for b in ids if a < b and fit(k, a, b)]
        if not links:
            return now, rounds
        rounds += 1
        root, changed = {i: i for i in now}, True
        while changed:
            changed = False
            for a, b in links:
                least = min(root[a], root[b])
                changed |= root[a] != least or root[b] != least
                root[a] = root[b] = least
        groups = {}
        for i in sorted(now):
            groups.setdefault(root[i], []).append(now[i])
        now = {r: tuple(next((m[k] for m in g if m[k] is not None), None) for k in (0, 1, 2)) for r, g in groups.items()}


def test_only_new_records_probe_again(spark):
    rng = random.Random(6)
    rows = [(i, rng.randint(0, 80), rng.choice([None, 0, 1, 2, 3]), rng.choice([None, rng.randint(0, 30)])) for i in range(110)]
    probes = []

    def pairs(first, second):
        probes.append(first.count())
        return scaling.agree(first, second)

    got = resolve.agglomerated(spark.createDataFrame(rows, "id int, name int, city int, site int"), pairs, scaling.first_known).collect()
    want, rounds = plain_rounds({r[0]: r[1:] for r in rows})
    assert {r.id: (r.name, r.city, r.site) for r in got} == want
    assert rounds > 1 and probes[0] == 110 and max(probes[1::2]) < 110


def test_contacts_settle_as_in_plain_rounds(spark, sf_dir):
    want, rounds = plain_rounds({r.id: (r.name, r.city, r.site) for r in scaling.contacts(spark, "/root/testdata/sf0.01").collect()})
    got = scaling.contacts_until_settled(spark, "/root/testdata/sf0.01").collect()
    assert {r.id: (r.name, r.city, r.site) for r in got} == want and rounds > 1


def test_refuses_two_records_of_one_source():
    source, name = {0: "a", 1: "b", 2: "a"}, {0: "x", 1: "x", 2: "y"}
    assert resolve.replay([(1, 0, 0, 1, 0), (2, 0, 1, 2, 0)], source, name) == {0: 0, 1: 0, 2: 2}
    assert resolve.replay([(1, 0, 0, 1, 0), (2, 0, 1, 2, 2)], source, name) == {0: 0, 1: 0, 2: 0}
    assert resolve.replay([(1, 0, 0, 1, 0), (2, 0, 1, 2, 1)], source, name) == {0: 0, 1: 0, 2: 2}


COLUMNS = "idx bigint, src string, src_id string, nkey string, pref string, city string, pkey string, tel string, ukey string, page string, geo string, lat double, lon double, bare boolean"


def clusters(spark, rows):
    full = [(i, r.get("src", f"s{i}"), str(i), r.get("nkey", "海丸"), r.get("pref", "12"), r.get("city", ""), r.get("pkey", ""), r.get("tel", ""), r.get("ukey", ""), r.get("page", ""), r.get("geo", "site"), r.get("lat"), r.get("lon"), False) for i, r in enumerate(rows)]
    df = spark.createDataFrame(full, COLUMNS)
    return [x.cluster for x in resolve.cluster(df, resolve.candidates(df)).orderBy("idx").collect()]


def test_named_cases(spark):
    here, far = {"lat": 35.0, "lon": 140.0}, {"lat": 39.0, "lon": 140.0}
    assert clusters(spark, [{"tel": "0312345678", **here}, {"tel": "0312345678", "nkey": "知床海丸", **here}]) == [0, 0]  # a prefix
    assert clusters(spark, [{"tel": "0312345678", **here}, {"tel": "0312345678", "pref": "5", **far}]) == [0, 1]  # one phone, far away
    assert clusters(spark, [{"tel": "0312345678", "pkey": "大原", **here}, {"tel": "09012345678", "pkey": "大原", **here}]) == [0, 0]  # two phones at one port
    assert clusters(spark, [{"tel": "0312345678", **here}, {"tel": "09012345678", "lat": 35.05, "lon": 140.0}]) == [0, 1]  # two phones, two places
    assert clusters(spark, [{"src": "registry", **here}, {"src": "registry", **here}]) == [0, 1]
    assert clusters(spark, [{"pref": "12", **here}, {"pref": "13", **here}]) == [0, 0]  # one of them has the wrong area
    assert clusters(spark, [{"nkey": "皇", **here}, {"nkey": "皇", "lat": 35.02, "lon": 140.0}]) == [0, 1]  # one sign only


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 160)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_equal_documents_behind_a_shared_beginning(spark, tmp_path):
    from shoalmark.plans import registry

    head = "the same beginning " * 8
    rows = [(1, head + "one", "s"), (2, head + "two", "s"), (3, head + "two", "s"), (4, head + "two", "t"), (5, "apart", "s")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.idx: r.cluster for r in registry.QUERIES["dedup_constrained_clusters"](spark, str(tmp_path)).collect()}
    assert len(got) == 5 and got[2] == got[3] and got[1] != got[2] and got[5] not in (got[1], got[2])
