"""Constrained merging in rounds: the clusters of a sequential pass over ordered edges, without a task for a component.

An edge merges two clusters unless both hold a record of one source; a forced edge merges all the same, and so does a
strong one if the clusters share a name.  The pass takes the edges in their order, so its result depends on it.  An edge that is
the earliest pending one of both of its clusters can be decided at once: no earlier edge touches these clusters any more, so
they hold what they hold when the pass comes to it.  In each round every cluster names its earliest edge, edges named
by both sides merge or are refused, and the rest are carried over to the new clusters.  Weak edges between clusters that share a
source already go early, as sources never leave a cluster.

Edges in ascending order along a chain would let one pair merge a round.  Where a round decides few edges, the earliest
`prefix` edges of all are replayed in one task of bounded size, which is the same pass over its beginning.

Sources and names of clusters are rows, not sets in a row, so a cluster may grow without bound.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import written

WEAK, STRONG, FORCED = 0, 1, 2
ORDER = ("rule", "key_first", "a", "b", "strength")


def replayed(edges: Iterable[tuple], sources: dict[int, set], names: dict[int, set]) -> dict[int, int]:
    """The cluster (its smallest part) of each part after a sequential pass; edges: (order, a, b, strength), in any order."""
    parent = {i: i for i in sources}
    sources, names = {i: set(s) for i, s in sources.items()}, {i: set(n) for i, n in names.items()}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for _, a, b, strength in sorted(edges):
        x, y = root(a), root(b)
        if x == y:
            continue
        if sources[x] & sources[y] and not (strength == FORCED or strength == STRONG and names[x] & names[y]):
            continue
        parent[y] = x
        sources[x] |= sources[y]
        names[x] |= names[y]
    least: dict[int, int] = {}
    for i in sorted(parent):
        least.setdefault(root(i), i)
    return {i: least[root(i)] for i in parent}


def _moved(rows: DataFrame, moves: DataFrame, column: str = "c") -> DataFrame:
    """rows with the clusters of a column as the moves (old, new) have them."""
    to = moves.select(F.col("old").alias(column), F.col("new").alias("_new"))
    return rows.join(to, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def merged_in_rounds(nodes: DataFrame, edges: DataFrame, prefix: int = 10_000, most_rounds: int = 10_000) -> DataFrame:
    """(node, cluster) of nodes (node, src, nkey) after the sequential pass over edges (rule, key_first, a, b, strength).

    src null: no source that could repeat.  The tables are written each round.
    """
    moved: list[DataFrame] = []
    sources = written(nodes.where("src IS NOT NULL").select(F.col("node").alias("c"), F.col("src").alias("v")))
    names = written(nodes.select(F.col("node").alias("c"), F.col("nkey").alias("v")).where("v IS NOT NULL"))
    pending = written(edges.select(F.struct(*ORDER).alias("o"), F.col("a").alias("x"), F.col("b").alias("y"), "strength").distinct().where("x <> y"))
    left = pending.count()
    for _ in range(most_rounds):
        if not left:
            return _moved(nodes.select("node", F.col("node").alias("cluster")), _composed(moved), "cluster") if moved else nodes.select("node", F.col("node").alias("cluster"))
        earliest = pending.select(F.col("x").alias("c"), "o").unionByName(pending.select(F.col("y").alias("c"), "o")).groupBy("c").agg(F.min("o").alias("o"))
        # Named by both sides: the order names its edge, so an edge that two clusters name stands twice.
        mutual = earliest.groupBy("o").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("o")
        chosen = written(pending.join(mutual, "o"))
        ends = chosen.select("o", "x", "y")
        both = lambda of: ends.join(of.select(F.col("c").alias("x"), "v"), "x").join(of.select(F.col("c").alias("y"), "v"), ["y", "v"]).select("o").distinct()
        clash, alike = both(sources).withColumn("clash", F.lit(True)), both(names).withColumn("alike", F.lit(True))
        told = chosen.join(clash, "o", "left").join(alike, "o", "left")
        agreed = told.where(F.col("clash").isNull() | (F.col("strength") == FORCED) | ((F.col("strength") == STRONG) & F.col("alike").isNotNull()))
        moves = written(agreed.select(F.greatest("x", "y").alias("old"), F.least("x", "y").alias("new")))
        rest = pending.join(chosen.select("o"), "o", "left_anti")
        moved.append(moves)
        sources, names, pending, now = _carried(sources, names, rest, moves)
        if left - now < left // 16 and now:
            first = written(pending.orderBy("o").limit(prefix))
            moves = written(_prefix_moves(first, sources, names))
            moved.append(moves)
            sources, names, pending, now = _carried(sources, names, pending.join(first.select("o"), "o", "left_anti"), moves)
        left = now
    raise RuntimeError(f"clusters did not settle in {most_rounds} rounds")


def _composed(moved: list[DataFrame]) -> DataFrame:
    """(old, new) of all rounds' moves, each cluster to the one that it ends in: from the last round back, so that a round's
    moves meet those that come later only.  A cluster moves once."""
    out = moved[-1]
    for moves in reversed(moved[:-1]):
        out = written(_moved(moves, out, "new").unionByName(out))
    return out


def _carried(sources: DataFrame, names: DataFrame, pending: DataFrame, moves: DataFrame) -> tuple:
    """The tables after the moves, and how many edges are pending: those inside a cluster go, as do weak ones that clash.

    Of sources and names only those of clusters with a pending edge are kept: no one asks for the others any more.
    """
    pending = written(_moved(_moved(pending, moves, "x"), moves, "y").where("x <> y").select("o", "x", "y", "strength"))
    ends = lambda of: of.select(F.explode(F.array("x", "y")).alias("c")).distinct()
    live = ends(pending)
    sources, names = (written(_moved(t, moves).join(live, "c", "left_semi").distinct()) for t in (sources, names))
    weak = pending.where(F.col("strength") == WEAK)
    clash = weak.join(sources.select(F.col("c").alias("x"), "v"), "x").join(sources.select(F.col("c").alias("y"), "v"), ["y", "v"]).select("o").distinct()
    pending = written(pending.join(clash, "o", "left_anti"))
    return sources, names, pending, pending.count()


def _prefix_moves(first: DataFrame, sources: DataFrame, names: DataFrame) -> DataFrame:
    """The moves of a pass over a bounded number of edges, the earliest of all."""
    at = first.select(F.explode(F.array("x", "y")).alias("c")).distinct()
    empty = lambda *cs: [F.lit(None).cast(t).alias(c) for c, t in cs]
    edge = first.select(F.lit("edge").alias("kind"), *[F.col(f"o.{c}").cast("bigint").alias(c) for c in ORDER[:4]], "x", "y", F.col("strength").cast("bigint").alias("strength"), *empty(("v", "string")))
    of = lambda t, kind: t.join(at, "c", "left_semi").select(F.lit(kind).alias("kind"), *empty(*((c, "bigint") for c in ORDER[:4])), F.col("c").alias("x"), *empty(("y", "bigint"), ("strength", "bigint")), "v")
    rows = edge.unionByName(of(sources, "source")).unionByName(of(names, "name"))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        e = group[group["kind"] == "edge"]
        parts = {int(i) for i in pd.concat([e["x"], e["y"]])}
        has = {"source": {i: set() for i in parts}, "name": {i: set() for i in parts}}
        for kind, x, v in group.loc[group["kind"] != "edge", ["kind", "x", "v"]].itertuples(index=False):
            has[kind][int(x)].add(v)
        order = zip(*(e[c].astype("int64") for c in (*ORDER[:4], "strength")))
        found = replayed([(o, int(x), int(y), o[4]) for o, x, y in zip(order, e["x"], e["y"])], has["source"], has["name"])
        return pd.DataFrame([(i, c) for i, c in found.items() if i != c], columns=["old", "new"], dtype="int64")

    return rows.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(solve, "old bigint, new bigint")
