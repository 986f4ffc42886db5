"""Greedy covers of points: taken in order, a point is a centre unless a centre before it is near.

The pass is sequential, but a point may be decided as soon as no earlier undecided point is near.  Points lie in cells so
small that any two of one cell are near each other, so a cell has one centre at most, and its earliest undecided point
speaks for it: it is a centre when no cell within reach has an earlier one.  Each round decides the centres of all places
at once and drops the points near them.  Neither the rounds nor the last step, in which points go to the earliest centre
near them, compare the points of a crowded cell with each other: a point meets one centre of each cell within reach.

Rounds follow the longest chain of near points in ascending order, which is short unless the order follows the ground.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.places import EARTH_KM, dist_km
from .graph import written


@dataclass(frozen=True)
class Near:
    """When two points are near, the sides of cells all of whose points are, and how many cells away a near point can lie."""

    test: Callable[[Column, Column, Column, Column], Column]
    sides: tuple[float, float]
    reach: tuple[int, int]


def within_km(km: float, latitude: float = 60.0) -> Near:
    """Less than so many km apart, up to a latitude (either sign)."""
    degree = math.radians(1) * EARTH_KM
    side = km / degree / math.sqrt(2) * 0.999
    return Near(lambda y1, x1, y2, x2: dist_km(y1, x1, y2, x2) < km, (side, side), (math.ceil(km / degree / side), math.ceil(km / degree / math.cos(math.radians(latitude)) / side)))


def within_box(degrees: float) -> Near:
    """Less than so many degrees apart either way."""
    return Near(lambda y1, x1, y2, x2: (F.abs(y1 - y2) < degrees) & (F.abs(x1 - x2) < degrees), (degrees * 0.999, degrees * 0.999), (2, 2))


def within_radius(radius: float) -> Near:
    """At most so far apart on a plane."""
    side = radius / math.sqrt(2) * 0.999
    return Near(lambda y1, x1, y2, x2: (y1 - y2) * (y1 - y2) + (x1 - x2) * (x1 - x2) <= radius * radius, (side, side), (2, 2))


def _around(near: Near, *fields: str) -> list:
    """Columns of a row for each cell within reach of its own."""
    cells = F.array(*[F.struct((F.col("cy") + y).alias("cy"), (F.col("cx") + x).alias("cx")) for y in range(-near.reach[0], near.reach[0] + 1) for x in range(-near.reach[1], near.reach[1] + 1)])
    return [*fields, F.explode(cells).alias("_at")]


def covered(points: DataFrame, near: Near, keys: Sequence[str] = (), most_rounds: int = 1000) -> DataFrame:
    """(id, centre) of points (id, rank, y, x and the keys within which they are compared): the id of the point's centre.

    Points are taken by rank, then id; ids are unique, and neither rank nor position is null.  A centre is its own.
    """
    kinds = dict(points.dtypes)
    keys = list(keys)
    cell = lambda c, i: F.floor(F.col(c) / near.sides[i]).alias(f"c{c}")
    placed = written(points.select(F.struct("rank", "id").alias("o"), "y", "x", *keys, cell("y", 0), cell("x", 1)))
    at = [*keys, "cy", "cx"]
    left, centres = placed, None
    for _ in range(most_rounds):
        firsts = left.groupBy(*at).agg(F.min(F.struct("o", "y", "x")).alias("f")).select(*at, "f.*")
        seen = firsts.select(*_around(near, *keys, "o")).select(*keys, "_at.cy", "_at.cx", "o").groupBy(*at).agg(F.min("o").alias("least"))
        new = written(firsts.join(seen, at).where("o = least").drop("least"))
        if new.isEmpty():
            break
        near_new = new.select(*_around(near, *keys, F.col("y").alias("y2"), F.col("x").alias("x2"))).select(*keys, "_at.cy", "_at.cx", "y2", "x2")
        gone = left.join(near_new, at).where(near.test(F.col("y2"), F.col("x2"), F.col("y"), F.col("x"))).select("o").unionByName(new.select("o")).distinct()
        left = written(left.join(gone, "o", "left_anti"))
        centres = new if centres is None else centres.unionByName(new)
    else:
        raise RuntimeError(f"points did not settle in {most_rounds} rounds")
    if centres is None:
        return points.select("id", F.col("id").alias("centre"))
    offered = centres.select(*_around(near, *keys, F.col("o").alias("centre"), F.col("y").alias("y2"), F.col("x").alias("x2"))).select(*keys, "_at.cy", "_at.cx", "centre", "y2", "x2")
    met = placed.join(offered, at).where((F.col("centre") == F.col("o")) | near.test(F.col("y2"), F.col("x2"), F.col("y"), F.col("x")))
    # A centre has no earlier centre near; what is near it comes later.
    return met.groupBy("o").agg(F.min("centre").alias("centre")).select(F.col("o.id").cast(kinds["id"]).alias("id"), F.col("centre.id").cast(kinds["id"]).alias("centre"))


#: Pixels of the world's side at zoom 0, and the largest latitude of the map's projection.
WORLD_PIXELS, MOST_LATITUDE = 512.0, 85.0511287798066


def projected(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(y, x) of a position on the web map, 0 to 1 from the north-west corner."""
    s = F.sin(F.radians(F.greatest(F.lit(-MOST_LATITUDE), F.least(F.lit(MOST_LATITUDE), lat))))
    return 0.5 - 0.25 * F.ln((1 + s) / (1 - s)) / math.pi, lon / 360.0 + 0.5


def zoom_clusters(points: DataFrame, radius: float = 44.0, most_zoom: int = 11, least_zoom: int = 0) -> DataFrame:
    """(zoom, cluster, parent, n, y, x) of the clusters of points (id, y, x) at each zoom, and of the points at most_zoom + 1.

    From the finest zoom to the coarsest, the clusters of the zoom before are taken in an order that the ground doesn't
    follow, by MD5 of their ids; each that no earlier one has taken becomes a cluster and takes those within so many pixels
    of it.  A cluster has the id of its first, the number of its points and their mean position; parent: its cluster at
    the next coarser zoom.
    """
    now = written(points.select("id", "y", "x", F.lit(1).cast("long").alias("n")))
    out = None
    for zoom in range(most_zoom, least_zoom - 1, -1):
        near = within_radius(radius / (WORLD_PIXELS * 2**zoom))
        of = written(covered(now.select("id", F.md5(F.col("id").cast("string")).alias("rank"), "y", "x"), near))
        tied = now.join(of, "id")
        level = tied.select(F.lit(zoom + 1).alias("zoom"), F.col("id").alias("cluster"), F.col("centre").alias("parent"), "n", "y", "x")
        out = level if out is None else out.unionByName(level)
        weighted = lambda c: (F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c)
        now = written(tied.groupBy("centre").agg(weighted("y"), weighted("x"), F.sum("n").alias("n")).withColumnRenamed("centre", "id"))
    last = now.select(F.lit(least_zoom).alias("zoom"), F.col("id").alias("cluster"), F.lit(None).cast(dict(now.dtypes)["id"]).alias("parent"), "n", "y", "x")
    return last if out is None else out.unionByName(last)
