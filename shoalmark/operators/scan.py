"""Carries along ordered rows of groups that may hold any share of a table: fills, running sums, runs and line machines.

A window over a group puts the group in one task.  Here rows are sorted into blocks by ranges of the group and the order, so a
crowded group lies in many blocks.  A first pass works within a block and sums up what each group of it hands on; the
sums of the few groups that reach over a block's end (two of a block at most: its first and its last) are carried from block
to block, and a second pass adds what a row's block was handed.  Carries are at most two rows for each block, whatever the table
holds, and are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import written

#: Rows of a block.
BLOCK_ROWS = 200_000


@dataclass(frozen=True)
class Carry:
    """A column to add: kind is one of the functions below."""

    kind: str
    value: Column


def forward(value: Column) -> Carry:
    """The value of the last row up to this one where it isn't null."""
    return Carry("forward", value)


def back(value: Column) -> Carry:
    """The value of the first row from this one on where it isn't null."""
    return Carry("back", value)


def total(value: Column) -> Carry:
    """The sum of the rows up to this one (bigint); null counts as 0."""
    return Carry("total", F.coalesce(value.cast("long"), F.lit(0).cast("long")))


def before(value: Column) -> Carry:
    """The value of the row before; null for the first."""
    return Carry("before", value)


def _blocks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], block_rows: int) -> DataFrame:
    """rows with _block, the number of their range of (keys, order), as a table, so that the ranges stay as they are.

    A task sorts a range of BLOCK_ROWS or so and cuts it into blocks of block_rows: small blocks make no more tasks, nor
    more bounds for the driver to sample.
    """
    kept = written(rows)
    count = kept.count()
    tasks = min(-(-count // block_rows), max(kept.sparkSession.sparkContext.defaultParallelism, -(-count // BLOCK_ROWS)))
    ranges = kept.repartitionByRange(max(1, tasks), *keys, *order).sortWithinPartitions(*keys, *order)
    # The upper bits of the id are the range, the lower ones the row's place in it.
    at = F.monotonically_increasing_id()
    place = at.bitwiseAND(F.lit((1 << 33) - 1))
    return written(ranges.withColumn("_block", at - place + F.floor(place / block_rows)))


def _on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    out = a["_block"] == b["_block"]
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


def carried(rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Mapping[str, Carry], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """rows with the columns of each carry, within groups of equal keys (null is a key), in ascending order (null first).

    The order has no ties within a group.
    """
    values = {f"_v{i}": c for i, c in enumerate(columns.values())}
    held = _blocks(rows.withColumns({v: c.value for v, c in values.items()}), keys, order, block_rows)
    w = Window.partitionBy("_block", *keys).orderBy(*order)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    # From the end: Spark goes through all rows to come again for each row of a frame that ends there.
    down = Window.partitionBy("_block", *keys).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct(*order)
    local, sums = {}, []
    for v, c in values.items():
        if c.kind == "forward":
            local[v + "l"], handed = F.last(v, ignorenulls=True).over(up), F.max_by(v, F.when(F.col(v).isNotNull(), place))
        elif c.kind == "back":
            local[v + "l"], handed = F.last(v, ignorenulls=True).over(down), F.min_by(v, F.when(F.col(v).isNotNull(), place))
        elif c.kind == "total":
            local[v + "l"], handed = F.sum(v).over(up), F.sum(v)
        else:
            # A struct tells a null value from no row before.
            local[v + "l"], handed = F.lag(F.struct(F.col(v).alias("v"))).over(w), F.max_by(F.struct(F.col(v).alias("v")), place)
        sums.append(handed.alias(v + "h"))
    blocks = held.groupBy("_block", *keys).agg(*sums)
    along = Window.partitionBy(*keys).orderBy("_block")  # one row a block
    past, ahead = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    given = {}
    for v, c in values.items():
        h = v + "h"
        given[v + "c"] = F.last(h, ignorenulls=True).over(past) if c.kind == "forward" else F.first(h, ignorenulls=True).over(ahead) if c.kind == "back" else F.sum(h).over(past) if c.kind == "total" else F.lag(h).over(along)
    handed_on = blocks.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_n > 1").withColumns(given).select("_block", *keys, *given)
    handed_on = F.broadcast(written(handed_on))  # two rows a block at most
    inside = held.withColumns(local)
    out = inside.join(handed_on, _on(inside, handed_on, keys), "left").select(*[inside[c] for c in inside.columns], *[handed_on[c] for c in given])
    result = {}
    for (name, c), v in zip(columns.items(), values):
        own, more = F.col(v + "l"), F.col(v + "c")
        result[name] = own + F.coalesce(more, F.lit(0)) if c.kind == "total" else F.coalesce(own, more)["v"] if c.kind == "before" else F.coalesce(own, more)
    return out.withColumns(result).drop("_block", *values, *local, *given)


def runs(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """rows with the number of the run of neighbouring equal values that each lies in, from 1."""
    first = carried(rows, keys, order, {"_before": before(F.struct(F.col(value).alias("v")))}, block_rows)
    begins = F.col("_before").isNull() | ~F.col("_before.v").eqNullSafe(F.col(value))
    return carried(first.withColumn("_begins", begins.cast("int")).drop("_before"), keys, order, {name: total(F.col("_begins"))}, block_rows).drop("_begins")


@dataclass(frozen=True)
class Machine:
    """States and symbols as a table: moves[(state, symbol)] is the state after a row of that symbol.

    Where a pair is missing, any[symbol] is the state after it in every state, and where that is missing, too, the state stays.
    """

    states: tuple[str, ...]
    start: str
    moves: Mapping[tuple[str, str], str] = field(default_factory=dict)
    any: Mapping[str, str] = field(default_factory=dict)

    def after(self, symbol: str | None) -> list[int]:
        """The state after a row of the symbol, for each state before it."""
        return [self.states.index(self.moves.get((s, symbol), self.any.get(symbol, s))) for s in self.states]


def composed(steps: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each row of functions (row x state) that of all rows from the last new one up to it, by doubling."""
    out, n = steps.copy(), len(steps)
    group = np.cumsum(new)
    reach = 1
    while reach < n:
        same = np.flatnonzero(group[reach:] == group[:-reach]) + reach
        if not len(same):
            break
        earlier = out[same - reach]
        out[same] = np.take_along_axis(out[same], earlier, axis=1)
        reach *= 2
    return out


def run_machine(rows: DataFrame, keys: Sequence[str], order: Sequence[str], symbol: Column, machine: Machine, name: str = "state", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """rows with `name`, the machine's state after each row, and `name`_before, the state that it found.

    symbol: the symbol of a row; the machine begins in its start in each group.  Functions from state to state are
    composed within a block for all states that a row may find, by doubling in numpy; what a group's part of a block does to
    each state is handed on to the next block.
    """
    states = list(machine.states)
    known = sorted({s for _, s in machine.moves} | set(machine.any))
    table = np.array([machine.after(s) for s in known] + [list(range(len(states)))], dtype=np.int64)
    codes = F.create_map(*[x for i, s in enumerate(known) for x in (F.lit(s), F.lit(i))]) if known else None
    code = F.coalesce(F.try_element_at(codes, symbol), F.lit(len(known))) if known else F.lit(0)
    held = _blocks(rows.withColumn("_code", code.cast("int")), keys, order, block_rows)
    kinds = dict(held.dtypes)
    wanted = [*keys, *order]
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in ("_block", *dict.fromkeys(wanted))] + ["_after array<int>", "_found array<int>"])

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Parts of one group in one block may come in several frames; the last function goes from one to the next.
        last_key, last = None, None
        for f in frames:
            if not len(f):
                continue
            columns = [f[c] for c in ("_block", *keys)]
            new = np.ones(len(f), bool)
            for i, c in enumerate(columns):
                changed = ((c != c.shift()) & ~(c.isna() & c.shift().isna())).to_numpy(dtype=bool)
                new = changed if not i else new | changed
            new[0] = True
            out = composed(table[f["_code"].to_numpy()], new)
            key = [None if pd.isna(c.iloc[0]) else c.iloc[0] for c in columns]
            goes_on = last is not None and key == last_key
            if goes_on:
                first = np.cumsum(new) == 1
                out[first] = out[first][:, last]
            found = np.vstack([last if goes_on else np.arange(len(states)), out[:-1]])
            found[new & (np.arange(len(f)) > 0)] = np.arange(len(states))
            last_key, last = [None if pd.isna(c.iloc[-1]) else c.iloc[-1] for c in columns], out[-1]
            yield f[["_block", *dict.fromkeys(wanted)]].assign(_after=list(out.astype(np.int32)), _found=list(found.astype(np.int32)))

    sorted_rows = held.select("_block", *dict.fromkeys(wanted), "_code").repartition("_block").sortWithinPartitions("_block", *keys, *order)
    steps = written(sorted_rows.mapInPandas(walk, schema))
    ends = steps.groupBy("_block", *keys).agg(F.max_by("_after", F.struct(*order)).alias("_step"))
    ends = ends.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_n > 1").drop("_n")
    start = states.index(machine.start)

    def along(group: pd.DataFrame) -> pd.DataFrame:
        group, now, found = group.sort_values("_block"), start, []
        for step in group["_step"]:
            found.append(now)
            now = int(step[now])
        return group.drop(columns="_step").assign(_entry=found)

    # One row a block for each group that reaches over a block's end.
    key_schema = ", ".join(f"`{c}` {kinds[c]}" for c in ("_block", *keys))
    entries = F.broadcast(written(ends.groupBy(*keys).applyInPandas(along, f"{key_schema}, _entry int")))
    told = steps.join(entries, _on(steps, entries, keys), "left").select(*[steps[c] for c in steps.columns], F.coalesce(entries["_entry"], F.lit(start)).alias("_entry"))
    names = F.array(*map(F.lit, states))
    states_of = told.select(*dict.fromkeys(wanted), F.get(names, F.get("_after", F.col("_entry"))).alias(name), F.get(names, F.get("_found", F.col("_entry"))).alias(f"{name}_before"))
    at = held.drop("_block", "_code")
    condition = F.lit(True)
    for c in dict.fromkeys(wanted):
        condition = condition & at[c].eqNullSafe(states_of[c])
    return at.join(states_of, condition).select(*[at[c] for c in at.columns], states_of[name], states_of[f"{name}_before"])
