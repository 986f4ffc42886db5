"""Repair of the structure of conversations: the cheapest edits after which their roles follow a grammar.

Roles have to be an optional system turn and then pairs of user and assistant, `(s?(ua)+)?` by initials.  A turn can be
kept, given the role user or assistant, or deleted, and an empty turn can be inserted; the grammar has four states (nothing
yet, after the system's, the user's, the assistant's turn).  Conversations are partitioned by the hash of their id, and in
each partition batches of whole conversations are repaired by one recursive query of DuckDB: a recursion advances all of
them by one turn and keeps, for each state, the least cost and of that the least audit.  Audits of equal cost never begin
with each other (an insertion costs more than nothing), so the least audit of a state stays least whatever follows.

A conversation of over `PIECE` turns is cut into pieces that advance together, each from all four states; a second recursion
joins the pieces, so the recursions of a batch are bounded however long its conversations are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import named, small_batches, table, trimmed

#: Turns of a conversation that one recursion after another advances.
PIECE = 1000
#: Turns, and bytes of text, of the whole conversations of a batch.
TURNS, BYTES = 20_000, 4 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
#: States that each initial leads to, from the states given.
STEPS = {"s": ((START,), SYSTEM), "u": ((START, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5


def _insertions(state: int) -> list[tuple[int, int, str]]:
    """(state, cost, letters) that up to two insertions lead to; more lead nowhere else."""
    out = [(state, 0, "")]
    for _ in range(2):
        now, cost, letters = out[-1]
        out.append((ASSISTANT if now == USER else USER, cost + COSTS["I"], letters + "I"))
    return out


def _moves() -> list[tuple[int, str, int, int, str]]:
    """(state, kind of turn, state after it, cost, letters): insertions before a turn, and what becomes of the turn.

    A kind is the initial of the role (x: another) and the fault: d has to be deleted, t is truncated, - has none.
    """
    out = []
    for state in range(4):
        for at, cost, letters in _insertions(state):
            for initial in "suax":
                for fault in "dt-":
                    out.append((state, initial + fault, at, cost + COSTS["D"], letters + "D"))
                    if fault == "d":
                        continue
                    more = TRUNCATED if fault == "t" else 0
                    if initial in STEPS and at in STEPS[initial][0]:
                        out.append((state, initial + fault, STEPS[initial][1], cost + more + COSTS["K"], letters + "K"))
                    for role in "ua":
                        if at in STEPS[role][0]:
                            out.append((state, initial + fault, STEPS[role][1], cost + more + COSTS["R"], letters + "R"))
    return out


def _ends() -> list[tuple[int, int, str]]:
    """(state, cost, letters): insertions after the last turn that end in nothing or after the assistant's turn."""
    return [(state, cost, letters) for state in range(4) for at, cost, letters in _insertions(state) if at in (START, ASSISTANT)]


def _values(rows: list[tuple]) -> str:
    return ", ".join(str(r) for r in rows)


#: Faults of turns (conv, pos, role, text), and what they count up to in each conversation.
FAULTS = r"""
CREATE OR REPLACE TEMP TABLE faults AS
SELECT conv, pos, turn, left(role, 1) AS initial,
  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
       WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 'd'
       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '-' END AS fault
FROM turns
"""
COUNTS = """
SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank,
  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
FROM (SELECT *, lag(initial) OVER (PARTITION BY conv ORDER BY pos) || initial AS pair FROM faults) GROUP BY conv
"""
#: The cheapest edits of each conversation; {piece} turns of a conversation make a piece.
REPAIR = f"""
WITH RECURSIVE kinds AS MATERIALIZED (
  SELECT conv, pos // $piece AS piece, pos % $piece + 1 AS step,
    CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END || CASE WHEN fault IN ('b', 'd') THEN 'd' ELSE fault END AS kind FROM faults
), moves AS MATERIALIZED (
  SELECT * FROM (VALUES {_values(_moves())}) m(state, kind, after, cost, letters)
), sizes AS MATERIALIZED (SELECT conv, piece, max(step) AS n FROM kinds GROUP BY ALL),
walk AS (
  SELECT conv, piece, n, first, 0::BIGINT AS step, first AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS best
  FROM sizes, (VALUES (0), (1), (2), (3)) f(first) WHERE piece > 0 OR first = 0
  UNION ALL
  SELECT w.conv, w.piece, w.n, w.first, w.step + 1, m.after, min({{'cost': w.best.cost + m.cost, 'audit': w.best.audit || m.letters}})
  FROM walk w JOIN kinds k ON k.conv = w.conv AND k.piece = w.piece AND k.step = w.step + 1 JOIN moves m ON m.state = w.state AND m.kind = k.kind
  GROUP BY w.conv, w.piece, w.n, w.first, w.step, m.after
), pieces AS MATERIALIZED (SELECT conv, piece, first, state, best FROM walk WHERE step = n),
joined AS (
  SELECT conv, piece, state, best FROM pieces WHERE piece = 0
  UNION ALL
  SELECT j.conv, p.piece, p.state, min({{'cost': j.best.cost + p.best.cost, 'audit': j.best.audit || p.best.audit}})
  FROM joined j JOIN pieces p ON p.conv = j.conv AND p.piece = j.piece + 1 AND p.first = j.state
  GROUP BY j.conv, p.piece, p.state
)
SELECT conv, best.cost AS cost, best.audit AS audit FROM (
  SELECT conv, min({{'cost': best.cost + e.cost, 'audit': best.audit || e.letters}}) AS best
  FROM joined j JOIN (SELECT conv, max(piece) AS piece FROM sizes GROUP BY conv) USING (conv, piece)
    JOIN (VALUES {_values(_ends())}) e(state, cost, letters) ON e.state = j.state GROUP BY conv
)
"""


def edited(audit: str, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """The roles and texts of a conversation after the edits of an audit; what a turn's role becomes follows from its place."""
    now, i, out_roles, out_texts = "", 0, [], []
    for letter in audit:
        role, text = (roles[i], texts[i]) if letter != "I" else ("", "")
        i += letter != "I"
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if now == "u" else "user"
        now = role[:1]
        out_roles.append(role)
        out_texts.append(text)
    return out_roles, out_texts


def repair_batch(con, conv: np.ndarray, turn: pa.Array, role: pa.Array, text: pa.Array, n: int, piece: int = PIECE) -> dict[str, list]:
    """The results of `repaired` for the n conversations whose turns stand in a row, conv ascending from 0."""
    pos = np.arange(len(conv)) - np.searchsorted(conv, conv)
    con.register("turns", pa.table({"conv": conv, "pos": pos, "turn": turn, "role": role, "text": text}))
    con.execute(FAULTS)
    counts = {r[0]: r[1:] for r in con.execute(COUNTS).fetchall()}
    edits = {r[0]: r[1:] for r in con.execute(REPAIR, {"piece": piece}).fetchall()}
    con.unregister("turns")
    ends = np.searchsorted(conv, np.arange(n + 1)).tolist()
    roles, texts, turns = role.to_pylist(), text.to_pylist(), []
    for c in range(n):
        a, b = ends[c], ends[c + 1]
        new_roles, new_texts = edited(edits.get(c, (0, ""))[1], roles[a:b], texts[a:b])
        turns.append([{"role": r, "text": t} for r, t in zip(new_roles, new_texts)])
    names = ["gaps", "blank", "duplicate", "truncated", "illegal"]
    out = {name: [counts.get(c, (0,) * 5)[i] for c in range(n)] for i, name in enumerate(names)}
    return out | {"cost": [edits.get(c, (0, ""))[0] for c in range(n)], "audit": [edits.get(c, (0, ""))[1] for c in range(n)], "turns": turns}


#: A result's columns behind the conversation's id.
RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, turns array<struct<role: string, text: string>>"


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None) -> DataFrame:
    """(conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, turns) for each conversation of rows.

    Turns are taken in order, null first; of one turn's rows by role, then text, so repeated rows stand side by side.  A
    null role or text is one space.  A null conversation is one of its own.  present: where false, the row only says that its
    conversation exists; one without turns has zeros, an empty audit and no turns.  An empty table gives an empty one, other
    columns are not read, and an id called like a result keeps its name (the result gets an underscore behind).
    gaps: numbers missing between the least and the largest turn; blank, duplicate, truncated: turns by their first fault;
    illegal: neighbours whose initials are not su, ua or au; cost and audit: of the cheapest edits (K keep, R give another
    role, D delete, I insert), the least audit among them; turns: the repaired conversation.

    One exchange by the conversation's hash.  A worker holds a batch of whole conversations or one that is longer: its
    repaired turns are one row of the result.
    """
    small_batches(rows.sparkSession)
    thin = rows.select(
        F.col(conv_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"), (F.lit(True) if present is None else present).alias("present")
    )
    schema = f"id {dict(thin.dtypes)['id']}, {RESULT}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        held: list[pa.RecordBatch] = []

        def results(t: pa.Table) -> pa.RecordBatch:
            ids = t.column("id").combine_chunks()
            new = _starts(ids)
            conv, keep = np.cumsum(new) - 1, t.column("present").to_numpy()
            t = t.filter(pa.array(keep))
            out = repair_batch(con, conv[keep], *(t.column(c).combine_chunks() for c in ("turn", "role", "text")), n=int(new.sum()))
            arrays = [pa.array(out[f], pa.string() if f == "audit" else TURNS_TYPE if f == "turns" else pa.int64()) for f in out]
            return pa.RecordBatch.from_arrays([ids.filter(pa.array(new)), *arrays], ["id", *out])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < TURNS and sum(b.nbytes for b in held) < BYTES:
                continue
            t = pa.Table.from_batches(held)
            last = int(np.flatnonzero(_starts(t.column("id").combine_chunks()))[-1])
            if last:  # the last conversation may go on
                yield results(t.slice(0, last))
                held = t.slice(last).to_batches()
        if sum(b.num_rows for b in held):
            yield results(pa.Table.from_batches(held))
        con.close()

    ordered = thin.repartition("id").sortWithinPartitions("id", F.col("turn").asc_nulls_first(), "role", "text")
    return named(ordered.mapInArrow(trimmed(run), schema), id=conv_col)


TURNS_TYPE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _starts(ids: pa.Array) -> np.ndarray:
    """Whether another conversation begins at each place; null is an id of its own."""
    codes = np.asarray(ids.dictionary_encode("encode").indices)
    return np.append(True, codes[1:] != codes[:-1]) if len(codes) else np.zeros(0, bool)


def damaged(rows: DataFrame) -> DataFrame:
    """rows with the damage of crc32(`conv_id:turn`) modulo 20, and the column present: false for a dropped row."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    new_text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    new_role = F.when(kind == 4, "user").otherwise(role)
    copies = F.explode(F.array_repeat(kind != 0, F.when(kind == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", new_role.alias("role"), new_text.alias("text"), copies.alias("present"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repaired(damaged(table(spark, sf_dir, "conversations")), present=F.col("present"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.encode(lines, "utf-8"), 256).alias("repaired_sha256"))
