"""Sharding by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own, from an offset by a step that its name gives.
Shards take turns, each claiming the first slot of its order that is free; all get as many slots but for one.  A row's key
hashes to a slot, whose shard is looked up in the broadcast table.  When a shard comes or goes, few other slots move.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, unused

#: A prime; its slots are all that is ever broadcast.
SLOTS = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """First slot and step of a shard's order."""
    a, b = (int.from_bytes(blake2b(name.encode(), digest_size=8, person=p).digest(), "big") for p in (b"offset", b"step"))
    return a % slots, b % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS, weights: Mapping[str, int] | None = None) -> np.ndarray:
    """The shard number of each slot.  weights: turns that a shard takes in each round, 1 where not given."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be a prime, not under the number of shards")
    out = np.full(slots, -1, np.int32)
    order = [preference(s, slots) for s in shards]
    turns = [i for i, s in enumerate(shards) for _ in range(max(0, (weights or {}).get(s, 1)))]
    if not turns:
        raise ValueError("all weights are 0")
    asked, filled = [0] * len(shards), 0
    while True:
        for i in turns:
            first, step = order[i]
            at = (first + asked[i] * step) % slots
            while out[at] >= 0:
                asked[i] += 1
                at = (first + asked[i] * step) % slots
            out[at] = i
            asked[i] += 1
            filled += 1
            if filled == slots:
                return out


def placed(rows: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS, weights: Mapping[str, int] | None = None, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """rows with the columns slot_col and shard_col; no shuffle, the table of `slots` rows is broadcast.

    Rows of equal keys go to one shard; rows with a null key are dealt by a hash of all their columns, so that many of
    them don't meet in one shard.  Repeated rows go together; an empty table gives an empty one.  Columns of rows that
    have the name of slot_col or shard_col are replaced, but for the key: where it has such a name, the result gets an
    underscore behind.
    """
    slot_col, shard_col = unused([key], slot_col, shard_col)
    spark = rows.sparkSession
    filled = lookup_table(shards, slots, weights)
    rows = rows.drop(slot_col, shard_col)
    slot, shard = unused([*rows.columns, slot_col, shard_col], "slot", "shard")
    entries = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(filled.tolist())], f"{slot} int, {shard} string")
    hashed = F.xxhash64(F.col(key).cast("string"))
    plain = [c for c, t in rows.dtypes if not t.startswith("map") and c != key]
    if plain:
        hashed = F.when(F.col(key).isNull(), F.xxhash64(*plain)).otherwise(hashed)
    rows = rows.withColumn(slot_col, F.pmod(hashed, F.lit(slots)).cast("int"))
    return rows.join(F.broadcast(entries), F.col(slot_col) == F.col(slot)).drop(slot).withColumnRenamed(shard, shard_col)


def write_shards(rows: DataFrame, path: str, parts: int = 4, **how) -> None:
    """Writes the rows as Parquet, a folder for each shard, each from `parts` tasks at most."""
    out = placed(rows, **how)
    shard = how.get("shard_col", "shard")
    salt = F.pmod(F.xxhash64(*[c for c, t in out.dtypes if not t.startswith("map")]), F.lit(parts))
    out.repartition(F.col(shard), salt).write.partitionBy(shard).parquet(path)


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    return placed(table(spark, sf_dir, "documents")).select("doc_id", "slot", "shard")


def sql() -> str:
    """The placement in DuckDB SQL, the filled table given as text (two digits a slot); filling it takes turns, which SQL
    can't tell, and is tested against a plain version."""
    from .simhash_sql import xxh64

    digits = "".join(f"{i:02d}" for i in lookup_table(SHARDS).tolist())
    return f"""WITH sh AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents),
{xxh64("sh")},
signed AS (SELECT doc_id, h::HUGEINT - CASE WHEN h >= {1 << 63}::UBIGINT THEN {1 << 64}::HUGEINT ELSE 0::HUGEINT END AS h FROM hashed),
placed AS (SELECT doc_id, CAST((h % {SLOTS} + {SLOTS}) % {SLOTS} AS INTEGER) AS slot FROM signed)
SELECT doc_id, slot, 'shard-' || lpad(substr('{digits}', 2 * slot + 1, 2), 3, '0') AS shard FROM placed"""
