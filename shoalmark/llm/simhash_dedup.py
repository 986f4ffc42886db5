"""SimHash near-duplicates: 64-bit fingerprints, candidates from a byte-position inverted index with count filtering, components.

Two fingerprints within `most_bits` differing bits differ in at most as many of their eight bytes, so at least
8 - most_bits positional bytes agree: the guaranteed minimum.  Lists of one positional byte hold a 256th of all
fingerprints each, so that tallying over them takes n squared / 64 additions; the lists here are those of two
positional bytes (of three, then four, where the fingerprints are so many that lists of two would be long).  The position
sets are a covering design: any positions, when they are as many as the minimum, contain one of the sets, so every pair that
reaches the minimum meets in a list.  A pair that meets tallies the positional bytes it shares over all eight positions;
pairs under the minimum go (most do: two agreeing bytes bring a pair together, the minimum is four), the others are
verified by their differing bits.

A list of n fingerprints has n squared / 2 pairs.  Lists over `dense` fingerprints don't pair: each fingerprint there goes to
the keys that it has with up to half of the bits flipped, a fixed number, and whoever share a key are linked to one of
them.  Two share one exactly if they are within the bits, so the components are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from .common import named, raw, shared_dir, slices, spans, table, trimmed, unused, written

#: Each byte value with its eight bits spread over the bytes of a 64-bit number.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
_LANES = 255
#: Distinct fingerprints up to which lists have two positional bytes (some hundred fingerprints each), and three; beyond, four.
TWO_BYTES, THREE_BYTES = 1 << 23, 1 << 30
#: Fingerprints beyond which a list is dense: about twice the keys of each fingerprint of such a list.
DENSE = 2500


def _bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in each group of hashes; groups begin at `first` and aren't empty."""
    size = np.diff(np.append(first, len(hashes)))
    parts = -(-size // _LANES)
    part_of = np.repeat(np.arange(len(first)), parts)
    nth = np.arange(len(part_of)) - np.repeat(np.cumsum(parts) - parts, parts)
    at = first[part_of] + nth * _LANES
    octets = hashes.view(np.uint8).reshape(-1, 8)
    lanes = np.stack([np.add.reduceat(_SPREAD[octets[:, k]], at) for k in range(8)], axis=1)
    counts = lanes.view(np.uint8).reshape(-1, 64).astype(np.int64)
    return np.add.reduceat(counts, np.cumsum(parts) - parts, axis=0)


def fingerprints(column: pa.Array, words: int = 4, seed: int = 42) -> np.ndarray:
    """The unsigned fingerprint of each text: null and texts without a word have zero."""
    data, offsets = raw(column)
    text = data.tobytes()
    joined = [b" ".join(text[a:b].lower().split()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    out = np.zeros(len(joined), np.uint64)
    at = np.zeros(len(joined) + 1, np.int64)
    np.cumsum([len(x) for x in joined], out=at[1:])
    joined = b"".join(joined)
    joined_data = np.frombuffer(joined, np.uint8)
    first, last, text_of = spans(joined_data, at, joined_data == 32)
    if not len(first):
        return out
    n_words = np.bincount(text_of, minlength=len(out))
    begin = np.cumsum(n_words) - n_words
    starts = np.arange(len(first)) - begin[text_of] <= np.maximum(n_words[text_of] - words, 0)
    head = np.flatnonzero(starts)
    tail = np.minimum(head + words - 1, begin[text_of[head]] + n_words[text_of[head]] - 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(first[head].tolist(), last[tail].tolist())), np.uint64, len(head))
    some = np.flatnonzero(n_words)
    size = np.bincount(text_of[head], minlength=len(out))[some]
    bits = _bit_counts(hashes, np.cumsum(size) - size) * 2 > size[:, None]
    out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """Per row of docs: its id as `id` and the fingerprint's 64 bits as a signed long `fp`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = fingerprints(part.column(1), words, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(trimmed(run), f"id {dict(rows.dtypes)['id']}, fp bigint")


@cache
def position_sets(least: int, size: int) -> tuple[tuple[int, ...], ...]:
    """Sets of `size` of the eight byte positions of which at least one lies in any `least` positions (greedy cover)."""
    left, out = set(combinations(range(8), least)), []
    while left:
        best = max(combinations(range(8), size), key=lambda s: sum(set(s) <= set(x) for x in left))
        out.append(best)
        left = {x for x in left if not set(best) <= set(x)}
    return tuple(sorted(out))


def _octet(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255).cast("long"))


def _lists(prints: DataFrame, sets: tuple[tuple[int, ...], ...]) -> DataFrame:
    """(list, bytes, fp): each fingerprint in the list of each position set, by its bytes there."""

    def key(positions: tuple[int, ...]) -> Column:
        out = F.lit(0).cast("long")
        for i, k in enumerate(positions):
            out = out.bitwiseOR(F.shiftleft(_octet(F.col("fp"), k), 8 * i))
        return out

    # Each fingerprint becomes a row for each list: dealt out again first, as what is small before that isn't after it.
    prints = prints.select("fp").repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    at = F.explode(F.array(*[F.struct(F.lit(i).cast("smallint").alias("list"), key(s).alias("bytes")) for i, s in enumerate(sets)])).alias("at")
    return prints.select("fp", at).select("at.list", "at.bytes", "fp")


def meetings(lists: DataFrame, sets: tuple[tuple[int, ...], ...]) -> DataFrame:
    """(a, b, tally, bits) of the pairs a < b that meet in a list, each once, in the first list that it shares.

    tally: positional bytes that the pair shares; bits: those in which it differs.
    """
    # For each mask of agreeing positions the first list in which such a pair meets, so that it counts there alone.
    meets = [next((i for i, s in enumerate(sets) if all(mask >> k & 1 for k in s)), -1) for mask in range(256)]
    a, b = lists.select("list", "bytes", F.col("fp").alias("a")), lists.select("list", "bytes", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    agree = [(_octet(differ, k) == 0).cast("int") for k in range(8)]
    tally, mask = agree[0], agree[0]
    for k in range(1, 8):
        tally, mask = tally + agree[k], mask + F.shiftleft(agree[k], k)
    first = F.element_at(F.array(*[F.lit(m).cast("smallint") for m in meets]), mask + 1)
    met = (F.col("l.list") == F.col("r.list")) & (F.col("l.bytes") == F.col("r.bytes")) & (F.col("a") < F.col("b")) & (first == F.col("l.list"))
    return a.alias("l").join(b.alias("r"), met).select("a", "b", tally.alias("tally"), F.bit_count(differ).alias("bits"))


def _through_keys(thick: DataFrame, sets: tuple[tuple[int, ...], ...], most_bits: int) -> DataFrame:
    """Links (a, b) that connect, within each list, the fingerprints that pairs within most_bits connect; no pairs are made.

    Two within the bits have a key between them that one reaches by flipping half of the bits and the other by the rest,
    none of them in the list's own bytes.  A key has as many members at most as it has keys itself.
    """
    half = -(-most_bits // 2)
    masks = []
    for i, s in enumerate(sets):
        free = [b for b in range(64) if b // 8 not in s]
        for n in range(half + 1):
            for flipped in combinations(free, n):
                mask = sum(1 << b for b in flipped)
                masks.append((i, mask - (1 << 64) if mask >> 63 else mask, n))
    flips = thick.sparkSession.createDataFrame(masks, "list smallint, mask bigint, n int")  # as many rows as the sets and bits give
    keys = thick.join(F.broadcast(flips), "list").select("list", "bytes", F.col("fp").bitwiseXOR(F.col("mask")).alias("key"), "n", "fp")
    met = keys.groupBy("list", "bytes", "key").agg(F.min(F.struct("n", "fp")).alias("centre"), F.collect_list("fp").alias("members"))
    # With an odd number of bits the centre has to be the nearer half away.
    met = met.where((F.size("members") > 1) & (F.col("centre.n") <= most_bits - half))
    return met.select(F.explode("members").alias("a"), F.col("centre.fp").alias("b")).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(prints: DataFrame, most_bits: int = 4, list_bytes: int | None = None, dense: int = DENSE) -> DataFrame:
    """Pairs a < b of the distinct fingerprints in prints.fp with at most `most_bits` differing bits.

    Each such pair is there once, but for those of dense lists, of which enough are there (perhaps twice) to connect the
    same fingerprints.  list_bytes: positional bytes by which a list is keyed, at most 8 - most_bits; the default follows
    the number of fingerprints, and any gives the same pairs.
    """
    least = 8 - most_bits
    if least < 1:
        raise ValueError("the byte-position index needs at most 7 differing bits")
    shared_dir(prints.sparkSession)
    if list_bytes is None:
        n = prints.count()
        list_bytes = 2 if n <= TWO_BYTES else 3 if n <= THREE_BYTES else 4
    sets = position_sets(least, min(list_bytes, least))
    lists = _lists(prints, sets)
    thick = lists.groupBy("list", "bytes").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense).select("list", "bytes").checkpoint()
    crowded = not thick.isEmpty()
    met = meetings(lists.join(thick, ["list", "bytes"], "left_anti") if crowded else lists, sets)
    found = met.where((F.col("tally") >= least) & (F.col("bits") <= most_bits)).select("a", "b")
    return found.unionByName(_through_keys(lists.join(thick, ["list", "bytes"], "left_semi"), sets, most_bits)) if crowded else found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42, most_bits: int = 4, list_bytes: int | None = None) -> DataFrame:
    """(id_col, fp, component_id) for each row of docs: the smallest id that its fingerprint reaches over links.

    Equal fingerprints are one node, so copies never make pairs.  Null and wordless texts have fingerprint zero and are
    linked like others; rows with a null id belong to components but name none (component_id is null where no row of the
    component has an id); repeated rows stay repeated; an empty table gives an empty one; other columns are not read.  An
    id_col that is called fp or component_id keeps its name, and that result gets an underscore behind.  A text is held
    whole, with about three times its bytes beside it: what a worker's memory holds bounds its length.
    """
    rows = written(with_fingerprints(docs, id_col, text_col, words, seed))
    prints = written(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(prints, most_bits, list_bytes))
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = rooted.checkpoint()
    best = rooted.groupBy("root").agg(F.min("least").alias("component_id")).checkpoint()
    of = rooted.join(best, "root").select("fp", "component_id")
    return named(rows.join(of, "fp", "left").select("id", "fp", "component_id"), id=id_col)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without the rows whose id isn't the smallest of their component; all columns stay.

    Where several rows have that id, one stays: the first by a hash of its whole content.  Rows with a null id go where
    their component has an id; else those of different content stay.
    """
    head, content, first = unused(docs.columns, "head", "content", "first")
    of = written(near_duplicates(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", **how))
    heads = of.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy(F.col("id").alias(head)).agg(F.count("*").alias("n"))
    kept = docs.join(heads.select(head), F.col(id_col).eqNullSafe(F.col(head)), "left_semi")
    if heads.where("n > 1").isEmpty():
        return kept
    kept = kept.withColumn(content, F.xxhash64(*[F.col(c).cast("string") if t.startswith("map") else F.col(c) for c, t in docs.dtypes]))
    firsts = kept.groupBy(F.col(id_col).alias(head)).agg(F.min(content).alias(first))
    one = F.col(id_col).eqNullSafe(F.col(head)) & (F.col(id_col).isNull() | (F.col(content) == F.col(first)))
    return kept.join(firsts, one, "left_semi").dropDuplicates([id_col, content]).drop(content)


def op3_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
