"""Quartile bucket digests: counts of hashed byte triplets, each bucket coded by its quartile, and the length.

Digests are compared by a bounded difference score: the mean difference of the codes, over what unrelated codes differ
by, and the difference of the lengths as logarithms; likeness is one less the score, from 0 to 1, and 1 for equal digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, slices, table, trimmed, written

BUCKETS = 1024
#: Rows and bytes of text whose digests are computed together.
MOST_ROWS, MOST_BYTES = 1000, 2 << 20
#: Mean difference of two independent codes that take four values alike often.
UNRELATED = 1.25
LENGTH_SHARE = 0.25
_LENGTH_STEP = 8


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The code (0 to 3) of each bucket and the length code of each text."""
    n = len(texts)
    size = np.array([len(x) for x in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    counts = np.zeros((n, BUCKETS), np.int32)
    if len(data) > 2:
        mixed = ((data[:-2] * np.uint32(0x9E3779B1) + data[1:-1]) * np.uint32(0x85EBCA77) + data[2:]) * np.uint32(0xC2B2AE3D)
        row = np.repeat(np.arange(n), size)
        same = row[:-2] == row[2:]
        key = row[:-2][same] * BUCKETS + (mixed[same] >> np.uint32(22)).astype(np.int64)
        counts = np.bincount(key, minlength=n * BUCKETS).astype(np.int32).reshape(n, BUCKETS)
    at = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
    bounds = np.partition(counts, at, axis=1)[:, at]
    code = np.zeros((n, BUCKETS), np.int8)
    for k in range(3):
        code += counts > bounds[:, k : k + 1]
    return code, np.minimum(255, np.round(_LENGTH_STEP * np.log2(1.0 + size))).astype(np.uint8)


def packed(code: np.ndarray, length: np.ndarray) -> list[bytes]:
    """The digests: a byte for the length and two bits for each bucket."""
    four = code.astype(np.uint8).reshape(len(code), -1, 4)
    octets = four[:, :, 0] | four[:, :, 1] << 2 | four[:, :, 2] << 4 | four[:, :, 3] << 6
    whole = np.concatenate([length[:, None], octets], axis=1)
    return [x.tobytes() for x in whole]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of the digests of a and b, row by row."""
    apart = np.abs(a[0] - b[0]).sum(axis=1) / (BUCKETS * UNRELATED)
    longer = np.minimum(1.0, np.abs(a[1].astype(float) - b[1]) / _LENGTH_STEP)
    return np.maximum(0.0, 1.0 - (1 - LENGTH_SHARE) * np.minimum(1.0, apart) - LENGTH_SHARE * longer)


def edited_text(text: str, following: str) -> str:
    """text with its last third replaced by as many characters of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_FIELDS = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("print", pa.binary()), ("edited_print", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_DDL = "n_chars bigint, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double"


def _rows(texts: list[str]) -> list[pa.Array]:
    """The fields of all texts but the last one, which only follows."""
    own = codes([x.encode() for x in texts])
    new = [edited_text(a, b).encode() for a, b in zip(texts, texts[1:])]
    edited = codes(new)
    head, tail = (own[0][:-1], own[1][:-1]), (own[0][1:], own[1][1:])
    values = [[len(x) for x in texts[:-1]], [sha256(x).hexdigest() for x in new], packed(*head), packed(*edited), likeness(head, edited), likeness(head, tail)]
    return [pa.array(v, t) for v, (_, t) in zip(values, _FIELDS)]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of consecutive rows, few enough to compute together."""
    ids, texts, size = [], [], 0
    coder = zstandard.ZstdDecompressor()
    for batch in batches:
        for i, packed_text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            texts.append(coder.decompress(packed_text).decode())
            size += len(texts[-1])
            if len(ids) >= MOST_ROWS or size >= MOST_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, edited_sha256, print, edited_print, near_edited, near_next) for each row of docs.

    The next row is the one with the next smaller id, after the last the first; rows of one id follow each other by a
    hash of their text, rows without an id come last, and a single row follows itself.  Null texts count as empty; an
    empty text has no triplets: all codes are 0.  An empty table gives an empty one; other columns are not read.

    The rows are sorted into ranges of ids (the one shuffle of the texts); each task pairs its rows and hands on its
    first and last one, which are paired across the ranges afterwards.  A text is held whole beside the one that follows it, with
    four bytes for each of its own.  An id_col called like a result keeps its name, and the result gets an underscore behind.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    order = [F.col("id").desc_nulls_last(), F.col("tie")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for batch in batches:
            for part in slices(batch):
                texts = [coder.compress((x or "").encode()) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary())], ["id", "tie", "packed"])

    # The texts are packed before the shuffle: it moves and keeps about half of what block compression would.
    packed_rows = rows.select("id", F.xxhash64("text").alias("tie"), "text").mapInArrow(trimmed(pack), f"id {kind}, tie bigint, packed binary")
    placed = packed_rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, id_type = TaskContext.get().partitionId(), None, None

        def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        def out(ids: list, fields: list[pa.Array] | None, edge: str | None, text: str | None) -> pa.RecordBatch:
            n = len(ids)
            fields = fields or [pa.nulls(n, t) for _, t in _FIELDS]
            edges = [pa.array([edge] * n, pa.string()), pa.array([part] * n, pa.int32()), pa.array([text] * n, pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *fields, *edges], ["id", *(x for x, _ in _FIELDS), "edge", "part", "text"])

        for ids, texts in _grouped(typed(batches)):
            if before is None:
                yield out(ids[:1], None, "first", texts[0])
            else:
                ids, texts = [before[0], *ids], [before[1], *texts]
            if len(ids) > 1:
                yield out(ids[:-1], _rows(texts), None, None)
            before = ids[-1], texts[-1]
        if before is not None:
            yield out([before[0]], None, "last", before[1])

    found = written(placed.mapInArrow(trimmed(run), f"id {kind}, {_DDL}, edge string, part int, text string"))
    inner = found.where("edge IS NULL").select("id", *(x for x, _ in _FIELDS))
    # One number for each task that had rows.
    parts = sorted(r.part for r in found.where("edge = 'first'").select("part").collect())
    if not parts:
        return named(inner, id=id_col)
    following = docs.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], parts[0]])), "part int, then int")
    last = found.where("edge = 'last'").select("part", "id", F.col("text").alias("text"))
    first = found.where("edge = 'first'").select(F.col("part").alias("then"), F.col("text").alias("following"))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                fields = _rows([one.column(1)[0].as_py(), one.column(2)[0].as_py()])
                yield pa.RecordBatch.from_arrays([one.column(0), *fields], ["id", *(x for x, _ in _FIELDS)])

    edges = last.join(following, "part").join(first, "then").select("id", "text", "following").mapInArrow(trimmed(across), f"id {kind}, {_DDL}")
    return named(inner.unionByName(edges), id=id_col)


def op8_quartile_digest(spark, sf_dir: str) -> DataFrame:
    out = digests(table(spark, sf_dir, "documents"))
    text = lambda c: F.lower(F.hex(c))
    return out.select("doc_id", "n_chars", "edited_sha256", text("print").alias("fingerprint"), text("edited_print").alias("edited_fingerprint"), "near_edited", "near_next")


#: The same in DuckDB SQL.
SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id, coalesce(lead(t) OVER w, first_value(t) OVER w) AS following FROM d WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, n, next_id, t, left(t, n - n // 3) || left(following, n // 3) AS edited FROM o),
x AS (SELECT doc_id, 0 AS kind, t AS s FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
h AS (SELECT doc_id, kind, regexp_extract_all(hex(encode(s)), '..') AS octets FROM x),
b AS (SELECT doc_id, kind, unnest(generate_series(1, len(octets))) AS i, CAST('0x' || unnest(octets) AS UBIGINT) AS b FROM h),
t AS (SELECT doc_id, kind, b AS b0, lead(b, 1) OVER p AS b1, lead(b, 2) OVER p AS b2 FROM b WINDOW p AS (PARTITION BY doc_id, kind ORDER BY i)),
k AS (SELECT doc_id, kind, CAST((((b0 * 2654435761 + b1) % 4294967296 * 2246822519 + b2) % 4294967296 * 3266489917) % 4294967296 >> 22 AS INTEGER) AS bucket FROM t WHERE b2 IS NOT NULL),
c AS (SELECT doc_id, kind, bucket, count(*) AS n FROM k GROUP BY ALL),
g AS (SELECT doc_id, kind, bucket, coalesce(c.n, 0) AS n FROM (SELECT doc_id, kind, unnest(generate_series(0, 1023)) AS bucket FROM h) LEFT JOIN c USING (doc_id, kind, bucket)),
q AS (SELECT doc_id, kind, list_sort(list(n)) AS v FROM g GROUP BY ALL),
code AS (SELECT doc_id, kind, bucket, CAST(n > v[256] AS INTEGER) + CAST(n > v[512] AS INTEGER) + CAST(n > v[768] AS INTEGER) AS code FROM g JOIN q USING (doc_id, kind)),
packed AS (SELECT doc_id, kind, bucket // 4 AS place, format('{:02x}', CAST(sum(code << (2 * (bucket % 4))) AS BIGINT)) AS octet FROM code GROUP BY ALL),
text AS (SELECT doc_id, kind, string_agg(octet, '' ORDER BY place) AS body FROM packed GROUP BY ALL),
lists AS (SELECT doc_id, kind, list(code ORDER BY bucket) AS codes FROM code GROUP BY ALL),
f AS (SELECT doc_id, kind, CAST(least(255, round(8 * log2(1.0 + len(octets)))) AS BIGINT) AS size, body, codes FROM h JOIN text USING (doc_id, kind) JOIN lists USING (doc_id, kind))
SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, format('{:02x}', a.size) || a.body AS fingerprint, format('{:02x}', z.size) || z.body AS edited_fingerprint,
  greatest(0.0::DOUBLE, 1.0::DOUBLE - 0.75::DOUBLE * least(1.0::DOUBLE, list_sum(list_transform(list_zip(a.codes, z.codes), lambda y: abs(y[1] - y[2])))::DOUBLE / 1280.0::DOUBLE) - 0.25::DOUBLE * least(1.0::DOUBLE, abs(a.size - z.size)::DOUBLE / 8.0::DOUBLE)) AS near_edited,
  greatest(0.0::DOUBLE, 1.0::DOUBLE - 0.75::DOUBLE * least(1.0::DOUBLE, list_sum(list_transform(list_zip(a.codes, m.codes), lambda y: abs(y[1] - y[2])))::DOUBLE / 1280.0::DOUBLE) - 0.25::DOUBLE * least(1.0::DOUBLE, abs(a.size - m.size)::DOUBLE / 8.0::DOUBLE)) AS near_next
FROM e JOIN f a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN f z ON z.doc_id = e.doc_id AND z.kind = 1 JOIN f m ON m.doc_id = e.next_id AND m.kind = 0"""
