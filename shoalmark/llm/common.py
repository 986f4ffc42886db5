"""What the operators of this subpackage share: reading tables, the shared folder, and words of Arrow batches as numpy arrays."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import checkpoint_dir

#: ASCII white space: the complement of the word pattern [^\x20\x09-\x0D]+.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True

#: Bytes of text that a Python worker holds as arrays at once.
SLICE_BYTES = 1 << 20


#: Bytes of an Arrow batch between the JVM and Python; Spark's default of 64 MB is held twice or thrice on both sides.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Sets the size of Arrow batches where the session has the default: texts are long, and several tasks share a machine."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("b") == str(64 << 20):
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Where a session has none, one on a cluster is an
    error, and one in a single process (a local master, as in tests) gets a new folder."""
    return checkpoint_dir(spark)


def written(df: DataFrame) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder, read again: it cuts the lineage and survives lost executors.

    The table goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/shoalmark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores behind as make it differ from all columns (letter case aside)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(out: DataFrame, **given: str) -> DataFrame:
    """out with its columns renamed as given; another column that would bear one of those names gets an underscore behind."""
    others = [c for c in out.columns if c not in given]
    new = dict(zip(others, unused(list(given.values()), *others)))
    return out.toDF(*[given.get(c) or new[c] for c in out.columns])


def crc_mod(column: str, n: int):
    """crc32 of the column as text, modulo n: the folds of held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, id_col: str = "doc_id") -> DataFrame:
    """docs with the columns label and weight of about `rows` rows of each label of labels (id_col, label), by a hash of the id.

    weight: the rows of its label that a row stands for, so that weighted labels have the shares of all labelled rows at
    every size.  Only ids and labels are sampled, and the sample, whose size `rows` bounds, is broadcast: no text is shuffled.
    """
    known = labels.where(F.col("label").isNotNull() & F.col(id_col).isNotNull()).select(id_col, "label")
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = F.lit(None).cast("double")
    for label, n in sizes.items():
        weight = F.when(F.col("label") == label, max(1.0, n / rows)).otherwise(weight)
    part = F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(1_000_000))
    taken = F.lit(False)
    for label, n in sizes.items():
        taken = taken | ((F.col("label") == label) & (part < min(1_000_000, -(-1_000_000 * rows // n))))
    return docs.join(F.broadcast(known.where(taken).withColumn("weight", weight)), id_col)


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `most` bytes of text; a longer text is a part of its own, whole."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    ends, first = np.cumsum(sizes), 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the n + 1 offsets of the texts in them; null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and text number of each longest run of bytes without the mark `outside`; runs end with their text."""
    inside = np.append(~outside, False)
    starts, ends = inside.copy(), np.zeros(len(inside) + 0, bool)
    starts[1:] &= ~inside[:-1]
    ends[1:] = inside[:-1] & ~inside[1:]
    edges = offsets[1:-1]
    both = edges[(edges > 0) & (edges < len(data))]
    both = both[inside[both] & inside[both - 1]]
    starts[both] = ends[both] = True
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    return first, last, np.searchsorted(offsets, first, "right") - 1


def numbered(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each span, equal for equal bytes, and the distinct byte strings by number."""
    size = last - first
    offsets = np.zeros(len(first) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    keep = np.repeat(first - offsets[:-1], size) + np.arange(offsets[-1])
    array = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[keep].tobytes())])
    coded = array.dictionary_encode()
    return np.asarray(coded.indices, dtype=np.int64), coded.dictionary


def trimmed(run):
    """run, after which the Python worker gives memory that it doesn't need back: idle workers stay beside the executor."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        gc.collect()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return inner


def filtered(docs: DataFrame, text_col: str, mask) -> DataFrame:
    """The rows of docs for whose text mask(texts) is true, all columns as they are; mask runs on the executors."""
    at = docs.columns.index(text_col)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, [f"c{i}" for i in range(batch.num_columns)])
            for part in slices(named, f"c{at}"):
                kept = part.filter(pa.array(mask(part.column(at))))
                yield pa.RecordBatch.from_arrays(kept.columns, batch.schema.names)

    return docs.mapInArrow(trimmed(run), docs.schema)
