"""Token counts through a digest cache: only texts that the cache doesn't know are encoded, each once, and then appended.

A text is known by the digest of its normalised content and a tokenizer by the digest of its file, settings and library,
so that a stored count stays right for good: another text or another tokenizer has another key.  The cache is a folder of
Parquet files, `tokenizer=<digest>/`, with (digest, n_tokens).

A run has three steps.  Digests of all rows, made distinct before and after one shuffle, are joined with the stored counts.
Texts whose digest has none are encoded, one row for each digest: copies fall together in each task before the one shuffle
of texts, and where the misses are few, Catalyst broadcasts them by their measured size and only their texts are shuffled.
What is found is a table first, and that table is appended to the cache: a lost executor or a failed append encodes nothing
again within the run.  Two runs that append the same digest at once leave it twice, which readers take for one.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from importlib.metadata import version as library_version

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import named, shared_dir, slices, small_batches, table, trimmed, written

#: Rows of a text's count: what the cache stores.
STORED = "digest binary, n_tokens bigint"
#: Characters of a text after which it may be encoded in parts.
LONG = 1 << 20
#: Tokens over which a document counts as over the limit.
MOST_TOKENS = 512


@lru_cache(4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function that counts the tokens of texts as the file's library does: tokenizers for .json, sentencepiece for .model.

    No begin, end or added special tokens, no truncation or padding; strings of special tokens are what they are by default.
    """
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores already
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)
    coder.no_truncation()
    coder.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    parts = spec.get("pre_tokenizer") or {}
    cuts = not spec.get("normalizer") and parts.get("type") == "ByteLevel" and parts.get("use_regex") and not parts.get("add_prefix_space") and not any(set(x["content"]) & set(" ") or x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in spec["added_tokens"])

    def count(texts: list[str]) -> list[int]:
        pieces = [in_parts(x) if cuts else [x] for x in texts]
        sizes = iter([len(x) for x in coder.encode_batch_fast([y for x in pieces for y in x], add_special_tokens=False)])
        return [sum(next(sizes) for _ in x) for x in pieces]

    return count


#: A space between ASCII letters and digits begins a word of byte-level tokenizers wherever it stands.
BETWEEN_WORDS = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def in_parts(text: str, most: int = LONG) -> list[str]:
    """The text in parts of about `most` characters, cut where a word begins; the parts' tokens are the text's."""
    out, first = [], 0
    while len(text) - first > most:
        cut = BETWEEN_WORDS.search(text, first + most)
        if not cut:
            break
        out.append(text[first : cut.start()])
        first = cut.start()
    return [*out, text[first:]]


def tokenizer_version(path: str) -> str:
    """The digest of a tokenizer file and of the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return sha256(f"{library} {library_version(library)} plain\n".encode() + f.read()).hexdigest()


class Cache:
    """The stored counts of one tokenizer version in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, version: str):
        self.spark, self.path = spark, f"{folder.rstrip('/')}/tokenizer={version}"
        spark.createDataFrame([], STORED).write.mode("ignore").parquet(self.path)

    def counts(self) -> DataFrame:
        """(digest, n_tokens), each digest once."""
        return self.spark.read.schema(STORED).parquet(self.path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame) -> None:
        counts.write.mode("append").parquet(self.path)


def as_it_is(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def token_counts(docs: DataFrame, path: str, cache: str, id_col: str = "doc_id", text_col: str = "text", normal: Callable[[Column], Column] = as_it_is) -> DataFrame:
    """(id_col, n_bytes, n_tokens, digest) for each row of docs.

    path: a tokenizer file that every executor has; cache: the folder of stored counts, made where it is missing.
    normal: what becomes of a text before it is digested, counted and measured, an expression of built-in functions; by
    default null is an empty text and nothing else changes, as byte-level tokens depend on every byte.
    n_bytes: of its UTF-8; digest: SHA-256 in hex.

    Repeated rows and ids, null ids and ties give a row for each row; an empty table gives an empty one; other columns are
    not read; an id_col called like a result keeps its name, and the result gets an underscore behind.  Texts are whole:
    byte-level tokenizers encode longer ones than a million characters in parts cut where words begin, others at once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stored = Cache(spark, cache, tokenizer_version(path))
    rows = docs.select(F.col(id_col).alias("id"), normal(F.col(text_col)).alias("text"))
    keyed = rows.select("id", "text", F.unhex(F.sha2(F.encode("text", "utf-8"), 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
    known = written(keyed.select("digest").distinct().join(stored.counts(), "digest", "left"))
    counts, misses = known.where("n_tokens is not null"), known.where("n_tokens is null").select("digest")
    if not misses.isEmpty():
        texts = keyed.groupBy("digest").agg(F.min("text").alias("text")).join(misses, "digest", "left_semi")
        fresh = written(encoded(texts, path))
        stored.append(fresh)
        counts = counts.unionByName(fresh)
    out = keyed.select("id", "digest", "n_bytes").join(counts, "digest").select("id", "n_bytes", "n_tokens", F.lower(F.hex("digest")).alias("digest"))
    return named(out, id=id_col)


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """(digest, n_tokens) of each row (digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(count(pc.fill_null(part.column(1), "").to_pylist()), pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(trimmed(run), STORED)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so that each run encodes every distinct text; jobs name a folder to keep."""
    import public_tokenizers

    folder = f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MOST_TOKENS).alias("over_limit"), "digest")
