"""Quality classifier: a convolutional network over bytes, in numpy.

A text's bytes are cut into overlapping chunks that cover it whole; bytes have learned vectors, filters slide over each
chunk, and each filter's largest response in a chunk is kept (max-pooling).  The responses are averaged over the chunks
and a logistic layer gives one probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, named, raw, slices, table, training_rows, trimmed

CHUNK, STEP = 256, 224  # bytes of a chunk, and from one to the next
WIDTH, STRIDE = 8, 2  # bytes under a filter, and from one place to the next
PLACES = (CHUNK - WIDTH) // STRIDE + 1
VECTOR, FILTERS = 8, 16
GROUP = 64  # chunks convolved at once, so that their windows stay in the cache


@dataclass(frozen=True)
class Fit:
    """About `rows` rows of each label are learned from, by a hash of the text, all chunks of each."""

    rows: int = 3000
    rounds: int = 8
    least_steps: int = 600
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    vectors: np.ndarray  # (256, VECTOR)
    filters: np.ndarray  # (WIDTH * VECTOR, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (FILTERS,)
    offset: float

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """The vectors under a filter at each place of each chunk: (chunks, PLACES, WIDTH * VECTOR)."""
        x = np.ascontiguousarray(self.vectors[chunks]).reshape(len(chunks), CHUNK * VECTOR)
        a, b = x.strides
        view = np.lib.stride_tricks.as_strided(x, (len(chunks), PLACES, WIDTH * VECTOR), (a, STRIDE * VECTOR * b, b), writeable=False)
        return np.ascontiguousarray(view)

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each chunk, at least 0."""
        out = np.empty((len(chunks), FILTERS), np.float32)
        for i in range(0, len(chunks), GROUP):
            part = chunks[i : i + GROUP]
            found = (self.windows(part).reshape(-1, WIDTH * VECTOR) @ self.filters).reshape(len(part), PLACES, FILTERS)
            out[i : i + GROUP] = found.max(axis=1)
        return np.maximum(out + self.bias, 0)

    def score(self, column: pa.Array) -> np.ndarray:
        """The probability of each text."""
        chunks, text_of = chunked(column)
        n = len(column)
        value = self.pooled(chunks) @ self.weights
        logit = np.bincount(text_of, value, minlength=n) / np.bincount(text_of, minlength=n) + self.offset
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def chunked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of all texts, (chunks, CHUNK), and the text number of each; each text has one at least, zeros fill it."""
    data, offsets = raw(column)
    size = np.diff(offsets)
    number = np.maximum(1, -(-(size - CHUNK) // STEP) + 1)
    text_of = np.repeat(np.arange(len(size)), number)
    nth = np.arange(len(text_of)) - np.repeat(np.cumsum(number) - number, number)
    begin = offsets[text_of] + nth * STEP
    at = begin[:, None] + np.arange(CHUNK)
    inside = at < offsets[text_of + 1][:, None]
    padded = np.append(data, np.uint8(0))
    return padded[np.where(inside, at, len(data))], text_of


def learn(rows: DataFrame, fit: Fit = Fit()) -> Network:
    """A network from rows (text, label 0 or 1 and, if there is one, weight); rows with a null text or label aren't used.

    weight: the rows that a row stands for.  The probabilities are those of labels at their weighted shares of all rows, so
    that a score means the same whatever was sampled.  Rows of one text with both labels all count.  Without rows every text
    scores 0.5; with rows of one label only, the score nears that label everywhere.
    """
    weight = F.col("weight").cast("double") if "weight" in rows.columns else F.lit(1.0)
    rows = rows.where("text IS NOT NULL AND label IN (0, 1)").select("text", F.col("label").cast("int").alias("label"), weight.alias("weight"))
    totals = {r.label: r for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()}
    taken = F.lit(False)
    for label, r in totals.items():
        taken = taken | ((F.col("label") == label) & (F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < min(1_000_000, math.ceil(1_000_000 * fit.rows / r.n))))
    # Some twice fit.rows whole texts come to the driver.
    found = sorted((r.text.encode(), r.label) for r in rows.where(taken).select("text", "label").toLocalIterator())
    labels = np.array([y for _, y in found], np.float32)
    network = trained([chunked(pa.array([x], pa.large_binary()).cast(pa.large_string()))[0] for x, _ in found], labels, fit)
    if 0 < labels.sum() < len(labels):
        network.offset += math.log(totals[1].weight / totals[0].weight) - math.log(labels.sum() / (len(labels) - labels.sum()))
    return network


def trained(texts: list[np.ndarray], labels: np.ndarray, fit: Fit = Fit()) -> Network:
    """A network trained by Adam on the chunks of texts and their labels."""
    rng = np.random.default_rng(fit.seed)
    net = Network(
        rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
        rng.normal(0, math.sqrt(2 / (WIDTH * VECTOR)), (WIDTH * VECTOR, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, FILTERS).astype(np.float32),
        0.0,
    )
    if not len(texts):
        return Network(net.vectors, net.filters, net.bias, net.weights * 0, 0.0)
    mean = float(np.clip(labels.mean(), 0.01, 0.99))
    value = [net.vectors, net.filters, net.bias, net.weights, np.array([math.log(mean / (1 - mean))], np.float32)]
    first, second = [np.zeros_like(v) for v in value], [np.zeros_like(v) for v in value]
    each = -(-len(texts) // fit.batch)
    rounds = max(fit.rounds, min(fit.least_steps // each, 100))
    step, steps = 0, rounds * each
    for _ in range(rounds):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), fit.batch):
            pick = order[i : i + fit.batch]
            grads = _gradients(Network(*value[:4], float(value[4][0])), [texts[k] for k in pick], labels[pick])
            step += 1
            rate = fit.rate * min(1.0, step / 20) * (1 + math.cos(math.pi * step / (steps + 1))) / 2
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                value[k] = (value[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Network(*value[:4], float(value[4][0]))


def _gradients(net: Network, texts: list[np.ndarray], labels: np.ndarray, decay: float = 1e-4) -> list[np.ndarray]:
    """Of the mean log loss in vectors, filters, bias, weights and offset; only the largest responses pass it down."""
    number = np.array([len(x) for x in texts])
    chunks, text_of = np.concatenate(texts), np.repeat(np.arange(len(texts)), number)
    # Windows are made for a group of chunks at a time, so a long text takes no more memory than its largest responses.
    groups = [slice(i, i + GROUP) for i in range(0, len(chunks), GROUP)]
    place, top = np.empty((len(chunks), FILTERS), np.int64), np.empty((len(chunks), FILTERS), net.filters.dtype)
    for g in groups:
        response = (net.windows(chunks[g]).reshape(-1, WIDTH * VECTOR) @ net.filters).reshape(-1, PLACES, FILTERS)
        place[g] = response.argmax(axis=1)
        top[g] = np.take_along_axis(response, place[g][:, None, :], axis=1)[:, 0]
    pooled = top + net.bias
    active = np.maximum(pooled, 0)
    mean = np.zeros((len(texts), FILTERS), np.float32)
    np.add.at(mean, text_of, active / number[text_of][:, None])
    p = 1 / (1 + np.exp(-np.clip(mean @ net.weights + net.offset, -30, 30)))
    wrong = ((p - labels) / len(texts)).astype(np.float32)
    down = (wrong / number)[text_of][:, None] * net.weights * (pooled > 0)
    to_filters, to_vectors = np.zeros_like(net.filters), np.zeros((256, VECTOR))
    for g in groups:
        rows = np.arange(len(chunks[g]))[:, None]
        octets = chunks[g][rows[:, :, None], place[g][:, :, None] * STRIDE + np.arange(WIDTH)]  # (chunks, FILTERS, WIDTH)
        under = net.vectors[octets].reshape(len(rows), FILTERS, WIDTH * VECTOR)
        to_filters += np.einsum("cf,cfx->xf", down[g], under, optimize=True)
        to_windows = (down[g][:, :, None] * net.filters.T[None]).reshape(-1, VECTOR)
        for k in range(VECTOR):
            to_vectors[:, k] += np.bincount(octets.reshape(-1), to_windows[:, k], minlength=256)
    return [
        to_vectors.astype(np.float32) + decay * net.vectors,
        to_filters + decay * net.filters,
        down.sum(axis=0),
        mean.T @ wrong + decay * net.weights,
        np.array([wrong.sum()], np.float32),
    ]


def quality(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id_col, score, predicted) for each row of docs; no shuffle.

    A null or empty text is one chunk of zeros and scores what the network gives that.  Repeated rows give repeated
    rows, a null id stays null, an empty table gives an empty one, other columns are not read.  An id_col called like a
    result keeps its name, and the result gets an underscore behind.  A text is held whole, with nine bytes a byte of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                score = network.score(part.column(1)).astype(float)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return named(rows.mapInArrow(trimmed(run), f"id {dict(rows.dtypes)['id']}, score double, predicted int"), id=id_col)


def op6_quality_cnn(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    train = training_rows(docs.select("doc_id", "text"), labels, Fit.rows)
    return quality(docs, learn(train.select("text", "label", "weight"))).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
