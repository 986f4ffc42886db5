"""Language ID: script ranges narrow the candidates of each word, then Viterbi over per-word scores labels spans.

A word's score in a language sums the log probabilities of its hashed byte n-grams there.  A change of language between
neighbouring words costs a penalty.  The Viterbi pass runs over blocks of words side by side: each block is solved for
every language before it, the blocks of a text are chained, and the path is traced back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, crc_mod, named, numbered, raw, slices, spans, table, trimmed

# First and last code point of the ranges of letters, by script.
SCRIPTS = (
    ("Latin", 0x41, 0x24F), ("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F), ("Armenian", 0x530, 0x58F), ("Hebrew", 0x590, 0x5FF), ("Arabic", 0x600, 0x6FF), ("Devanagari", 0x900, 0x97F),
    ("Bengali", 0x980, 0x9FF), ("Tamil", 0xB80, 0xBFF), ("Telugu", 0xC00, 0xC7F), ("Thai", 0xE00, 0xE7F), ("Georgian", 0x10A0, 0x10FF), ("Latin", 0x1E00, 0x1EFF), ("Greek", 0x1F00, 0x1FFF),
    ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x9FFF), ("Hangul", 0xAC00, 0xD7AF), ("Han", 0xF900, 0xFAFF), ("Han", 0x20000, 0x3134F),
)
SCRIPT_NAMES = (*dict.fromkeys(name for name, _, _ in SCRIPTS), "other")
_FIRST = np.array([a for _, a, _ in SCRIPTS])
_LAST = np.array([b for _, _, b in SCRIPTS])
_SCRIPT_ID = np.array([SCRIPT_NAMES.index(name) for name, _, _ in SCRIPTS])

#: ASCII bytes that aren't letters part words.
OUTSIDE = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
BLOCK = 32
#: Numbers that the forward pass holds at once.
CELLS = 1 << 18


@dataclass(frozen=True)
class Fit:
    """About `rows` labelled rows of each language are learned from, by a hash of the text.

    opens: whether a text is in the language that it opens in where that holds a share, which is fitted on those rows; else
    it is in the one that most of its spans are in: what it quotes interrupts it.
    """

    rows: int = 6000
    smoothing: float = 0.3
    opens: bool = False


@dataclass
class Model:
    """languages, sorted; logs[bucket, language]; scripts[script, language]: whether it is written so."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray
    penalty: float = 9.0
    clip: float = 6.0
    opening: float = 1.0  # share from which the language that opens a text is the text's, whatever has most
    least: float = -math.inf  # mean log probability of a text's n-grams in its language, below which it is unlike all learned rows


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the lower-cased texts, their offsets, and first byte, end and text number of each run of letters."""
    data, offsets = raw(pc.utf8_lower(column.cast(pa.large_string())))
    return data, offsets, *spans(data, offsets, OUTSIDE[data])


def _grams(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n the buckets of the byte n-grams of the words, a space before and behind, and the word number of each."""
    if not len(words):
        return
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[: len(words) + 1]
    size = np.diff(at)
    padded = np.full(int(at[-1]) + 2 * len(words), 32, np.uint64)
    begin = at[:-1] + 2 * np.arange(len(words))
    word_of = np.repeat(np.arange(len(words)), size)
    if len(word_of):
        padded[np.arange(at[-1]) + 2 * word_of + 1] = np.frombuffer(data, np.uint8)[: at[-1]]
    owner = np.repeat(np.arange(len(words)), size + 2)
    end = begin + size + 2
    value = np.zeros(len(padded), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        value = value[: len(padded) - n + 1] * np.uint64(0x9E3779B1) + padded[n - 1 :] + np.uint64(n)
        if n in GRAMS:
            fits = np.arange(len(value)) + n <= end[owner[: len(value)]]
            if n == 1:
                fits &= padded != 32
            mixed = value[fits]
            mixed = mixed ^ (mixed >> np.uint64(29))
            yield ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64), owner[: len(value)][fits]


def script_of(words: pa.Array) -> np.ndarray:
    """The script of the first letter of each word, by its place in SCRIPT_NAMES."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[: len(words) + 1]
    if not len(words):
        return np.zeros(0, np.int64)
    octets = np.concatenate([np.frombuffer(data, np.uint8)[: at[-1]], np.zeros(4, np.uint8)]).astype(np.int64)
    b = [octets[at[:-1] + k] for k in range(4)]
    point = np.select(
        [b[0] < 0x80, b[0] < 0xE0, b[0] < 0xF0],
        [b[0], (b[0] & 31) << 6 | b[1] & 63, (b[0] & 15) << 12 | (b[1] & 63) << 6 | b[2] & 63],
        (b[0] & 7) << 18 | (b[1] & 63) << 12 | (b[2] & 63) << 6 | b[3] & 63,
    )
    k = np.searchsorted(_FIRST, point, "right") - 1
    return np.where((k >= 0) & (point <= _LAST[k]), _SCRIPT_ID[k], len(SCRIPT_NAMES) - 1)


def word_logs(words: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each word and language the log probability of the word's n-grams, and how many n-grams each word has."""
    total, n = np.zeros((len(words), len(model.languages))), np.zeros(len(words))
    for bucket, of in _grams(words):
        n += np.bincount(of, minlength=len(words))
        for k in range(len(model.languages)):
            total[:, k] += np.bincount(of, model.logs[bucket, k], minlength=len(words))
    return total, n


def word_scores(words: pa.Array, model: Model, logs: np.ndarray | None = None) -> np.ndarray:
    """For each word and language the score over the best one of the word, within the clip; candidates by script."""
    total = word_logs(words, model)[0] if logs is None else logs
    if not len(words):
        return total
    may = model.scripts[script_of(words)]
    may[~may.any(axis=1)] = True
    total = np.where(may, total, -np.inf)
    return np.maximum(total - total.max(axis=1, keepdims=True), -model.clip)


def viterbi(scores: np.ndarray, text_of: np.ndarray, penalty: float, cells: int = CELLS) -> np.ndarray:
    """The best language of each word; scores of the words of all texts in a row, text_of ascending.

    Blocks are solved in turns of so many that their languages squared are about `cells` numbers, however long a text is
    and however many languages there are; between the turns a text hands on one number a language.
    """
    n, states = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    texts, n_words = np.unique(text_of, return_counts=True)
    begin = np.cumsum(n_words) - n_words
    n_blocks = -(-n_words // BLOCK)
    first_block = np.cumsum(n_blocks) - n_blocks
    owner = np.repeat(np.arange(len(texts)), n_blocks)
    nth = np.arange(len(owner)) - first_block[owner]
    start = begin[owner] + nth * BLOCK
    filled = np.minimum(BLOCK, begin[owner] + n_words[owner] - start)
    padded = np.vstack([scores, np.zeros((1, states))])
    turn = max(1, cells // (states * states))
    turns = [slice(x, min(x + turn, len(owner))) for x in range(0, len(owner), turn)]
    small = np.min_scalar_type(states)
    itself = np.arange(states, dtype=small)

    def row(part: slice, t: int) -> np.ndarray:
        return padded[np.where(t < filled[part], start[part] + t, n)]

    # Forwards: the value of each block by the languages before and at its end, then along the blocks of each text.
    ahead, came = np.zeros((len(texts), states)), np.zeros((len(owner), states), small)
    for part in turns:
        # value[block, language before, language now]; a padding word changes nothing.
        value = row(part, 0)[:, None, :] - penalty * (1 - np.eye(states))
        for t in range(1, int(filled[part].max())):
            best = value.max(axis=2, keepdims=True) - penalty
            value = np.where((best > value) & (t < filled[part])[:, None, None], best, value) + row(part, t)[:, None, :]
        here, at, count = np.unique(owner[part], return_index=True, return_counts=True)
        by_size = np.argsort(-count, kind="stable")
        for k in range(int(count.max())):
            live = by_size[: np.searchsorted(-count[by_size], -k, "left")]
            block, text = at[live] + k, here[live]
            total = ahead[text][:, :, None] + value[block]
            came[part.start + block] = total.argmax(axis=1)
            ahead[text] = total.max(axis=1)
    # Backwards along the blocks: the language at the end of each, and the one before it.
    by_size = np.argsort(-n_blocks, kind="stable")
    sorted_blocks, state = n_blocks[by_size], ahead.argmax(axis=1)
    last, before = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
    for k in range(int(sorted_blocks[0]) - 1, -1, -1):
        live = by_size[: np.searchsorted(-sorted_blocks, -k, "left")]
        block = first_block[live] + k
        last[block] = state[live]
        before[block] = state[live] = came[block, state[live]]
    # Within each block, from the one language before it.
    out = np.zeros(n + 1, np.int64)
    for part in turns:
        steps, size, now = int(filled[part].max()), filled[part], last[part]
        value = row(part, 0) - penalty * (itself != before[part][:, None])
        back = np.empty((steps, len(size), states), small)
        for t in range(1, steps):
            best = value.max(axis=1, keepdims=True) - penalty
            moved = (best > value) & (t < size)[:, None]
            back[t] = np.where(moved, value.argmax(axis=1)[:, None].astype(small), itself)
            value = np.where(moved, best, value) + row(part, t)
        for t in range(steps - 1, -1, -1):
            out[np.where(t < size, start[part] + t, n)] = now
            if t:
                now = back[t, np.arange(len(size)), now]
    return out[:-1]


def labels_of(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the lower-cased texts in a row, and first byte in them, end, text number and language number of each word."""
    data, _, first, last, text_of = _letters(column)
    words, distinct = numbered(data, first, last)
    path = viterbi(word_scores(distinct, model)[words], text_of, model.penalty)
    return data, first, last, text_of, path


def language_spans(text: str | None, model: Model) -> list[tuple[str, str]]:
    """(language, stretch of the lower-cased text) of the spans of one language, in order."""
    data, first, last, _, path = labels_of(pa.array([text], pa.string()), model)
    edges = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(path)]
    return [(model.languages[path[a]], data[first[a] : last[b - 1]].tobytes().decode()) for a, b in zip(edges, edges[1:]) if a < b]


def learn(rows: DataFrame, fit: Fit = Fit(), **model) -> Model:
    """A model from rows (text, lang); rows with a null text or lang aren't used; without rows it knows no language.

    All languages of the rows are learned; the model has 65,536 numbers for each, and what is held while it is used grows in
    proportion to their number, not to its square.
    """
    rows = rows.where("lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    # Counted without reading the texts: the shares are approximate anyway.
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1_000_000, math.ceil(1_000_000 * fit.rows / n))))])
    sample = rows.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.try_element_at(share, F.col("lang"))))
    number = {k: i for i, k in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS + len(SCRIPT_NAMES)), np.int64)
        for batch in batches:
            for part in slices(batch):
                lang = np.array([number[x] for x in part.column(1).to_pylist()])
                data, _, first, last, text_of = _letters(part.column(0))
                words, distinct = numbered(data, first, last)
                script = script_of(distinct)
                present = np.unique(lang)
                times = {k: np.bincount(words[lang[text_of] == k], minlength=len(distinct)) for k in present}
                for k in present:
                    total[k, BUCKETS:] += np.bincount(script, times[k], minlength=len(SCRIPT_NAMES)).astype(np.int64)
                for bucket, of in _grams(distinct):
                    for k in present:
                        total[k, :BUCKETS] += np.bincount(bucket, times[k][of], minlength=BUCKETS).astype(np.int64)
        k, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[k, bucket])], ["k", "bucket", "n"])

    counts = sample.mapInArrow(trimmed(count), "k int, bucket int, n bigint").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    total[counts["bucket"], counts["k"]] = counts["n"]
    grams, scripts = total[:BUCKETS], total[BUCKETS:]
    logs = np.log((grams + fit.smoothing) / (grams.sum(axis=0) + fit.smoothing * BUCKETS))
    used = scripts >= 0.01 * np.maximum(1, scripts.sum(axis=0))
    found = Model(languages, logs.astype(np.float32), used, **model)
    opening, least = _fitted(sample, found, [model["opening"]] if "opening" in model else OPENINGS if fit.opens else OPENINGS[-1:])
    found.opening = opening
    found.least = model.get("least", least)
    return found


#: Shares among which a fit chooses; the last one leaves the choice to what has most.
OPENINGS = (0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 1.0)


#: Steps of the mean log probability from 0 down in which learned rows are counted.
STEP, STEPS = 0.01, 4000
#: The share of the learned rows that may lie anywhere; what the others span is taken half as wide again.
STRAY = 0.001
#: The share from which a language can be a text's: a line of another one at either end isn't.
PART = 0.2
#: What a text's language and the one that it quotes hold together, above the two thirds of three languages evenly mixed.
PAIR = 0.7


def _fitted(sample: DataFrame, model: Model, openings: Sequence[float]) -> tuple[float, float]:
    """The share that gets most of the sample right, of equal ones the largest; and the least mean log probability.

    A text that quotes another language at length is still marked with its own, the one it opens in.  The rows that are
    right by that share have a range of mean log probabilities in their language, which long quotes make wide; the least
    is as far below its lower end (without the strays) as half the way from there to the median.
    """
    number = {k: i for i, k in enumerate(model.languages)}
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = np.zeros((len(openings), STEPS), np.int64)
        for batch in batches:
            for part in slices(batch, most=_slice(model)):
                lang = np.array([number[x] for x in part.column(1).to_pylist()])
                share, opens, logs, runs = _shares(part.column(0), shared.value)
                for i, least in enumerate(openings):
                    ok = (share.sum(axis=1) > 0) & (_choice(share, opens, least, runs) == lang)
                    step = np.minimum(STEPS - 1, -logs[ok, lang[ok]] / STEP).astype(np.int64)
                    right[i] += np.bincount(step, minlength=STEPS)
        i, step = np.nonzero(right)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(step.astype(np.int32)), pa.array(right[i, step])], ["i", "step", "n"])

    right = np.zeros((len(openings), STEPS), np.int64)
    for r in sample.mapInArrow(trimmed(run), "i int, step int, n bigint").groupBy("i", "step").agg(F.sum("n").alias("n")).collect():
        right[r.i, r.step] = r.n
    best = max(range(len(openings)), key=lambda i: (right[i].sum(), i))
    upto = np.cumsum(right[best])
    if not upto[-1]:
        return openings[best], -math.inf
    middle, end = (STEP * (1 + int(np.searchsorted(upto, share * upto[-1]))) for share in (0.5, 1 - STRAY))
    return openings[best], -(end + (end - middle) / 2)


def _slice(model: Model) -> int:
    """Bytes of text worked on at once: with many languages less, as each word has a number for each."""
    return SLICE_BYTES * 8 // max(8, len(model.languages))


def _shares(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of words of each text by language, the language of its first word (0 without one), the mean log probability of
    all its n-grams in each language, and the number of its spans by language."""
    data, offsets, first, last, text_of = _letters(column)
    words, distinct = numbered(data, first, last)
    logs, grams = word_logs(distinct, model)
    path = viterbi(word_scores(distinct, model, logs)[words], text_of, model.penalty)
    n, k = len(column), len(model.languages)
    share = np.bincount(text_of * k + path, last - first, minlength=n * k).reshape(n, k)
    opens = np.zeros(n, np.int64)
    texts, begins = np.unique(text_of, return_index=True)
    opens[texts] = path[begins]
    new = np.ones(len(path), bool)
    new[1:] = (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1])
    runs = np.bincount(text_of[new] * k + path[new], minlength=n * k).reshape(n, k)
    of_text = np.stack([np.bincount(text_of, logs[words, i], minlength=n) for i in range(k)], axis=1)
    return share, opens, of_text / np.maximum(1, np.bincount(text_of, grams[words], minlength=n))[:, None], runs


def _choice(share: np.ndarray, opens: np.ndarray, least: float, runs: np.ndarray) -> np.ndarray:
    """The language that most spans are in, among those that hold a part of the text, of equal ones that which holds most; a
    text that opens in a language that holds the share `least` is in that one."""
    held, total = share[np.arange(len(share)), opens], share.sum(axis=1)
    frames = np.where(share >= PART * total[:, None], runs, 0)
    most = (frames + share / (total[:, None] + 1)).argmax(axis=1)
    return np.where(held >= least * total, opens, most)


def _judged(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    n = len(column)
    share, opens, logs, runs = _shares(column, model)
    total = share.sum(axis=1)
    best = _choice(share, opens, model.opening, runs)
    held_by = share[np.arange(n), best] / np.maximum(total, 1)
    # What decides: the share of the bytes where the opening rule does, else the share of the spans.
    opening = (best == opens) & (held_by >= model.opening)
    score = np.where(total > 0, np.where(opening, held_by, runs[np.arange(n), best] / np.maximum(1, runs.sum(axis=1))), 0.0)
    data, offsets = raw(column)
    ascii_letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~OUTSIDE[data] & (data < 128), out=ascii_letters[1:])
    lettered = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~lettered & (total > 0)):
        lettered[i] = any(map(str.isalpha, column[int(i)].as_py() or ""))
    known = lettered & (total > 0)
    other = share.copy()
    other[np.arange(n), best] = 0
    quotes = opening & (share[np.arange(n), best] + other.max(axis=1) >= PAIR * total)
    held = (held_by >= 0.5) | quotes
    clear = known & held & (logs[np.arange(n), best] >= model.least)
    return [model.languages[b] if ok else "und" for b, ok in zip(best, known)], np.where(lettered, score, 0.0), clear


def predict(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """The language of each text and its share of what decides, the spans (the bytes of words where a text is in the language
    that it opens in); `und` without a letter or a model.

    It is the one that most spans are in, of those with a fifth of the bytes at least, of equal ones the one with most; or, in a model with a share `opening`, the one
    that the text opens in where that holds the share.
    """
    return _judged(column, model)[:2]


def clear(column: pa.Array, model: Model) -> np.ndarray:
    """Whether each text is in a clear language: it has letters, its language holds half of it (or opens it, holds the
    share `opening` and quotes one other language), and its n-grams are as likely in that language as `least` asks, which the learned rows' range gives."""
    return _judged(column, model)[2]


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) for each row of docs; no shuffle.

    `und` with score 0 for null and empty texts, texts without a letter, and a model without languages.  Repeated rows
    give repeated rows, a null id stays null, an empty table gives an empty one, other columns are not read.  An id_col
    called like a result keeps its name, and the result gets an underscore behind.  A text is held whole, with some numbers
    for each of its words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 65,536 numbers for each learned language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, most=_slice(known)):
                if known.languages:
                    lang, score = predict(part.column(1), known)
                else:
                    lang, score = ["und"] * part.num_rows, np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return named(rows.mapInArrow(trimmed(run), f"id {dict(rows.dtypes)['id']}, lang_pred string, score double"), id=id_col)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(crc_mod("doc_id", 4) != 2).select("text", "lang"))
    return detect(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
