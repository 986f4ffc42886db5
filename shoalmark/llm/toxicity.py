"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text, normalised by length, with exception phrases.

Text and lexicon are folded alike: lower case, accents and look-alike letters of other scripts to Latin ones, digits and
signs used as letters to letters.  Entries are whole words or stems that begin a word; their weights are log odds learned
from labelled rows.  An occurrence inside an exception phrase doesn't count.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, named, slices, table, training_rows, trimmed, written

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "€": "e"}
INVISIBLE = "­​‌‍⁠﻿"
#: Phrases in which an entry is harmless.
EXCEPTIONS = ("trash can", "trash bag", "clown fish", "idiot proof", "pathetic fallacy")


def _fold_table() -> dict[int, str | None]:
    out: dict[int, str | None] = {}
    for code in [*range(0x41, 0x5B), *range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0x2100, 0x2140), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]:
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(x)).lower()
        plain = "".join(LOOKALIKES.get(x, x) for x in plain)
        if plain and plain != chr(code):
            out[code] = plain
    out |= {ord(k): v for k, v in (SUBSTITUTES | LOOKALIKES).items()}
    return out | {ord(x): None for x in INVISIBLE} | {x: None for x in range(0x300, 0x370)}


FOLD = _fold_table()
_WORDS = re.compile(r"[^\W\d_]+")
_PAIR = re.compile(r"[^\W\d_]+ [^\W\d_]+")


def fold(text: str) -> str:
    return text.translate(FOLD)


@dataclass(frozen=True)
class Fit:
    """Bounds and thresholds of the fit: at most about `rows` labelled rows of either label are learned from.

    letters: the least and most of a whole-word entry.  Shorter words are in every text, and longer ones are strings that
    hardly occur twice; neither is left out of a score, as stems begin words of any length.
    """

    rows: int = 12000
    least_docs: int = 4
    least_weight: float = 1.5
    stems: tuple[int, ...] = (4, 5, 6, 7)
    letters: tuple[int, int] = (3, 30)


@dataclass
class Lexicon:
    """weights: entry (a stem ends in *) -> weight; exceptions: folded phrases; curve: intercept and slope of the score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = tuple(EXCEPTIONS)
    curve: tuple[float, float] = (-4.0, 4.0)
    automaton: object = field(default=None, repr=False)

    def built(self) -> Lexicon:
        auto, entries = ahocorasick.Automaton(), defaultdict(list)
        for term, weight in self.weights.items():
            word = fold(term.rstrip("*"))
            # 1 stands for i or l, and folding can't tell: an entry with l is also looked for with i.
            for form in {word, word.replace("l", "i")}:
                entries[form].append((weight, term.endswith("*"), len(form)))
        for form, found in entries.items():
            auto.add_word(form, (0, found))
        for phrase in self.exceptions:
            form = fold(phrase)
            auto.add_word(form, (1 if form not in entries else 2, entries.get(form, []), len(form)))
        if len(auto):
            auto.make_automaton()
        self.automaton = auto
        return self

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(begin, end, weight) of the occurrences that count; of entries that begin at one place the heaviest."""
        if not len(self.automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        excused = []
        n = len(folded)
        for last, found in self.automaton.iter(folded):
            end = last + 1
            if found[0]:
                excused.append((end - found[2], end))
            for weight, stem, size in found[1]:
                begin = end - size
                if begin and folded[begin - 1].isalpha() or not stem and end < n and folded[end].isalpha():
                    continue
                if begin not in best or best[begin][1] < weight:
                    best[begin] = end, weight
        if not excused:
            return [(b, e, w) for b, (e, w) in best.items()]
        excused.sort()
        begins, reach = [x for x, _ in excused], []  # reach: the furthest end of the spans up to each
        for _, y in excused:
            reach.append(max(y, reach[-1]) if reach else y)

        def inside(b: int, e: int) -> bool:
            k = bisect_right(begins, b)
            return k > 0 and reach[k - 1] >= e

        return [(b, e, w) for b, (e, w) in best.items() if not inside(b, e)]

    def density(self, text: str | None) -> float:
        """Weight of the occurrences, over the fourth root of the length in thousands of characters."""
        folded = fold(text or "")
        found = self.hits(folded)
        return sum(w for _, _, w in found) / max(1.0, len(folded) / 1000) ** 0.25 if found else 0.0

    def score(self, text: str | None) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-(a + b * math.log1p(self.density(text)))))


def _terms(text: str, fit: Fit) -> set[str]:
    """Words of a folded text, and their first letters with a * behind."""
    words, (least, most) = set(_WORDS.findall(fold(text))), fit.letters
    return {w for w in words if least <= len(w) <= most} | {w[:k] + "*" for w in words for k in fit.stems if len(w) >= k}


def _contexts(text: str, keep: frozenset[str], stems: Iterable[int]) -> dict[str, int]:
    """The terms of a text that are in keep, each with a hash of the words around its first occurrence."""
    words = _WORDS.findall(fold(text))
    out: dict[str, int] = {}
    for i, w in enumerate(words):
        for t in (w, *(w[:k] + "*" for k in stems if len(w) >= k)):
            if t in keep and t not in out:
                out[t] = crc32(" ".join((*words[max(0, i - 2) : i], "", *words[i + 1 : i + 3])).encode())
    return out


def _chosen(found: list[dict[str, int]], clean: Counter, n_clean: int, fit: Fit) -> dict[str, float]:
    """Entries picked one by one: each time the term found in the most toxic documents that no entry explains yet.

    Evidence counts once for equal neighbouring words: copies and near copies of a document aren't evidence anew.
    """
    docs_of: dict[str, dict[int, int]] = defaultdict(dict)
    for i, terms in enumerate(found):
        for t, context in terms.items():
            docs_of[t][i] = context
    n = len(found)
    evidence = {t: len(set(d.values())) for t, d in docs_of.items()}

    def weight(t: str) -> float:
        return math.log((evidence[t] + 0.5) / (n + 1)) - math.log((clean[t] + 0.5) / (n_clean + 1))

    pure = {t: d for t, d in docs_of.items() if weight(t) >= fit.least_weight and evidence[t] >= fit.least_docs}
    left, out = {t: dict(d) for t, d in pure.items()}, {}
    terms_in: dict[int, list[str]] = defaultdict(list)
    for t, docs in pure.items():
        for i in docs:
            terms_in[i].append(t)
    # What a term still explains only falls, so the top of the heap is looked at again before it is taken.
    heap = [(-evidence[t], -evidence[t], -len(t), -k, t) for k, t in enumerate(sorted(pure))]
    heapq.heapify(heap)
    while heap:
        gain, *tie, term = heapq.heappop(heap)
        now = len(set(left[term].values()))
        if now < fit.least_docs:
            continue
        if now < -gain:
            heapq.heappush(heap, (-now, *tie, term))
            continue
        out[term] = weight(term)
        for i in list(left[term]):
            for t in terms_in[i]:
                left[t].pop(i, None)
    # Whole words whose purity chance would not give any of the terms weigh in beside them.
    rare = math.log(n / (n + n_clean))
    return out | {t: weight(t) for t in pure if t not in out and not t.endswith("*") and clean[t] == 0 and evidence[t] * rare < -math.log(1000 * max(1, len(docs_of)))}


def learn(labelled: DataFrame, fit: Fit = Fit(), exceptions: Iterable[str] = EXCEPTIONS) -> Lexicon:
    """A lexicon from rows (text, label and, if there is one, weight); rows with a null text or label aren't used.

    Of each label about fit.rows rows are taken, by a hash of their text.  Equal texts count once, with the label that most
    of their rows have; where both have as many, the text isn't used.  weight: the rows that a row stands for; the score's
    curve takes the labels at their weighted shares, so that a score means the same whatever was sampled.  Without rows of
    both labels the lexicon is empty, and its score is the same low one everywhere.

    To the driver come the terms that are purely toxic and, for each toxic row of the sample, those that it has: fit.rows
    bounds both.
    """
    spark = labelled.sparkSession
    weight = F.col("weight").cast("double") if "weight" in labelled.columns else F.lit(1.0)
    rows = labelled.where("text IS NOT NULL AND label IN (0, 1)").select("text", F.col("label").cast("int").alias("label"), weight.alias("weight"))
    totals = {r.label: r for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()}
    if len(totals) < 2:
        return Lexicon({}, tuple(exceptions)).built()
    share = {k: min(1_000_000, math.ceil(1_000_000 * fit.rows / r.n)) for k, r in totals.items()}
    bound: Column = F.when(F.col("label") == 1, share[1]).otherwise(share[0])
    taken = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < bound)
    voted = taken.groupBy(F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"), F.avg("label").alias("vote")).where("vote <> 0.5")
    sample = written(voted.select("text", (F.col("vote") > 0.5).cast("int").alias("label")))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter((label, t) for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t in _terms(text, fit))
            yield pa.RecordBatch.from_arrays([pa.array([t for _, t in found], pa.string()), pa.array([k for k, _ in found], pa.int32()), pa.array(list(found.values()), pa.int64())], ["term", "label", "n"])

    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    of = F.when(F.col("label") == 1, F.col("n")), F.when(F.col("label") == 0, F.col("n"))
    counts = sample.mapInArrow(trimmed(terms), "term string, label int, n bigint").groupBy("term").agg(F.coalesce(F.sum(of[0]), F.lit(0)).alias("toxic"), F.coalesce(F.sum(of[1]), F.lit(0)).alias("clean"))
    purity = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    in_clean = Counter({r.term: r.clean for r in counts.where((F.col("toxic") >= fit.least_docs) & (purity >= fit.least_weight)).toLocalIterator()})
    kept, stems = spark.sparkContext.broadcast(frozenset(in_clean)), fit.stems

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = kept.value
        for batch in batches:
            found = [sorted(_contexts(text, keep, stems).items()) for text in batch.column(0).to_pylist()]
            terms = pa.array([[t for t, _ in x] for x in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([terms, pa.array([[c for _, c in x] for x in found], pa.list_(pa.int64()))], ["terms", "contexts"])

    toxic = sample.where("label = 1").select("text")
    found = [dict(zip(r.terms, r.contexts)) for r in toxic.mapInArrow(trimmed(sets), "terms array<string>, contexts array<bigint>").toLocalIterator()]
    lexicon = Lexicon(_chosen(found, in_clean, n_clean, fit), tuple(exceptions)).built()
    lexicon = _with_exceptions(sample, lexicon)
    lexicon.curve = _curve(sample, lexicon, {k: r.weight for k, r in totals.items()})
    return lexicon


def _scores(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """label and density of each row."""
    plain = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = plain.built()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([built.density(t) for t in batch.column(1).to_pylist()], pa.float64())], ["label", "density"])

    return rows.select("label", "text").mapInArrow(trimmed(run), "label int, density double")


def _with_exceptions(sample: DataFrame, lexicon: Lexicon, least: int = 3) -> Lexicon:
    """Adds as exceptions the entries with the next word that occur in `least` clean documents and in no toxic one."""
    plain = Lexicon(lexicon.weights, lexicon.exceptions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = plain.built()
        for batch in batches:
            labels, phrases = [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded = fold(text)
                near = {m[0] for b, _, _ in built.hits(folded) if (m := _PAIR.match(folded, b))}
                labels += [label] * len(near)
                phrases += near
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(phrases, pa.string())], ["label", "phrase"])

    found = sample.select("label", "text").mapInArrow(trimmed(run), "label int, phrase string").groupBy("phrase").agg(F.sum(1 - F.col("label")).alias("clean"), F.sum("label").alias("toxic"))
    more = [r.phrase for r in found.where(f"toxic = 0 AND clean >= {least}").orderBy(F.desc("clean"), "phrase").collect()]
    return Lexicon(lexicon.weights, (*lexicon.exceptions, *more)).built()


def _curve(sample: DataFrame, lexicon: Lexicon, sizes: dict[int, float]) -> tuple[float, float]:
    """Intercept and slope of a logistic curve of log(1 + density), each label at its share among all labelled rows.

    The densities are counted in steps of 0.05 before they leave the executors.
    """
    steps = _scores(sample, lexicon).select("label", F.least(F.round(F.log1p("density") / 0.05), F.lit(400)).alias("x")).groupBy("label", "x").agg(F.count("*").alias("n")).collect()
    total = Counter()
    for r in steps:
        total[r.label] += r.n
    x, y = np.array([r.x * 0.05 for r in steps]), np.array([float(r.label) for r in steps])
    w = np.array([r.n * sizes[r.label] / total[r.label] for r in steps])
    w = w / w.sum() * min(w.sum(), 1e4)
    X, beta, ridge = np.stack([np.ones_like(x), x], axis=1), np.array([-3.0, 3.0]), np.diag([0.01, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        step = np.linalg.solve(X.T @ (X * (w * p * (1 - p))[:, None]) + ridge, X.T @ (w * (y - p)) - ridge @ beta)
        beta = beta + np.clip(step, -2, 2)
    return float(beta[0]), float(max(beta[1], 0.0))


def toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id_col, score, predicted, n_hits) for each row of docs; no shuffle.

    Null and empty texts have no occurrences and so the score of clean text.  Repeated rows give repeated rows, a null
    id stays null, an empty table gives an empty one, other columns are not read.  An id_col called like a result
    keeps its name, and the result gets an underscore behind.  A text is held whole, with its folded form and its hits.
    """
    plain = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = plain.built()
        a, b = built.curve
        for batch in batches:
            for part in slices(batch):
                density = np.zeros(part.num_rows)
                hits = np.zeros(part.num_rows, np.int64)
                for i, text in enumerate(part.column(1).to_pylist()):
                    if text:
                        folded = fold(text)
                        if found := built.hits(folded):
                            hits[i] = len(found)
                            density[i] = sum(w for _, _, w in found) / max(1.0, len(folded) / 1000) ** 0.25
                score = 1 / (1 + np.exp(-(a + b * np.log1p(density))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(hits)], ["id", "score", "predicted", "n_hits"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return named(rows.mapInArrow(trimmed(run), f"id {dict(rows.dtypes)['id']}, score double, predicted int, n_hits bigint"), id=id_col)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id"), F.col("toxic").alias("label"))
    train = training_rows(docs.select("doc_id", "text"), labels.where(crc_mod("doc_id", 4) != 2), Fit.rows)
    out = toxicity(docs, learn(train.select("text", "label", "weight")))
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "n_hits")
