"""Suffix-array repetition: maximal repeated word sequences of each text from longest-common-prefix intervals.

The suffix arrays of many texts are built together: ranks of word pairs are doubled (2, 4, 8, ... words) among the
suffixes that aren't alone yet, and since a rank begins with the number of the text, no prefix is shared between texts.
The ranks of each level then give the common prefix of neighbours in the suffix array, from the largest level down.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, named, numbered, raw, slices, spans, table, trimmed

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """A text fails if repeats of `least_words` or more cover over `covered` of its word characters, or one is longer
    than `longest_words` words, however long the text is."""

    least_words: int = 5
    covered: float = 0.2
    longest_words: int = 50


def suffix_array(words: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of each text in order (text by text), and the words that each shares with the one before it.

    words: numbers of the words of all texts in a row; text_of: ascending text number of each.  A rank is the place of
    the first suffix of its group, so that groups split without touching the suffixes that are alone already.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    span = int(words.max()) + 2
    follow = np.zeros(n, np.int64)
    follow[:-1] = np.where(text_of[1:] == text_of[:-1], words[1:] + 1, 0)
    first = text_of * span + words
    if (int(text_of[-1]) + 1) * span * span >= 2**62:
        first = np.unique(first, return_inverse=True)[1]
    keys = first * span + follow
    sa = np.argsort(keys, kind="stable")
    ordered = keys[sa]
    k, levels = 2, []
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    sizes = np.diff(np.append(starts, n))
    rank[sa] = np.repeat(starts, sizes)
    open_ = np.flatnonzero(np.repeat(sizes > 1, sizes))  # places in the suffix array that aren't settled
    while len(open_):
        levels.append((k, rank.astype(np.int32)))
        at = sa[open_]
        ahead = np.minimum(at + k, n - 1)
        second = np.where((at + k < n) & (text_of[ahead] == text_of[at]), rank[ahead] + 1, 0)
        group = rank[at]
        keys = group * (n + 1) + second
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        sa[open_] = at
        new = np.ones(len(at), bool)
        new[1:] = keys[1:] != keys[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(at)))
        rank = rank.copy()
        rank[at] = np.repeat(open_[starts], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        k *= 2
    lcp = np.zeros(n, np.int64)
    a, b = sa[1:], sa[:-1]
    near = np.flatnonzero(first[a] == first[b])  # the same text and first word
    a, b = a[near].copy(), b[near].copy()
    shared = np.zeros(len(near), np.int64)
    for k, level in reversed(levels):
        in_a, in_b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        same = (a < n) & (b < n) & (level[in_a] == level[in_b])
        a, b, shared = a + k * same, b + k * same, shared + k * same
    in_a, in_b, text = np.minimum(a, n - 1), np.minimum(b, n - 1), text_of[sa[1:][near]]
    shared += (a < n) & (b < n) & (words[in_a] == words[in_b]) & (text_of[in_a] == text) & (text_of[in_b] == text)
    lcp[near + 1] = shared
    return sa, lcp


def covered_words(sa: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word whether a repeat of `least` words or more covers it, and the longest repeat that begins there.

    A suffix's deepest interval has the larger of its two neighbouring common prefixes; the union of these spans is
    the union over all maximal repeats.
    """
    n = len(sa)
    deepest = np.maximum(lcp, np.append(lcp[1:], 0))
    longest = np.zeros(n, np.int64)
    longest[sa] = np.where(deepest >= least, deepest, 0)
    begins = np.flatnonzero(longest)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + longest[begins], -1)
    return np.cumsum(edge[:-1]) > 0, longest


def maximal_repeats(text: str | None, least: int = 5) -> list[tuple[int, list[int]]]:
    """(words, first words of the occurrences) of the maximal repeats of a text, from its common-prefix intervals.

    An interval is a repeat that no word to the right extends; it is maximal if its occurrences have different words (or
    the beginning) on their left.
    """
    data, offsets = raw(pa.array([text], pa.string()))
    first, last, text_of = spans(data, offsets, IS_SPACE[data])
    words, _ = numbered(data, first, last)
    sa, lcp = suffix_array(words, text_of)
    out, stack = [], []  # (words shared, place where the interval begins)
    for place in range(len(sa) + 1):
        now = int(lcp[place]) if 0 < place < len(sa) else 0
        begin = place - 1
        while stack and stack[-1][0] > now:
            shared, begin = stack.pop()
            at = sorted(int(x) for x in sa[begin:place])
            if len({words[x - 1] if x else None for x in at}) > 1:
                out.append((shared, at))
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, begin))
    return sorted(out, key=lambda x: (-x[0], x[1]))


def measures(column: pa.Array, limits: Limits = Limits()) -> dict[str, np.ndarray]:
    """The measures of each text, as arrays by name; null is an empty text."""
    data, offsets = raw(column)
    n = len(column)
    first, last, text_of = spans(data, offsets, IS_SPACE[data])
    words, _ = numbered(data, first, last)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    chars = points[last] - points[first]

    def per_text(of: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of, values, minlength=n).astype(np.int64)

    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOLS[data], out=symbols[1:])
    a, b, line_text = spans(data, offsets, data == 10)
    filled = np.searchsorted(first, b) > np.searchsorted(last, a, "right")  # a word lies in it
    a, b, line_text = a[filled], b[filled], line_text[filled]
    lines, _ = numbered(data, a, b)
    key = line_text * (len(lines) + 1) + lines
    once = np.unique(key, return_index=True)[1]
    again = np.ones(len(key), bool)
    again[once] = False
    sa, lcp = suffix_array(words, text_of)
    five, _ = covered_words(sa, lcp, 5)
    covered, longest = (five, _) if limits.least_words == 5 else covered_words(sa, lcp, limits.least_words)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text_of[longest > 0], longest[longest > 0])
    out = {
        "n_words": per_text(text_of),
        "word_chars": per_text(text_of, chars),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": per_text(line_text[again]),
        "n_repeat_words": per_text(text_of[five]),
        "covered_chars": per_text(text_of[covered], chars[covered]),
        "longest_repeat": top,
    }
    out["base_failed"] = (out["n_words"] < 10) | (100 * out["n_repeat_words"] > 20 * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["covered_chars"] <= limits.covered * out["word_chars"]) & (top <= limits.longest_words)
    return out


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """A row of measures and the verdict `kept` for each row of docs; no shuffle.

    Null and empty texts have no words: base_failed, not kept.  Repeated rows give repeated rows, a null id stays null,
    an empty table gives an empty one, other columns are not read.  Lines are what \\n separates.  An id_col called like a
    measure keeps its name, and the measure gets an underscore behind.  A text is held whole, with some numbers for each of
    its words and one more for each doubling of its longest repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = measures(part.column(1), limits)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, found.values())], ["id", *found])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars", "longest_repeat"]
    schema = f"id {dict(rows.dtypes)['id']}, {', '.join(f'{c} bigint' for c in counts)}, base_failed boolean, kept boolean"
    return named(rows.mapInArrow(trimmed(run), schema), id=id_col)


def op1_repetition(spark, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents"))


#: The same in DuckDB SQL.  Two equal windows of five words are a pair on the diagonal of their distance; the longest run of
#: neighbouring pairs on a diagonal, and four words, is the longest repeat.
SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS i FROM l),
g AS (SELECT doc_id, i, list_value(w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p) AS five, lead(w, 4) OVER p IS NOT NULL AS whole FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, five FROM g WHERE whole GROUP BY ALL HAVING count(*) > 1),
m AS (SELECT g.doc_id, g.i, g.five FROM g JOIN r ON g.doc_id = r.doc_id AND g.five = r.five WHERE g.whole),
hit AS (SELECT DISTINCT doc_id, i + k AS i FROM m, (SELECT unnest([0, 1, 2, 3, 4]) AS k)),
cov AS (SELECT doc_id, count(*) AS n, sum(length(w)) AS chars FROM hit JOIN w USING (doc_id, i) GROUP BY doc_id),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS delta FROM m a JOIN m b ON a.doc_id = b.doc_id AND a.five = b.five AND a.i < b.i),
runs AS (SELECT doc_id, delta, i - row_number() OVER (PARTITION BY doc_id, delta ORDER BY i) AS run FROM pairs),
top AS (SELECT doc_id, max(n) + 4 AS longest FROM (SELECT doc_id, delta, run, count(*) AS n FROM runs GROUP BY ALL) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM l),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(cov.chars, 0) AS BIGINT) AS covered_chars, CAST(coalesce(top.longest, 0) AS BIGINT) AS longest_repeat
  FROM l LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN top USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND covered_chars <= 0.2 * word_chars AND longest_repeat <= 50 AS kept FROM f"""
