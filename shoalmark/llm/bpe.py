"""BPE encoding and decoding by forced-boundary splitting, equal to the tokenizer's own encoding.

A merge only makes tokens of the vocabulary, so between two bytes that stand beside each other in no token every encoding
has a cut.  Words are split there, the fragments are encoded independently by the tokenizer's merges, and the ids are
concatenated.  Cuts before the last byte of a word use the tokens that end words only.

The tokenizer file is one of the `tokenizers` library: NFC, white space, lower case; a split into words; byte-level
characters; merges with an end-of-word suffix.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, numbered, raw, slices, small_batches, table, trimmed

#: Words whose encoding a worker remembers.
MOST_WORDS = 200_000
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# Endings that an apostrophe takes along, in the order in which they are tried.
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
# Code points of white space.
WHITE = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(1)
def _classes() -> np.ndarray:
    """SPACE, LETTER, NUMBER or OTHER of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    out[list(WHITE)] = SPACE
    # Code points that this Python doesn't know yet may be letters or numbers to the tokenizer's newer tables.
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    unknown = " ".join(chr(i) for i in range(0x32400) if unicodedata.category(chr(i)) == "Cn")
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        for piece, _ in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(unknown):
            out[ord(piece)] = kind
    return out


@lru_cache(1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _normal(text: str) -> str:
    """NFC and lower case; the lower case of a letter doesn't depend on its place."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ")
    return text.lower()


class Codec:
    """The encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores already
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        # What this encoder doesn't do isn't passed over.
        odd = [x["content"] for x in spec["added_tokens"] if x.get("single_word") or x.get("lstrip") or x.get("rstrip") or x.get("normalized")]
        if odd or spec.get("decoder") or model["type"] != "BPE" or not self.suffix:
            raise ValueError(f"not a tokenizer of the kind that this encoder is for (special tokens with flags: {odd})")
        self.split_special = re.compile("|".join(f"({re.escape(x)})" for x in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.tokens = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, i in (self.ids | self.special).items():
            self.tokens[i] = token
        self.inner = Tokenizer(models.BPE(self.ids, merges))
        self.final = Tokenizer(models.BPE(self.ids, merges, end_of_word_suffix=self.suffix))
        self.characters = byte_characters()
        self.by_byte = dict(enumerate(self.characters))
        self.within, self.at_end = self._pairs()
        self.known: dict[bytes, bytes] = {}  # the ids as 32-bit integers

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs of bytes stand side by side inside a token, and which do at the end of a token that ends words."""
        byte = {c: b for b, c in enumerate(self.characters)}
        within, at_end = np.zeros((256, 256), bool), np.zeros((256, 256), bool)
        for token in self.ids:
            ends = token.endswith(self.suffix)
            octets = [byte[c] for c in (token[: -len(self.suffix)] if ends else token) if c in byte]
            for a, b in zip(octets, octets[1:]):
                within[a, b] = True
            if ends and len(octets) > 1:
                at_end[octets[-2], octets[-1]] = True
        return within, at_end

    def fragments(self, word: bytes) -> list[bytes]:
        """The parts of a word between its forced cuts."""
        a = np.frombuffer(word, np.uint8)
        joined = self.within[a[:-1], a[1:]]
        if len(joined):
            joined[-1] &= self.at_end[a[-2], a[-1]]
        cuts = [0, *(np.flatnonzero(~joined) + 1).tolist(), len(word)]
        return [word[x:y] for x, y in zip(cuts, cuts[1:])]

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words in a row, and how many each has."""
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        listed = words.to_pylist()
        new = [w for w in listed if w not in self.known]
        if new:
            size = np.array([len(w) for w in new])
            data = np.frombuffer(b"".join(new), np.uint8)
            end = np.cumsum(size)
            cut = np.append(~self.within[data[:-1], data[1:]], True)
            last_pair = end[size > 1] - 2
            cut[last_pair] |= ~self.at_end[data[last_pair], data[last_pair + 1]]
            cut[end - 1] = True
            stop = np.flatnonzero(cut) + 1
            start = np.concatenate([[0], stop[:-1]])
            text = data.tobytes().decode("latin-1").translate(self.by_byte)
            pieces = [text[a:b] for a, b in zip(start.tolist(), stop.tolist())]
            is_final = np.isin(stop, end)
            found = [b""] * len(pieces)
            for final, coder in ((True, self.final), (False, self.inner)):
                at = np.flatnonzero(is_final == final).tolist()
                for i, e in zip(at, coder.encode_batch([pieces[i] for i in at], add_special_tokens=False) if at else ()):
                    found[i] = array("i", e.ids).tobytes()
            k = 0
            for w, n in zip(new, np.diff(np.flatnonzero(np.append(True, is_final))).tolist()):
                self.known[w] = found[k] if n == 1 else b"".join(found[k : k + n])
                k += n
        ids = [self.known[w] for w in listed]
        return np.frombuffer(b"".join(ids), np.int32), np.array([len(x) for x in ids], np.int64) // 4

    def _plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens in a row, and the offsets of the texts."""
        data, offsets = raw(pa.array(map(_normal, column.to_pylist()), pa.large_string()))
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(column) + 1, np.int64)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        kind = _classes()[points]
        first_of_text = np.zeros(len(lead) + 1, bool)
        text_at = np.searchsorted(lead, offsets)
        first_of_text[text_at] = True
        begins = first_of_text[:-1] | (kind == NUMBER)
        begins[1:] |= kind[1:] != kind[:-1]
        # An apostrophe alone takes along one of the endings of the letters behind it.
        quote = np.flatnonzero((points == 39) & begins)
        quote = quote[quote + 1 < len(points)]
        quote = quote[(kind[quote + 1] == LETTER) & begins[quote + 1] & ~first_of_text[quote + 1]]
        if len(quote):
            for q in quote.tolist():
                here = data[lead[q] + 1 : lead[q] + 3].tobytes()
                end = next((len(e) for e in ENDINGS if here.startswith(e) and not first_of_text[q + 1 : q + 1 + len(e)].any()), 0)
                if end:
                    begins[q + 1] = False
                    if q + 1 + end < len(points):
                        begins[q + 1 + end] = True
        at = np.flatnonzero(begins)
        first = lead[at]
        last = np.append(first[1:], len(data))
        word = kind[at] != SPACE
        first, last = first[word], last[word]
        words, distinct = numbered(data, first, last)
        ids, lengths = self._encode_words(distinct)
        begin = np.cumsum(lengths) - lengths
        n = lengths[words]
        total = np.zeros(len(words) + 1, np.int64)
        np.cumsum(n, out=total[1:])
        out = ids[np.repeat(begin[words] - total[:-1], n) + np.arange(total[-1])]
        return out, total[np.searchsorted(first, offsets)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the n + 1 offsets of the texts; null is an empty text."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if not self.special or not pc.any(pc.match_substring_regex(column, "|".join(map(re.escape, self.special)))).as_py():
            return self._plain(column)
        parts, owner, special = [], [], []
        for i, text in enumerate(column.to_pylist()):
            for x in self.split_special.split(text):
                if x:
                    special.append(self.special.get(x, -1))
                    parts.append("" if special[-1] >= 0 else x)
                    owner.append(i)
        ids, at = self._plain(pa.array(parts, pa.large_string()))
        pieces = [ids[a:b] if s < 0 else np.array([s], np.int32) for a, b, s in zip(at[:-1], at[1:], special)]
        offsets = np.zeros(len(column) + 1, np.int64)
        np.cumsum(np.bincount(owner, [len(x) for x in pieces], minlength=len(column)).astype(np.int64), out=offsets[1:])
        return np.concatenate(pieces) if pieces else ids, offsets

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space, as the file names no decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>, decoded string) for each row of docs; no shuffle.

    Null and empty texts have no ids and an empty decoded text.  Repeated rows give repeated rows, a null id stays null,
    an empty table gives an empty one, other columns are not read.  path: a file that every executor has.  An id_col called
    like a result keeps its name, and the result gets an underscore behind.  A text is held whole, with some twenty bytes for
    each of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                ids, offsets = coder.encode(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                texts = [coder.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return named(rows.mapInArrow(trimmed(run), f"id {dict(rows.dtypes)['id']}, ids array<int>, decoded string"), id=id_col)


def encode_rows(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns `keep`, ids array<int> and decoded string for each row of docs; nulls and empty texts as in `encode`."""
    kept = len(keep)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                ids, offsets = coder.encode(part.column(kept))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                texts = [coder.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], lists, pa.array(texts, pa.string())], [*keep, "ids", "decoded"])

    rows = docs.select(*keep, F.col(text_col).alias("text"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(trimmed(run), ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "ids array<int>", "decoded string"]))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): what `encode` gives, digested before it leaves the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        decimal = [str(i) for i in range(len(coder.tokens))]
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                ids, offsets = coder.encode(part.column(1))
                of_ids, of_text = [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    listed = ids[a:b].tolist()
                    of_ids.append(sha256(" ".join([decimal[i] for i in listed]).encode()).hexdigest())
                    of_text.append(sha256(coder.decode(listed).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets)), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return named(rows.mapInArrow(trimmed(run), f"id {dict(rows.dtypes)['id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"), id=id_col)


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
