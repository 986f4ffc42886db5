"""Token counts, conversation repair and the filter audit against brute-force versions, and on their edge cases."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoalmark.llm import conversations, filter_audit, registry, token_counts
from shoalmark.llm.common import table

LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(30000))


# 11


def library(path, texts):
    if path.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    from tokenizers import Tokenizer

    return [len(x.ids) for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


ODD_TEXTS = ["", " ", "one two  three\n", "one two  three\n", "<|endoftext|> and <|endoftext|>", "½ 漢字 Καλημέρα привет 'll don't", "a" * 3000, LONG, "x <|endoftext", "﻿  　", None]


@pytest.fixture
def odd(spark):
    rows = [(i if i != 4 else None, t, "x", "y") for i, t in enumerate(ODD_TEXTS)] + [(1, "another text of id 1", "x", "y"), (3, ODD_TEXTS[3], "x", "y")]
    return spark.createDataFrame(rows, "n_bytes bigint, text string, digest string, id string")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, odd, tmp_path, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    out = token_counts.token_counts(odd, path, str(tmp_path / "cache"), id_col="n_bytes")
    assert out.columns == ["n_bytes", "n_bytes_", "n_tokens", "digest"]
    rows = [r.text or "" for r in odd.collect()]
    want = sorted(zip((r.n_bytes or -1 for r in odd.collect()), (len(t.encode()) for t in rows), library(path, rows), (sha256(t.encode()).hexdigest() for t in rows)))
    assert sorted((-1 if r[0] is None or r[0] == 0 else r[0], *r[1:]) for r in out.collect()) == want


def test_only_distinct_misses_are_encoded(spark, tmp_path):
    import public_tokenizers

    path, cache = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    at = f"{cache}/tokenizer={token_counts.tokenizer_version(path)}"
    first = spark.createDataFrame([(i, f"text {i % 5}") for i in range(50)], "doc_id int, text string")
    got = token_counts.token_counts(first, path, cache).collect()
    assert len(got) == 50 and spark.read.parquet(at).count() == 5
    more = spark.createDataFrame([(i, f"text {i % 7}") for i in range(50)], "doc_id int, text string")
    token_counts.token_counts(more, path, cache).collect()
    assert spark.read.parquet(at).count() == 7
    # A stored count is taken as it is: nothing is encoded again, and a digest that stands twice counts once.
    spark.read.parquet(at).withColumn("n_tokens", F.lit(99).cast("long")).write.mode("append").parquet(at)
    files = spark.read.parquet(at).inputFiles()
    again = token_counts.token_counts(more, path, cache).collect()
    assert {r.n_tokens for r in again} == {99} and len(again) == 50 and spark.read.parquet(at).inputFiles() == files
    # Another version of the tokenizer has counts of its own.
    other = public_tokenizers.path("word_bpe_49k.json")
    assert {r.n_tokens for r in token_counts.token_counts(more, other, cache).collect()} != {99}


def test_normal_texts_share_a_count(spark, tmp_path):
    import public_tokenizers

    path, cache = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "A text"), (2, " A text "), (3, None)], "doc_id int, text string")
    got = token_counts.token_counts(docs, path, cache, normal=lambda t: F.trim(F.coalesce(t, F.lit("")))).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == [(1, 6, 2), (2, 6, 2), (3, 0, 0)]


def test_parts_of_a_long_text():
    import public_tokenizers

    rng = random.Random(3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    for _ in range(60):
        text = "".join(rng.choice(["word", " ", "  ", "\n", "é", "'s", "12", "!", " the", "<|endoftext|>", "\t"]) for _ in range(200))
        parts = token_counts.in_parts(text, 20)
        assert "".join(parts) == text
        assert sum(library(path, parts)) == library(path, [text])[0]
    assert len(token_counts.in_parts(LONG, 1000)) > 100 and token_counts.in_parts("x" * 5000, 1000) == ["x" * 5000]
    big = "a word and another " * 70_000
    assert token_counts.counter(path)([big, "two words"]) == library(path, [big, "two words"])


def test_token_counts_of_an_empty_table(spark, tmp_path):
    import public_tokenizers

    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "c")).collect() == []


def test_op11_over_its_table(spark, sf_dir):
    import public_tokenizers

    rows = registry.QUERIES["op11_token_counts"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    counts = dict(zip(texts, library(public_tokenizers.path("byte_bpe_50k.json"), list(texts.values()))))
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {(i, len(t.encode()), counts[i], counts[i] > 512) for i, t in texts.items()}
    assert len(rows) == len(texts)


# 12


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """The cheapest edits by trying all: (cost, audit, repaired turns)."""
    faults, best = plain_faults(rows), [(2 * len(rows), "D" * len(rows), [])]
    ok, so_far = re.compile(r"(s?(ua)+)?"), re.compile(r"(s?(ua)*u?)?")

    def go(i, cost, audit, turns, inserted):
        initials = "".join(r[:1] for r, _ in turns)
        if cost > best[0][0] or not so_far.fullmatch(initials):
            return
        if i == len(rows) and ok.fullmatch(initials):
            best.append((cost, audit, turns))
            best.sort(key=lambda x: x[:2])
        if inserted < 2:
            for r in ("user", "assistant"):
                go(i, cost + 5, audit + "I", [*turns, (r, "")], inserted + 1)
        if i < len(rows):
            go(i + 1, cost + 2, audit + "D", turns, 0)
            if faults[i] in "t-":
                more = 5 * (faults[i] == "t")
                go(i + 1, cost + more, audit + "K", [*turns, rows[i]], 0)
                for r in ("user", "assistant"):
                    go(i + 1, cost + more + 1, audit + "R", [*turns, (r, rows[i][1])], 0)

    go(0, 0, "", [], 0)
    return best[0]


def batch(groups, piece=conversations.PIECE):
    flat = [(c, *r) for c, rows in enumerate(groups) for r in rows]
    import numpy as np

    con = duckdb.connect()
    columns = (pa.array([r[i] for r in flat], pa.int64() if i == 1 else pa.string()) for i in (1, 2, 3))
    return conversations.repair_batch(con, np.array([r[0] for r in flat], dtype=np.int64), *columns, n=len(groups), piece=piece)


def test_repair_is_the_cheapest():
    rng = random.Random(5)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", " "], ["Yes.", "No.", "", " \n", "cut", "Why? ", "x.", "y!", "z"]
    groups = [[(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(0, 5))] for _ in range(150)]
    got = batch([[(i, *r) for i, r in enumerate(g)] for g in groups])
    for c, g in enumerate(groups):
        cost, audit, turns = plain_repair(g)
        assert (got["cost"][c], got["audit"][c]) == (cost, audit), g
        assert [(t["role"], t["text"]) for t in got["turns"][c]] == turns
        faults = plain_faults(g)
        assert [got[k][c] for k in ("blank", "duplicate", "truncated")] == [faults.count(x) for x in "bdt"]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(g, g[1:])]
        assert got["illegal"][c] == sum(p not in ("su", "ua", "au") for p in pairs)


@pytest.mark.parametrize("piece", [1, 2, 7])
def test_pieces_give_the_same_repair(piece):
    rng = random.Random(6)
    groups = [[(i, rng.choice(["system", "user", "assistant", "other"]), rng.choice(["A.", "B?", "", "cut", f"text {i}."])) for i in range(rng.choice([0, 1, 2, 5, 30]))] for _ in range(60)]
    assert batch(groups, piece) == batch(groups)


CONV = "conv_id bigint, turn bigint, role string, text string, gaps string, id int"


def test_repair_of_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 5, "user", "So?"), (1, 6, "assistant", "No."),
        (2, None, "user", "First."), (2, 3, None, None), (2, 3, None, None), (None, 0, "user", "No id."), (None, 1, "assistant", "None."), (3, None, None, None),
        *((4, i, ["user", "assistant"][i % 2], f"Turn {i}. " + "long " * 50 + "end.") for i in range(2500)),
    ]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], CONV)
    got = {r.conv_id: r for r in conversations.repaired(docs).collect()}
    assert set(got) == {1, 2, 3, 4, None} and len(got) == 5
    assert got[1].asDict(recursive=True) == {"conv_id": 1, "gaps": 3, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "KKKK", "turns": [{"role": r[2], "text": r[3]} for r in rows[:4]]}
    assert (got[2].gaps, got[2].blank, got[2].audit, got[2].cost, got[2].illegal) == (0, 2, "DDD", 6, 2)
    assert (got[None].audit, got[3].audit, got[3].blank, got[3].gaps, got[3].turns) == ("KK", "D", 1, 0, [])
    assert got[4].audit == "K" * 2500 and len(got[4].turns) == 2500
    assert conversations.repaired(docs, conv_col="gaps").columns[:2] == ["gaps", "gaps_"]
    assert conversations.repaired(docs.limit(0)).collect() == []


def plain_op12(rows):
    by = {}
    for conv, turn, role, text in rows:
        out = by.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    for conv, out in by.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {r[0] for r in out} - {None}
        cost, audit, fixed = plain_repair([r[1:] for r in out])
        faults, pairs = plain_faults([r[1:] for r in out]), [a[1][:1] + b[1][:1] for a, b in zip(out, out[1:])]
        yield (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(x) for x in "bdt"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())


def test_op12_of_nulls_repeats_and_dropped_conversations(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", "system", None, "users"]), rng.choice(["One.", "Two?", "", None, "cut", "é."])) for _ in range(160)]
    rows = [r for r in rows if zlib.crc32(f"{r[0]}:{r[1]}".encode())][:160] + [(100 + i, 0, "user", "Alone.") for i in range(60)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = registry.QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(plain_op12(rows), key=key)
    assert sorted(map(tuple, got.collect()), key=key) == want
    assert any(r[7] == "" and r[8] == sha256(b"").hexdigest() for r in want)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(con.sql(registry.ORACLE_SQL["op12_conversation_repair"]).select(*[duckdb.ColumnExpression(c) for c in got.columns]).fetchall(), key=key) == want


# 13


def plain_audit(docs, labels):
    masks = []
    for i, text, lang in docs:
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        m = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        m["E"] = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        good, toxic = (any(i is not None and r[0] == i and r[k] == 1 for r in labels) for k in (1, 2))
        masks.append((lang or "", {f for f, x in m.items() if x}, good, toxic))
    out = []
    for part in {m[0] for m in masks}:
        mine = [m[1:] for m in masks if m[0] == part]
        removed = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            for k, f in enumerate(order):
                first = [m for m in mine if f in m[0] and not m[0] & set(order[:k])]
                removed[order, k] = first
        for (order, k), first in removed.items():
            f, before = order[k], set(order[:k])
            kept = sum(not m[0] & {f, *before} for m in mine)
            redundant = sum(f in m[0] and bool(m[0] & before) for m in mine)
            shapley = sum(len(x) for (o, j), x in removed.items() if o[j] == f)
            out.append((part, order, k + 1, f, kept, len(first), redundant, sum(m[0] == {f} for m in mine), sum(m[1] for m in first), sum(m[2] for m in first), shapley))
    return sorted(out)


def audit_rows():
    rng = random.Random(9)
    base = [" ".join(rng.choice(["a", "B", "word", "Q#", "é"]) + str(rng.randint(0, n)) for _ in range(n)) for n in (0, 3, 99, 100, 101, 140, 900, 3000)]
    base += [base[-1][:-1] + "z", base[-1][:600] + "ß" + base[-1][601:], "THE CAPITALS " * 60]
    docs = [(rng.choice([None, *range(40)]), rng.choice([*base, None]), rng.choice(["en", "de", None, ""])) for _ in range(70)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 40, 2)] + [(4, 1, 1), (None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(2)), lambda c: F.length(c).cast("long")], ids=["whole", "two values", "lengths"])
def test_audit(spark, hashed):
    """Whatever the block hashes are, only equal texts are copies."""
    docs, labels = audit_rows()
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id bigint, text string, lang string, mask int, key string")
    l = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(d, l, hashed=hashed)
    columns = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == plain_audit(docs, labels)
    if hashed is F.xxhash64:
        con = duckdb.connect()
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
        con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
        assert sorted(con.sql(registry.ORACLE_SQL["op13_filter_audit"]).select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()) == plain_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id bigint, text string, lang string"), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, LONG, "en"), (2, LONG, "en"), (None, None, None)], docs.schema)
    rows = filter_audit.audit(one, labels).collect()
    assert len(rows) == 1200 and {r.good_lost for r in rows} == {0}
    assert {(r.part, r.removed, r.unique_fails, r.shapley) for r in rows if r.filter_order == "EABCD" and r.step == 1} == {("en", 1, 0, 60), ("", 0, 0, 0)}


def test_blocks_cover_texts(spark):
    """A change of the last code point changes the last block's hash at every length around the blocks' ends."""
    sizes = [0, 1, 511, 512, 513, 2559, 2560, 2561, 10751, 10752, 10753, 43521]
    rows = [(n, ("é" * n)) for n in sizes] + [(n, "é" * (n - 1) + "x") for n in sizes if n]
    d = spark.createDataFrame(rows, "n int, text string").select("n", filter_audit.block_hashes(F.col("text"), F.xxhash64).alias("b"))
    by = {}
    for r in d.collect():
        by.setdefault(r.n, []).append(r.b)
    for n, found in by.items():
        assert n == 0 and found == [[]] or len(found[0]) == len(found[1]) and found[0][:-1] == found[1][:-1] and found[0][-1] != found[1][-1]
