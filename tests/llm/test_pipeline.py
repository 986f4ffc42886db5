"""The pipeline's stages on their own inputs against plain versions."""

import math
import re

import corpus_pipeline as cp
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from test_operators import plain_components, plain_fingerprint, slow_path

from shoalmark.llm import language_id, mixing, quality_cnn, simhash_dedup
from shoalmark.llm.common import crc_mod, table, training_rows, written


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    network = quality_cnn.learn(training_rows(docs.select("doc_id", "text"), labels, quality_cnn.Fit.rows).select("text", "label"))
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup", "mixing", "BPE encoding"]
    one = written(stages["quality classifier"](spark, docs, sf_dir))
    assert sorted(r.doc_id for r in one.collect()) == sorted(r.doc_id for r in quality_cnn.quality(docs, network).where("predicted = 1").collect())
    two = written(stages["language ID"](spark, one, sf_dir))
    model = language_id.learn(docs.where(crc_mod("doc_id", 4) != 2).select("text", "lang"))
    assert sorted(r.doc_id for r in two.collect()) == sorted(r.doc_id for r in language_id.detect(one, model).where("lang_pred <> 'und' AND score >= 0.1").collect())
    three = written(stages["SimHash near-dedup"](spark, two, sf_dir))
    assert sorted(r.doc_id for r in three.collect()) == sorted({r.component_id for r in simhash_dedup.near_duplicates(two).collect()})
    four = written(stages["mixing"](spark, three, sf_dir))
    rated = mixing.rated(three, mixing.labelled_domains(spark, sf_dir), weights=mixing.TARGETS)
    assert four.count() == rated.agg(F.sum("copies")).first()[0]
    assert one.columns == two.columns == three.columns == four.columns == docs.columns
    five = stages["BPE encoding"](spark, four, sf_dir)
    assert five.count() == four.count() and five.where("n_tokens <> size(ids)").count() == 0


def test_empty_and_odd_documents(spark, sf_dir):
    none = table(spark, sf_dir, "documents").where("false")
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "s", 0), (2, "the of and to in is it was", "en", "s", 3), (2, "the of and to in is it was", "en", "s", 3)], none.schema)
    for docs in (none, odd):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= 8


def test_language_stage_rejects_unclear_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    by = {r.lang: " ".join(r.text.split()) for r in docs.where("length(text) BETWEEN 2000 AND 20000").orderBy("doc_id").collect()}
    parts = [by[k][300:900] for k in sorted(by)]
    foreign = ["kokeilen suomen kielta taalla metsassa ja jarvella huomenna aamulla " * 5, "qzx vbn wrtk plmkj zzxq hgfd wqpt " * 10, "привет как дела сегодня у нас хорошая погода " * 5]
    go = [" ".join(parts), " ".join(parts[::-1]), *foreign]
    stay = [*parts, f"{parts[0]} {parts[1][:500]}"]
    rows = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in enumerate(go + stay)], docs.schema)
    kept = dict(cp.STAGES)["language ID"](spark, rows, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(len(go), len(go) + len(stay)))
    # Where learned rows quote at length, a text of many languages that opens in one of them still goes.
    model = language_id.learn(docs.select("text", "lang"), opening=0.25, least=-100.0)
    assert language_id.clear(pa.array([" ".join(parts), " ".join(parts[1:]), f"{parts[0][:400]} {parts[1]}"]), model).tolist() == [False, False, True]
    # Its own rows stay, whatever the share of their language.
    lettered = docs.where(F.col("text").rlike("[A-Za-z]"))
    assert dict(cp.STAGES)["language ID"](spark, lettered, sf_dir).count() >= 0.99 * lettered.count()


def test_last_stage_decodes(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents").limit(60)
    rows = docs.unionByName(spark.createDataFrame([(-1, None, None, "s", 0), (-2, "", None, "s", 0), (-3, "Aé 中 x<|endoftext|>", None, "s", 0)], docs.schema))
    text = {r.doc_id: r.text or "" for r in rows.collect()}
    out = cp.STAGES[-1][1](spark, rows, sf_dir).collect()
    assert len(out) == len(text) == 63
    for r in out:
        assert r.decoded == whole.decode(whole.encode(text[r.doc_id], add_special_tokens=False).ids, skip_special_tokens=False)


def plain_quality(net, text):
    b, sums, at = text.encode() if text else b"", [], 0
    while True:
        x = net.vectors[np.frombuffer(b[at : at + quality_cnn.CHUNK].ljust(quality_cnn.CHUNK, b"\0"), np.uint8)]
        best = np.max([x[i : i + quality_cnn.WIDTH].reshape(-1) @ net.filters for i in range(0, quality_cnn.CHUNK - quality_cnn.WIDTH + 1, quality_cnn.STRIDE)], axis=0)
        sums.append(float(np.maximum(best + net.bias, 0) @ net.weights))
        if at + quality_cnn.CHUNK >= len(b):
            return 1 / (1 + math.exp(-(sum(sums) / len(sums) + net.offset)))
        at += quality_cnn.STEP


def plain_clear(model, text):
    """Word by word: the languages of its words by a plain Viterbi, their shares of the bytes, and the rules of a clear language."""
    words = re.findall(r"[^\x00-@\[-`{-\x7f]+", (text or "").lower())
    if not words or not any(map(str.isalpha, text)):
        return False
    logs, grams = zip(*(tuple(x[0] for x in language_id.word_logs(pa.array([w.encode()], pa.large_binary()), model)) for w in words))
    scores = []
    for w, log in zip(words, logs):
        may = model.scripts[language_id.script_of(pa.array([w.encode()], pa.large_binary()))[0]]
        log = np.where(may if may.any() else True, log, -np.inf)
        scores.append(np.maximum(log - log.max(), -model.clip))
    path = slow_path(np.array(scores), model.penalty)
    share = np.bincount(path, [len(w.encode()) for w in words], minlength=len(model.languages))
    opens, total = path[0], share.sum()
    spans = [k for i, k in enumerate(path) if not i or path[i - 1] != k]
    frames = [(spans.count(k) if share[k] >= language_id.PART * total else 0, share[k]) for k in range(len(share))]
    best = opens if share[opens] >= model.opening * total else max(range(len(share)), key=lambda k: frames[k])
    second = max((s for k, s in enumerate(share) if k != best), default=0)
    held = share[best] >= 0.5 * total or best == opens and share[best] >= model.opening * total and share[best] + second >= language_id.PAIR * total
    return bool(held and sum(log[best] for log in logs) / sum(grams) >= model.least)


def spark_hash(*values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_mixture(model, rows, weights):
    """Posteriors, rates and copies of (doc_id, text) row by row."""
    fit, p, n = model.fit, [], []
    for _, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
        buckets = [spark_hash(w) % fit.buckets for w in words]
        s = np.array([0.0, *(sum(row[b] for b in buckets) for row in model.odds)])
        s = s * model.scale + np.log(model.shares)
        e = np.exp(s - s.max())
        p.append(e / e.sum())
        n.append(len(words))
    p, n = np.array(p), np.array(n, float)
    own = (p * n[:, None]).sum(axis=0)
    target = own.sum() * np.array([weights.get(d, 0.0) for d in model.domains]) / sum(weights.get(d, 0.0) for d in model.domains)
    rate, reached = np.ones(len(rows)), own
    for _ in range(500):
        if np.abs(reached - target).max() <= 1e-4 * own.sum():
            break
        rate = np.maximum(0, rate - p @ ((reached - target) / own))
        now = (p * (n * rate)[:, None]).sum(axis=0)
        settled, reached = np.abs(now - reached).sum() <= 1e-6 * own.sum(), now
        if settled:
            break
    u = [spark_hash(int(k).to_bytes(8, "little", signed=True), t, (11).to_bytes(4, "little")) % (1 << 30) / (1 << 30) for k, t in rows]
    return [int(r) + (x < r - int(r)) for r, x in zip(rate, u)]


def test_run_by_brute_force(spark, sf_dir, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = table(spark, sf_dir, "documents").where("length(coalesce(text, '')) < 1500").orderBy("doc_id").limit(90)
    extra = [(9001, None, None, "s", None), (9002, "", "en", "s", 0), (9003, "123 456 ½", None, "s", 9)]
    few = docs.collect()
    extra += [(9100 + i, d.text, d.lang, d.source, d.n_chars) for i, d in enumerate(few[:6])]
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, sf_dir, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    at = str(tmp_path)
    rows = table(spark, at, "documents").collect()
    labels = table(spark, at, "labels").where(crc_mod("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    net = quality_cnn.learn(training_rows(table(spark, at, "documents").select("doc_id", "text"), labels, quality_cnn.Fit.rows).select("text", "label", "weight"))
    one = [r for r in rows if plain_quality(net, r.text) >= 0.3]
    model = language_id.learn(table(spark, at, "documents").where(crc_mod("doc_id", 4) != 2).select("text", "lang"), language_id.Fit(opens=True))
    two = [r for r in one if plain_clear(model, r.text)]
    roots = plain_components([r.doc_id for r in two], [plain_fingerprint(r.text) for r in two])
    three = [r for r, k in zip(two, roots) if r.doc_id == k]
    assert len(rows) > len(one) > len(three) > 20 and len(two) > len(three)
    classifier = mixing.learn(mixing.labelled_domains(spark, at))
    copies = plain_mixture(classifier, [(r.doc_id, r.text) for r in three], mixing.TARGETS)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r, n in zip(three, copies):
        ids = whole.encode(r.text, add_special_tokens=False).ids
        want += [(r.doc_id, r.source, ids, whole.decode(ids, skip_special_tokens=False), len(ids))] * n
    got = [(r.doc_id, r.source, r.ids, r.decoded, r.n_tokens) for r in cp.run(spark, at).select("doc_id", "source", "ids", "decoded", "n_tokens").collect()]
    assert sorted(got) == sorted(want) and 0 < len(want) != len(three)
