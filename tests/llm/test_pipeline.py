"""The pipeline's stages on a small input."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from test_native import plain_base, plain_redacted
from test_similar import plain_kept
from test_suffix import plain as plain_repeats

import corpus_pipeline
from coevo.llm import importance, registry

DIR = "/root/testdata/sf0.01"


SMALL = "/root/testdata/sf0.001"


def plain_ngrams(text):
    """Hash buckets of a text's n-grams, by plain Python."""
    import xxhash

    h = lambda w: xxhash.xxh64_intdigest(w)
    words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
    out = []
    for k, w in enumerate(words):
        out += [h(w), 12345 if k and words[k - 1] == w else h("\0" + importance.word_class(w))]
        if k:
            pair = (h(words[k - 1]) * 0x9E3779B97F4A7C15 + h(w)) % 2**64
            out.append(pair ^ (pair >> 29))
    return Counter(x % importance.BUCKETS for x in out)


def plain_resampling(docs, labels, noise):
    """(log weights, kept) by doc_id: the ratio of two bags of n-grams, Gumbel noise, the k largest keys."""
    grams = {d: plain_ngrams(t) for d, t in docs.items()}
    raw, target = sum(grams.values(), Counter()), sum((grams[d] for d, q in labels.items() if q == 1 and d in grams), Counter())
    n, m = raw.total(), target.total()
    ratio = {b: math.log((target[b] / m + c / n) / 2) - math.log(c / n) for b, c in raw.items()}
    weights = {d: sum(c * ratio[b] for b, c in g.items()) for d, g in grams.items()}
    keys = {d: w - math.log(-math.log(noise[d])) for d, w in weights.items()}
    k = round(sum(labels.values()) / len(labels) * len(docs))
    least = sorted(keys.values())[-k]
    return weights, {d for d, x in keys.items() if x >= least - 1e-4}, min(abs(x - least) for x in keys.values() if x < least)


def small_inputs(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    noise = docs.select("doc_id", ((F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)).alias("u")).collect()
    return docs, labels, {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.quality for r in labels.collect()}, {r.doc_id: r.u for r in noise}


def test_resampling_like_brute_force(spark):
    docs, labels, texts, quality, noise = small_inputs(spark)
    weights, kept, gap = plain_resampling(texts, quality, noise)
    assert gap > 1e-3 and 0 < len(kept) < len(texts)
    got = registry.op5_importance_resampling(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        assert abs(r.log_weight - weights[r.doc_id]) < 1e-4 and r.kept == (r.doc_id in kept)
    assert {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, SMALL).collect()} == kept


def test_resampling_on_held_out_labels(spark):
    """Learned from two thirds of the labels, held to the others."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    got = importance.resample(docs.withColumn("key", F.lit(1)).withColumn("text_key", F.lit("x")), labels.where("doc_id % 3 <> 0"))
    assert got.count() == docs.count()
    rest = got.join(labels.where("doc_id % 3 = 0"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in rest}
    assert share[1] > 0.97 and share[0] < 0.05, share
    rows = importance.resample(docs, labels, k=300).collect()
    assert sum(r.kept for r in rows) == 300
    assert min(r.key for r in rows if r.kept) >= max(r.key for r in rows if not r.kept)


def test_resampling_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in importance.resample(edge_docs, labels).collect()}
    assert len(got) == edge_docs.count() and got[0].log_weight == 0 == got[1].log_weight
    assert importance.resample(no_docs, labels).collect() == []
    assert all(r.kept for r in importance.resample(edge_docs, labels.limit(0)).collect())
    assert importance.keep(no_docs, labels).columns == no_docs.columns


def test_rows_that_share_a_doc_id_are_judged_by_their_text(spark):
    good, bad = "the good text of a clean page goes on and on " * 20, "### $$$ %%% junk### spam$$$ " * 40
    rows = [(k, good + str(k), "x") for k in range(30)] + [(100 + k, bad + str(k), "x") for k in range(30)] + [(5, bad + "q", "x"), (None, bad + "r", "x"), (None, good, "x"), (7, good + "7", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_weight string")
    labels = spark.createDataFrame([(k, 1) for k in range(10)] + [(100 + k, 0) for k in range(10)], "doc_id long, quality int")
    kept = importance.keep(docs, labels, k=32)
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(left, key=repr) == sorted([(d, t) for d, t, _ in rows if t.startswith("the")], key=repr)


def test_top_k_threshold(spark):
    keys = spark.range(1000).select(((F.col("id") * 7919) % 1000 / 3.0).alias("key"))
    ordered = sorted((r.key for r in keys.collect()), reverse=True)
    for k in (1, 17, 999, 1000, 5000):
        assert importance.top_k_threshold(keys, k, 8) == ordered[min(k, 1000) - 1]
    assert importance.top_k_threshold(keys, 0) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = docs.columns
    before = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DIR)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == names
            assert out.count() <= before
        if name == "simhash_dedup":
            assert out.count() < docs.count()
        if name == "secret_scan":
            for r in out.collect():
                assert not plain_base(r.text.replace("[SECRET]", "\n"))
        docs = out
    assert docs.agg(F.countDistinct("doc_id")).first()[0] == spark.read.parquet(f"{tmp_path}/3").count()


def test_run_like_brute_force(spark):
    """Each stage's rows from plain Python, stage by stage, down to the packed pieces."""
    from tokenizers import Tokenizer

    docs, labels, texts, quality, noise = small_inputs(spark)
    _, kept, _ = plain_resampling(texts, quality, noise)
    rows = sorted((d, t) for d, t in texts.items() if d in kept)
    firsts, _ = plain_kept(rows)
    rows = [(d, t) for d, t in rows if d in set(firsts)]
    cut = {d: k.decode(errors="ignore") if t is not None else None for (d, t), (_, _, k) in zip(rows, plain_repeats(rows))}
    want = {d: plain_redacted(t) for d, t in cut.items()}
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SMALL)
        assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got.values())
    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    tokenizer.no_truncation()
    pieces, bins = {}, {}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        pieces[r.doc_id, r.piece] = (r.start, r.length, r.ids_crc32)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, t in want.items():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a:a + 4096], "<u4")
            assert pieces.pop((d, k)) == (a, len(part), zlib.crc32(part.tobytes()))
    assert not pieces
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 4096


def test_stages_on_edges(spark, edge_docs, no_docs):
    twice = edge_docs.unionByName(edge_docs.where("doc_id IN (4, 13)")).unionByName(edge_docs.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    docs = twice.withColumn("_null", F.lit(1)).withColumn("row", F.lit("r")).withColumn("text_key", F.lit(0)).withColumn("kept", F.lit(0)).withColumn("a`b", F.lit(3))
    for frame in (docs, docs.limit(0), no_docs):
        out = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SMALL)
            assert out.columns == frame.columns
            out.collect()
        packed = corpus_pipeline.STAGES[-1][1](spark, out, SMALL)
        assert packed.select("doc_id").distinct().count() == out.select("doc_id").distinct().count()


def plain_profile(text):
    from coevo.llm.language_id import letter_vector

    out = np.zeros(1024)
    for w in (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
        for run in "".join(c if c.isalpha() else " " for c in w.lower()).split():
            v = [letter_vector(32), *(letter_vector(ord(c)) for c in run), letter_vector(32)]
            for a, b, c in zip(v, v[1:], v[2:]):
                out += np.roll(a, 2).astype(int) * np.roll(b, 1) * c
    return out


def test_language_like_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows}
    vectors = {r.doc_id: plain_profile(r.text) for r in rows}
    sums: dict[str, np.ndarray] = {}
    for r in rows:
        if not held[r.doc_id] and r.text is not None and r.lang is not None:
            sums[r.lang] = sums.get(r.lang, 0) + vectors[r.doc_id]
    langs = sorted(sums)
    unit = np.array([sums[x] / np.linalg.norm(sums[x]) for x in langs])
    got = registry.op6_hyperdimensional_language(spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        v = vectors[r.doc_id]
        cos = unit @ v / max(np.linalg.norm(v), 1e-30)
        assert r.held_out == held[r.doc_id]
        assert r.lang_pred == (langs[int(cos.argmax())] if v.any() else "und") and abs(r.score - (max(cos.max(), 0) if v.any() else 0)) < 1e-9


def test_many_languages_and_clashing_columns(spark):
    from coevo.llm import language_id

    docs = spark.createDataFrame([(k, f"text {chr(97 + k % 26)}{chr(97 + k // 26)} word" * 3, f"l{k % 40:03}", "c") for k in range(400)], "doc_id long, text string, lang string, score string")
    many, few = language_id.fit(docs, held=1000), language_id.fit(docs, held=3)
    assert many[0] == few[0] and len(many[0]) == 40 and (many[1] == few[1]).all()
    twice = docs.unionByName(docs.limit(5)).withColumn("lang_pred", F.lit(1))
    assert language_id.predict(twice, *many).count() == 405


def test_language_profiles(spark, edge_docs, no_docs):
    from coevo.llm import language_id, registry

    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang")
    got = registry.op6_hyperdimensional_language(spark, DIR).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    langs, prototypes = language_id.fit(spark.read.parquet(f"{DIR}/documents.parquet"))
    edge = {r.doc_id: r for r in language_id.predict(edge_docs, langs, prototypes).collect()}
    assert [edge[k].lang_pred for k in range(3)] == ["und"] * 3 and edge[0].score == 0
    assert language_id.predict(no_docs, langs, prototypes).collect() == []
    langs, prototypes = language_id.fit(no_docs)
    assert {r.lang_pred for r in language_id.predict(edge_docs, langs, prototypes).collect()} == {"und"}
