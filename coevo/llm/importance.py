"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of the target text and one of the raw text, are bags of
``buckets`` counts. A document's log weight is the sum of the log ratios of its n-grams' buckets.
Resampling draws without replacement by Gumbel top-k: each document's key is its log weight over
``temperature`` (1 draws in proportion to the weights) plus Gumbel noise from a hash of its id, and the k largest keys stay.

The raw model counts every n-gram of the whole corpus. The target model counts documents labelled
as good, at most ``target_rows`` labelled documents chosen by a hash of doc_id, and is mixed with the raw one by halves; counts of all
tasks are added up in ``buckets`` numbers, so what reaches the driver and what is broadcast is of
fixed size. k is ``share`` of the rows, which defaults to the share of good ones among the labelled documents drawn. The
k-th largest key is found by counting keys in ever finer ranges, never by sorting all keys into one task.

N-grams are those of two token sequences: words (single ones and neighbouring pairs; case and signs count) and word
classes (single ones: a word's capitals, signs and digits, or that it repeats the word before).

Defined results: null and empty texts have log weight 0; a null doc_id has a noise of its own; rows equal in doc_id and
text have equal keys, and all rows whose key equals the k-th largest are kept; very long texts are scored whole; without
labels of both kinds all documents are kept; an empty table gives no rows; other columns, whatever their names, are
dropped by ``resample`` and carried by ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, blocks, enter, keep as kept_between, per_document, row_key, split_blank, stored, without_rows

BUCKETS = 1 << 16
_TABLE: dict[int, WordTable] = kept_between("importance", {})
#: The class of a word that repeats the word before.
AGAIN = np.uint64(12345)


def _hash(words: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def word_class(word: str) -> str:
    signs = "".join(sorted({c for c in word if not c.isalnum()}))
    case = "U" if word.isupper() and len(word) > 1 else "u" if word[:1].isupper() else "l"
    return f"{case}{signs}{'9' if any(c.isdigit() for c in word) else ''}"


def _features(words: list[str]) -> list[list[int]]:
    """Per word its own hash and its class's; none for the empty word."""
    own, cls = _hash(words), _hash(["\0" + word_class(w) for w in words])
    return [[a, b] if w else [] for w, a, b in zip(words, own.tolist(), cls.tolist())]


def ngram_buckets(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram, number of the text it is from)."""
    if buckets not in _TABLE:
        _TABLE[buckets] = WordTable(_features, np.uint64, 200_000)
    flat, size = per_document(_TABLE[buckets], texts, split_blank)
    pairs = flat.reshape(-1, 2)
    doc = np.repeat(np.arange(len(texts)), size // 2)
    own, cls = pairs[:, 0], pairs[:, 1].copy()
    near = doc[1:] == doc[:-1]
    cls[1:][near & (own[1:] == own[:-1])] = AGAIN
    with np.errstate(over="ignore"):
        pair = own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]
        pair = (pair ^ (pair >> np.uint64(29)))[near]
    every = np.concatenate([own, cls, pair])
    return (every % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, doc, doc[1:][near]])


def sampled_labels(labels: DataFrame, target_rows: int) -> DataFrame:
    """(doc_id, _q): at most ``target_rows`` labelled documents, chosen by a hash; the worse label counts where they differ."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("_q"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows)


def fit(docs: DataFrame, labels: DataFrame, target_rows: int = 20_000, buckets: int = BUCKETS) -> np.ndarray | None:
    """Log ratio target / raw per bucket; None without good and bad labels."""
    chosen = sampled_labels(labels, target_rows)

    def count(batches):
        enter("importance")
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            texts, good = [t or "" for t in batch.column(0).to_pylist()], batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in blocks(texts):
                at, doc = ngram_buckets(texts[a:b], buckets)
                raw += np.bincount(at, minlength=buckets)
                target += np.bincount(at[good[a:b][doc] == 1], minlength=buckets)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left").select("text", F.coalesce("_q", F.lit(-1)).alias("_q"))
    counts = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    if chosen.agg(F.count_distinct("_q")).first()[0] < 2:
        return None
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in counts:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not raw.sum() or not target.sum():
        return None
    # half of the target's model is the raw one, so an n-gram that the sample lacks costs log 2 at most
    p = raw / raw.sum()
    q = (target / target.sum() + p) / 2
    return np.log(np.maximum(q, 1e-300)) - np.log(np.maximum(p, 1e-300))


def log_weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """docs' (doc_id, text_key, log_weight, n_grams) by the models' ratio (a table of fixed size)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(batches):
        enter("importance")
        r = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in blocks(texts):
                at, doc = ngram_buckets(texts[a:b], len(r))
                w = np.bincount(doc, r[at], b - a)
                own = [c.slice(a, b - a) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.round(w, 6)), pa.array(np.bincount(doc, minlength=b - a))], names=["doc_id", "text_key", "log_weight", "n_grams"])

    return docs.select("doc_id", row_key("text").alias("text_key"), "text").mapInArrow(score, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key long, log_weight double, n_grams long")


def gumbel_key(temperature: float, seed: int):
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return F.col("log_weight") / temperature - F.log(-F.log(u))


def top_k_threshold(keys: DataFrame, k: int, ranges: int = 4096) -> float | None:
    """The k-th largest of ``key``: count keys in ranges, go into the range that holds it, until it is one value."""
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0 or n == 0:
        return None
    if k >= n:
        return low
    above = 0
    while low < high:
        width = (high - low) / ranges
        if not width or low + width == low:
            break
        inside = keys.where(F.col("key").between(low, high))
        part = F.least(F.floor((F.col("key") - low) / width), F.lit(ranges - 1))
        counts = sorted(inside.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect(), key=lambda r: -r.part)
        for r in counts:
            if above + r.n >= k:
                low, high = r.low, r.high
                break
            above += r.n
    return low


def _judged(docs: DataFrame, labels: DataFrame, k: int | None, share: float | None, temperature: float, seed: int, target_rows: int) -> DataFrame | None:
    ratio = fit(docs, labels, target_rows)
    if ratio is None:
        return None
    weights = stored(log_weights(docs, ratio).withColumn("key", gumbel_key(temperature, seed)), "weights")
    if k is None:
        share = sampled_labels(labels, target_rows).agg(F.avg("_q")).first()[0] if share is None else share
        k = round(share * weights.count())
    least = top_k_threshold(weights, k)
    kept = F.lit(False) if least is None else F.col("key") >= F.lit(least)
    return weights.withColumn("kept", kept)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, share: float | None = None, temperature: float = 1.0, seed: int = 7, target_rows: int = 20_000) -> DataFrame:
    """(doc_id, log_weight, key, kept) for every row of docs."""
    judged = _judged(docs, labels, k, share, temperature, seed, target_rows)
    if judged is None:
        return docs.select("doc_id", F.lit(0.0).alias("log_weight"), F.lit(0.0).alias("key"), F.lit(True).alias("kept"))
    return judged.select("doc_id", "log_weight", "key", "kept")


def keep(docs: DataFrame, labels: DataFrame, k: int | None = None, share: float | None = None, temperature: float = 1.0, seed: int = 7, target_rows: int = 20_000) -> DataFrame:
    """The rows of docs that resampling keeps, with all their columns; rows that share a doc_id are judged by their own text."""
    judged = _judged(docs, labels, k, share, temperature, seed, target_rows)
    return docs if judged is None else without_rows(docs, judged.where("NOT kept"))
