"""Near-duplicate operators against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from coevo.llm import components as C
from coevo.llm import embeddings as E
from coevo.llm import registry, simhash


def smallest_reachable(n, pairs):
    root = list(range(n))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def test_components(spark):
    r = np.random.default_rng(1)
    pairs = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + r.integers(200, 300, (60, 2)).tolist()
    want = smallest_reachable(300, pairs)
    got = {x.node: x.component for x in C.components(spark.createDataFrame([tuple(map(int, p)) for p in pairs], "a long, b long")).collect()}
    assert got == {k: want[k] for p in pairs for k in p if p[0] != p[1]}
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_like_brute_force(spark, edge_docs, sample, no_docs):
    docs = edge_docs.unionByName(sample.withColumn("doc_id", F.col("doc_id") + 1000)).withColumn("fp", F.lit("clash"))
    rows = sorted(simhash.near_duplicates(docs).collect(), key=lambda r: r.doc_id)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    fps = [plain_fingerprint(texts[r.doc_id]) for r in rows]
    assert [r.fp % 2**64 for r in rows] == fps
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    assert pairs
    want = smallest_reachable(len(fps), pairs)
    assert [r.component_id for r in rows] == [rows[k].doc_id for k in want]
    assert simhash.near_duplicates(no_docs).collect() == []
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.doc_id == r.component_id)


def test_variants_lose_no_link(spark):
    r = np.random.default_rng(2)
    centre = r.integers(0, 2**63, 40, np.int64)
    near = [int(c) ^ sum(1 << int(b) for b in r.choice(63, r.integers(0, 5), replace=False)) for c in np.repeat(centre, 30)]
    fps = sorted(set(near))
    nodes = spark.createDataFrame([(f, k) for k, f in enumerate(fps)], "fp long, node long")
    got = {x.node: x.component for x in C.components(simhash.near_links(nodes)).collect()}
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = smallest_reachable(len(fps), pairs)
    assert [got.get(k, k) for k in range(len(fps))] == want


def brute(ids, vectors, threshold=0.9):
    good = [k for k, v in enumerate(vectors) if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links, pairs = [0] * len(ids), []
    for i, a in enumerate(good):
        for b in good[:i]:
            x, y = np.array(vectors[a], float), np.array(vectors[b], float)
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a] += 1
                links[b] += 1
                pairs.append((a, b))
    return links, [ids[k] for k in smallest_reachable(len(ids), pairs)]


@pytest.mark.parametrize("block", [1024, 7])
def test_embeddings_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    r = np.random.default_rng(3)
    base = r.standard_normal((40, 16))
    vectors = [(b + 0.1 * r.standard_normal(16)).astype("f4").tolist() for b in np.concatenate([base, base[:10], np.repeat(base[:1], 40, 0)])]
    vectors += [vectors[0]] * 5 + [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(k, v, "x") for k, v in zip(ids, vectors)], "vec_id long, embedding array<float>, h string")
    links, groups = brute(ids, vectors)
    got = sorted(E.near_duplicates(df).collect(), key=lambda x: x.vec_id)
    assert [x.component_id for x in got] == groups
    assert [x.n_links for x in got] == links
    assert E.near_duplicates(df.limit(0)).collect() == []


def test_embedding_recall(spark):
    rows = registry.op8_projection_passes(spark, "/root/testdata/sf0.01").collect()
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()}
    ids = sorted(vectors)
    x = np.array([vectors[k] for k in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = dict(zip(ids, ((x @ x.T >= 0.9).sum(1) - 1).tolist()))
    got = {r.vec_id: r.n_links for r in rows}
    assert all(got[k] <= want[k] for k in ids)
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_embedding_recall_in_a_dense_range(spark):
    """Rows around one centre, many times a window, with planted pairs at cosine 0.91 among them."""
    r = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    hot = unit(0.8**0.5 * unit(r.standard_normal((1, 64))) + 0.2**0.5 * unit(r.standard_normal((500, 64))))
    side = r.standard_normal((200, 64))
    side = unit(side - (side * hot[:200]).sum(1, keepdims=True) * hot[:200])
    x = np.concatenate([hot, 0.91 * hot[:200] + (1 - 0.91**2) ** 0.5 * side])
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    joined = []
    for passes in (12, None):
        got = {k.vec_id: k.component_id for k in E.near_duplicates(df, passes=passes, window=8).collect()}
        joined.append(sum(got[k] == got[500 + k] for k in range(200)))
    assert joined[0] < 195 and joined[1] >= 198
