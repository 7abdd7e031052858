"""The pipeline's near-duplicate stage against brute-force Jaccard similarity."""

import re

import numpy as np
from pyspark.sql import functions as F
from test_near import smallest_reachable

import corpus_pipeline
from coevo.llm import simhash

DIR = "/root/testdata/sf0.01"


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    sets = [plain_shingles(t) for _, t in rows]
    pairs, near = [], 0
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)):
                common = len(x & y)
                if x == y or 5 * common >= 4 * (len(x) + len(y) - common):
                    pairs.append((a, b))
                    near += x != y
    root = smallest_reachable(len(rows), pairs)
    return [rows[k][0] for k in range(len(rows)) if root[k] == k], near


def test_stage_like_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want, near = plain_kept(rows)
    assert near > 10
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, DIR).collect()) == want


def test_changed_words(spark, edge_docs, no_docs):
    r = np.random.default_rng(5)
    rows = [(k, t) for k, t in enumerate(x.text for x in edge_docs.collect())]
    for base in range(40):
        words = [f"w{x}" for x in r.integers(0, 10**6, 200)]
        for copy in range(4):
            own = list(words)
            for at in r.choice(200, r.integers(1, 5), replace=False):
                own[at] = f"n{base}x{copy}x{at}"
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame([(k, t, None, None, 0) for k, t in rows] + [(None, rows[-1][1], None, None, 0)] * 2, edge_docs.schema)
    want, near = plain_kept(rows)
    assert near > 40
    got = [x.doc_id for x in simhash.keep_similar(docs).collect()]
    assert got.count(None) == 2 and sorted(k for k in got if k is not None) == want
    assert simhash.keep_similar(no_docs).collect() == []


def test_groups_of_many_blocks(spark):
    """A dense group, a chain whose ends are far apart, and two groups that one document joins, in blocks of a few sets."""
    r = np.random.default_rng(6)
    words = lambda n: [f"w{x}" for x in r.integers(0, 10**7, n)]
    rows, base = [], words(300)
    for k in range(60):
        own = list(base)
        own[int(r.integers(0, 300))] = f"x{k}"
        rows.append(own)
    chain = words(150)
    for k in range(40):
        rows.append(chain[2 * k:2 * k + 90])
    rows = [(k * 7 % 101, " ".join(w)) for k, w in enumerate(rows)]
    rows += [(200, rows[0][1]), (201, "a b"), (201, rows[1][1]), (202, rows[1][1] + " zz"), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", F.lit(1)).withColumn("component", F.lit(2))
    able = sorted((k for k in rows if k[0] is not None), key=lambda x: x[0])
    want, _ = plain_kept(able)
    for args in ({}, {"block": 7, "pivots": 2}, {"block": 3, "pivots": 1}):
        got = {(x.doc_id, x.component_id) for x in simhash.similar(docs, **args).collect()}
        assert sorted(a for a, b in got if a == b and a is not None) == sorted(set(want)) and (None, None) in got
    kept = simhash.keep_similar(docs)
    assert kept.columns == docs.columns and (201, "a b") in [(x.doc_id, x.text) for x in kept.collect()]
