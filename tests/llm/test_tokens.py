"""Encoding against the tokenizers library; packing against its contract."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from coevo.llm import bpe, packing, registry

PATH = registry.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_tree_joins_are_exact(library):
    r = random.Random(3)
    small = bpe.Encoder(PATH, long=20, piece_leaf=8)
    for _ in range(400):
        letters = r.choice(["ab", "aeiothn", "abcdefghijklmnopqrstuvwxyz", "aé日ß", "a1!", "aſİ"])
        s = "".join(r.choice(letters) for _ in range(r.randint(21, 300)))
        assert small.encode([s])[0].tolist() == library.encode(s, add_special_tokens=False).ids


    assert small.joins["piece"] > 400


def test_text_trees_are_exact(library):
    """Leaves cut words, contractions, special tokens and composed characters wherever they fall."""
    r = random.Random(4)
    parts = ["the", "it's", "WE'LL", "12345", "...!", "<|endoftext|>", "<|startoftext|>x", "<|endof", "e\u0301", "ſtraße", "İx", "日本語", "Σ", "ΑΣ", "\u0301", "a" * 40, "#*$", "\x0b", "\u2003", "\x85", "'", "l", "'re"]
    trees = [bpe.Encoder(PATH, leaf=n, long=20, piece_leaf=8) for n in (1, 3, 7, 30)]
    for _ in range(250):
        s = "".join(r.choice(parts) + r.choice(["", "", " ", "\n", "\t", "  ", "\r\n"]) for _ in range(r.randint(1, 40)))
        want = library.encode(s, add_special_tokens=False).ids
        for t in trees:
            assert t.encode([s])[0].tolist() == want, (s, t.leaf)
    assert all(t.joins["text"] > 250 for t in trees)


def test_whole_documents_are_joined(library, sample):
    """Documents of the test tables go through the tree, and so does one of a million characters."""
    enc = bpe.Encoder(PATH)
    texts = [r.text or "" for r in sample.collect()]
    for t in texts:
        assert enc.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids
    assert enc.joins["text"] >= sum((len(t) - 1) // enc.leaf for t in texts if t) > 100
    long = ("word " * 3 + "x" * 5000 + ". ") * 200
    assert enc.encode([long])[0].tolist() == library.encode(long, add_special_tokens=False).ids
    assert enc.joins["piece"] > 0


def test_encode_decode_like_the_library(spark, library, edge_docs, sample):
    docs = edge_docs.unionByName(sample.withColumn("doc_id", F.col("doc_id") + 1000))
    got = {r.doc_id: r for r in bpe.encode_documents(docs, PATH).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(got[k].ids, "<u4").tolist() == ids
        assert got[k].n_tokens == len(ids)
        assert got[k].decoded == library.decode(ids, skip_special_tokens=False)


def test_plan_is_complete_and_tight():
    r = random.Random(5)
    for capacity in (10, 64, 4096):
        for _ in range(40):
            counts = {r.randint(1, capacity): r.randint(1, 30) for _ in range(r.randint(1, 60))}
            bins: dict[int, list] = {}
            for s, a, b, first, per, offset in packing.plan_bins(counts, capacity):
                for k in range(b - a):
                    bins.setdefault(first + k // per, []).append((offset + k % per * s, s))
            held = sorted(s for b in bins.values() for _, s in b)
            assert held == sorted(s for s, n in counts.items() for _ in range(n))
            for b in bins.values():
                at = 0
                for offset, s in sorted(b):
                    assert offset == at
                    at += s
                assert at <= capacity
                assert sum(3 * s > capacity for _, s in b) <= 2
            lower = -(-sum(s * n for s, n in counts.items()) // capacity)
            assert len(bins) <= max(lower * 1.5 + 1, sum(n for s, n in counts.items() if 2 * s > capacity) + lower)


def test_pieces_and_packing(spark, library, edge_docs, sample, no_docs):
    docs = edge_docs.unionByName(sample.withColumn("doc_id", F.col("doc_id") + 1000)).withColumn("length", F.lit("clash"))
    pieces = packing.tokenize_pieces(docs, PATH, 512)
    rows = packing.pack_pieces(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), 512).collect()
    by: dict[int, list] = {}
    for x in rows:
        by.setdefault(x.doc_id, []).append(x)
    for d in docs.collect():
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 1]
        own = sorted(by[d.doc_id], key=lambda x: x.piece)
        assert [x.start for x in own] == list(range(0, len(ids), 512))
        for x in own:
            part = np.array(ids[x.start:x.start + 512], "<u4")
            assert (x.length, x.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    bins: dict[int, list] = {}
    for x in rows:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 512
    assert packing.pack_pieces(packing.tokenize_pieces(no_docs, PATH)).collect() == []


def test_matrices_hold_every_token(library, sample, edge_docs, no_docs):
    docs = edge_docs.unionByName(sample.withColumn("doc_id", F.col("doc_id") + 1000))
    rows = packing.pack_matrices(docs, PATH, 512, buffer_tokens=20_000).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    found: dict[tuple, list] = {}
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<u4")
        assert len(ids) == 512 and r.position_resets == r.cu_seqlens[:-1] and (ids[r.cu_seqlens[-1]:] == 0).all()
        for d, p, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
            found[d, p] = ids[a:b].tolist()
    for d in docs.collect():
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 1]
        assert [x for p in range(-(-len(ids) // 512)) for x in found.pop((d.doc_id, p))] == ids
    assert not found
    assert packing.pack_matrices(no_docs, PATH).collect() == []


def test_best_fit_takes_the_smallest_gap():
    assert packing.best_fit_decreasing([6, 5, 4, 3, 2], 10) == [[0, 2], [1, 3, 4]]
    assert packing.best_fit_decreasing([], 10) == []


def test_best_fit_like_a_plain_search():
    r = random.Random(8)
    for capacity in (7, 50, 4096):
        for _ in range(30):
            lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 200))]
            gaps: list[int] = []
            for n in sorted(lengths, reverse=True):
                open_ = [g for g in gaps if g >= n]
                if open_:
                    gaps[gaps.index(min(open_))] -= n
                else:
                    gaps.append(capacity - n)
            bins = packing.best_fit_decreasing(lengths, capacity)
            assert sorted(k for b in bins for k in b) == list(range(len(lengths)))
            assert sorted(capacity - sum(lengths[k] for k in b) for b in bins) == sorted(gaps)


def test_matrix_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = registry.op2_packed_matrices(spark, folder).collect()
    found = {}
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<u4")
        assert len(ids) == 4096 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] <= 4096 and (ids[r.cu_seqlens[-1]:] == 0).all()
        for d, p, start, a, b in zip(r.doc_ids, r.pieces, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert start == 4096 * p
            found[d, p] = ids[a:b].tolist()
    total = 0
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        assert [x for p in range(-(-len(ids) // 4096)) for x in found.pop((d.doc_id, p))] == ids
    assert not found and -(-total // 4096) <= len(rows) <= -(-total // 4096) * 1.1 + 1


def test_clashing_columns(spark, edge_docs):
    docs = edge_docs.withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x")).withColumn("decoded", F.lit(2))
    assert bpe.encode_documents(docs, PATH).count() == docs.count()


def test_decode_ids(spark, library):
    ids = library.encode("Hello, world", add_special_tokens=False).ids
    df = spark.createDataFrame([(1, np.array(ids, "<u4").tobytes()), (2, None)], "doc_id long, ids binary")
    assert {r.doc_id: r.decoded for r in bpe.decode_ids(df, PATH).collect()} == {1: library.decode(ids, skip_special_tokens=False), 2: ""}


def test_query_digest(spark):
    got = registry.op9_bpe_tree(spark, "/root/testdata/sf0.001").limit(3).collect()
    assert all(len(r.ids_sha256) == len(hashlib.sha256().hexdigest()) for r in got)
