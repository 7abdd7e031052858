"""Suffix arrays and removal against brute force."""

import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from coevo.llm import registry
from coevo.llm import suffix_dedup as S


def plain(rows):
    """rows of (doc_id, text): removed bytes as (doc_id, runs, kept)."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            w = data[k:k + 100]
            if w in seen:
                gone[k:k + 100] = True
            seen.add(w)
        edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        runs = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
        out.append((doc_id, runs, bytes(np.frombuffer(data, np.uint8)[~gone])))
    return out


def test_suffix_array_and_prefixes():
    r = np.random.default_rng(1)
    for letters, n in ((2, 700), (4, 3000), (1, 300), (200, 500), (3, 1)):
        t = r.integers(0, letters, n).astype(np.uint8) + 97
        if n > 600:
            t[300:450] = t[100:250]
        sa = S.suffix_array(t)
        b = t.tobytes()
        cut = [b[k:] for k in sa]
        assert sorted(sa.tolist()) == list(range(n)) and cut == sorted(cut)
        cut = [c[:100] for c in cut]
        got = S.common_prefixes(t, sa)
        for k in range(1, n):
            want = next((i for i, (x, y) in enumerate(zip(cut[k], cut[k - 1])) if x != y), min(len(cut[k]), len(cut[k - 1])))
            assert got[k] >= want if max(sa[k], sa[k - 1]) + 100 > n else got[k] == want


def test_zero_bytes_at_the_end():
    r = np.random.default_rng(7)
    for k in range(60):
        t = r.integers(0, (1, 2, 256)[k % 3], int(r.integers(2, 600))).astype(np.uint8)
        t[-1 - k:] = 0
        sa, b = S.suffix_array(t), t.tobytes()
        assert sa.tolist() == sorted(range(len(t)), key=lambda at: b[at:])
        got = S.common_prefixes(t, sa)
        for x, y, h in zip(sa[1:], sa[:-1], got[1:]):
            assert b[x:x + h] == b[y:y + h] and (h == min(100, len(t) - max(x, y)) or b[x + h] != b[y + h])


def test_common_prefixes_cost_no_more_than_the_order():
    r = np.random.default_rng(8)
    texts = [np.frombuffer(b" ".join(r.choice([b"alpha", b"beta", b"gamma", b"delta", b"x"], 700).tolist()), np.uint8) for _ in range(20)]
    texts.append(np.concatenate([texts[0], texts[1], texts[0]]))

    def seconds(f):
        took = []
        for _ in range(3):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)

    arrays = [S.suffix_array(t) for t in texts]
    order = seconds(lambda: [S.suffix_array(t) for t in texts])
    assert seconds(lambda: [S.common_prefixes(t, sa) for t, sa in zip(texts, arrays)]) < 3 * order


def test_grams_of_places():
    data = np.random.default_rng(6).integers(0, 256, 9000).astype(np.uint8)
    assert (S._grams(data, np.arange(3, 8900)) == S.gram_hashes(data)[3:8900]).all()


def cases():
    r = np.random.default_rng(2)
    words = ["".join(chr(97 + c) for c in r.integers(0, 26, r.integers(2, 9))) for _ in range(300)] + ["é", "straße"]
    line = lambda n: " ".join(words[k] for k in r.integers(0, len(words), n))
    shared = [line(40) for _ in range(6)]
    docs = []
    for k in range(120):
        parts = [line(int(r.integers(1, 60))) for _ in range(3)]
        for s in r.choice(shared, int(r.integers(0, 3))):
            parts.insert(int(r.integers(0, 3)), s[int(r.integers(0, 30)):])
        docs.append((k * 3 % 127, " ".join(parts)))
    docs += [(200, "x" * 900), (201, "ab" * 300), (202, None), (203, ""), (204, "short"), (205, docs[3][1]), (206, docs[3][1]), (207, line(30) * 4), (208, "x" * 150), (None, docs[5][1])]
    return docs


@pytest.mark.parametrize("run_bytes,merge_bytes,shards,hot", [(S.RUN_BYTES, S.MERGE_BYTES, 3, False), (700, 3000, 2, False), (700, 20_000, 2, True), (300, 1, 1, False)])
def test_shards_like_brute_force(monkeypatch, run_bytes, merge_bytes, shards, hot):
    merged = []
    pair = S.Merge._pair
    monkeypatch.setattr(S.Merge, "_pair", lambda self, a, b=None: (merged.append(b is not None), pair(self, a, b))[1])
    from xxhash import xxh64_intdigest

    rows = [(d, t) for d, t in cases() if d is not None]
    blobs: dict[int, list] = {}
    for a in range(0, len(rows), 20):
        part = [(d, (t or "").encode()) for d, t in rows[a:a + 20]]
        part = [(d, t) for d, t in part if len(t) >= 100]
        sizes = np.array([len(t) for _, t in part])
        buf = np.frombuffer(b"".join(t for _, t in part), np.uint8)
        keys = np.array([xxh64_intdigest(t, 42) & 0xFFFFFFFF for _, t in part])
        grams = np.unique(S.segments(buf, np.cumsum(sizes) - sizes, sizes)[0])
        for s, b in S.pack_block(buf, np.cumsum(sizes) - sizes, sizes, np.array([d for d, _ in part]), keys, shards, hot=np.sort(grams[grams % 3 > 0]) if hot else None):
            blobs.setdefault(s, []).append(b)
    spans: dict[int, list] = {}
    for b in blobs.values():
        for ids, _, start, stop in S.shard_repeats(b, run_bytes, merge_bytes):
            for d, x, y in zip(ids.tolist(), start.tolist(), stop.tolist()):
                spans.setdefault(d, []).append((x << 32) | (y + 99))
    assert {d: S.merged(v) for d, v in spans.items()} == {d: runs for d, runs, _ in plain(rows) if runs}
    assert any(merged) == (run_bytes < S.RUN_BYTES)  # runs of input shards are merged by binary search


def test_hot_grams_are_the_same_in_all_blocks():
    """Blocks deal equal windows alike: the grams of a block above are cut by value, so all blocks agree on those they share."""
    text = ("the same line of many words that stands in all of them, " * 3).encode()
    buf = np.frombuffer(text + b"A" * 40 + text, np.uint8)
    grams = np.unique(S.segments(buf, np.array([0]), np.array([len(buf)]))[0])
    key, _, first, last, _ = S.segments(buf, np.array([0]), np.array([len(buf)]), hot=grams)
    dealt = {}
    for k, a, b in zip(key.tolist(), first.tolist(), last.tolist()):
        for at in range(a, b + 1):
            dealt.setdefault(buf[at:at + 100].tobytes(), set()).add(k)
    assert all(len(x) == 1 for x in dealt.values()) and any(x not in grams.tolist() for y in dealt.values() for x in y)


def test_documents_like_brute_force(spark, edge_docs, sample, no_docs):
    own = spark.createDataFrame([(None if d is None else d + 5000, t, None, None, 0) for d, t in cases()], edge_docs.schema)
    docs = edge_docs.unionByName(sample.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(own).withColumn("kept", F.lit("clash")).withColumn("row", F.lit(1))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.row.doc_id: ([(s.start, s.stop) for s in r.removed], bytes(r.kept)) for r in S.remove_repeats(docs).collect()}
    assert got == {d: (runs, kept) for d, runs, kept in plain(rows)}
    assert any(runs for runs, _ in got.values())
    small = {r.row.doc_id: ([(s.start, s.stop) for s in r.removed], bytes(r.kept)) for r in S.remove_repeats(docs, 5, 333).collect()}
    hot = S.common_grams(docs, len(rows), 10**6, shard_bytes=10, sample_rows=1000)
    assert len(hot) and {r.row.doc_id: bytes(r.kept) for r in S.remove_repeats(docs, 5, hot=hot).collect()} == {d: k for d, (_, k) in got.items()}
    assert small == got
    assert S.remove_repeats(no_docs).collect() == []
    clean = S.without_repeats(docs)
    assert clean.columns == docs.columns
    want = {d: None if t is None else got[d][1].decode(errors="ignore") for d, t in rows}
    assert {r.doc_id: r.text for r in clean.collect()} == want


def test_query(spark):
    rows = {r.doc_id: r for r in registry.op4_suffix_arrays(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for d, runs, kept in plain([(r.doc_id, r.text) for r in docs]):
        r = rows.pop(d)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(kept) + sum(b - a for a, b in runs), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest())
    assert not rows


def test_repeated_rows_keep_their_text(spark):
    docs = [(d, t) for d, t in cases() if d is not None]
    twice = docs + [(d, t) for d, t in docs if d % 2]
    r = np.random.default_rng(9)
    alone = " ".join(str(x) for x in r.integers(0, 10**9, 60))
    twice += [(None, alone), (None, alone), (300, "q" + alone[::-1]), (300, "q" + alone[::-1])]
    frame = spark.createDataFrame(twice, "doc_id long, text string")
    want = sorted(((-1 if d is None else d), runs, kept) for d, runs, kept in plain(list(dict.fromkeys(twice))))
    for args in ((), (5, 333)):
        rows = S.remove_repeats(frame, *args).collect()
        got = sorted((-1 if x.row.doc_id is None else x.row.doc_id, [(s.start, s.stop) for s in x.removed], bytes(x.kept)) for x in rows)
        assert len(got) == len(twice)
        assert sorted({(d, tuple(runs), kept) for d, runs, kept in got}) == sorted({(d, tuple(runs), kept) for d, runs, kept in want})
    # two runs that hold the same places
    text, order = np.frombuffer(alone.encode(), np.uint8), np.where(np.arange(len(alone)) <= len(alone) - 100, np.arange(len(alone)), -1)
    both = S.Merge(np.concatenate([text, text]), np.concatenate([order, order]), [0, len(text), 2 * len(text)])
    assert not both.repeats.any() and len(both.heads) == len(text) - 99


def test_characters_at_edges_go_whole_and_others_stay(spark):
    r = np.random.default_rng(4)
    same = "é" + "".join(chr(x) for x in r.integers(0x3B1, 0x3C9, 80))
    docs = [(1, "keep \ufffd this " + same + " end"), (2, "\ufffd other \ufffd " + same[1:] + "\ufffd"), (3, "è" + same[1:] + "\ufffd\ufffd")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, _null string")
    got = {x.doc_id: x.text for x in S.without_repeats(frame).collect()}
    for (d, text), (_, runs, _) in zip(docs, plain(docs)):
        ends = np.cumsum([len(c.encode()) for c in text])
        assert got[d] == "".join(c for c, e in zip(text, ends) if not any(x < e and e - len(c.encode()) < y for x, y in runs))
    assert got[1] == docs[0][1] and got[2] == "\ufffd other \ufffd \ufffd" and got[3] == "è\ufffd"


def test_split_character():
    data = "aé漢b".encode()
    assert S._whole_characters(data, [(2, 4)]) == [(1, 6)] and S._whole_characters(data, [(0, 2), (3, 4)]) == [(0, 6)]
    assert S._whole_characters(data, [(1, 3)]) == [(1, 3)]


def test_dictionary_changes_no_result(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(150)]
    texts += [t[:700] for t in texts[:20]] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = S.press_words(docs)
    assert 0 < len(known) <= S.PRESS_BYTES
    assert S.press_words(docs.limit(3)) == b""
    assert S.press_words(spark.createDataFrame([(k, "ab" * 900) for k in range(200)], "doc_id long, text string")) is not None
    spans = [{(r.doc_id, *S.merged(r.spans)) for r in S.repeated_spans(docs, 5, words=w).collect()} for w in (b"", known)]
    assert spans[0] == spans[1] and spans[0]
    kept = {r.row.doc_id: bytes(r.kept) for r in S.remove_repeats(docs, 5).collect()}
    assert len(kept) == len(texts) and kept[150] == b"" and kept[0] == texts[0].encode()


def test_documents_that_end_in_zero_bytes(spark):
    r = np.random.default_rng(11)
    same = " ".join(str(x) for x in r.integers(0, 10**9, 40))
    docs = [(1, same + "\0" * 3), (2, "a" + same + "\0\0"), (3, "\0" * 250), (4, same[:150] + "\0" * 120)]
    got = {x.row.doc_id: ([(s.start, s.stop) for s in x.removed], bytes(x.kept)) for x in S.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: (runs, kept) for d, runs, kept in plain(docs)}
