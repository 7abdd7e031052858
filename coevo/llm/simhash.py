"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in at most four of 64 bits are cut into three segments; one segment then
differs in at most one bit. Each distinct fingerprint is indexed under its 64 variants, one for each bit,
in which that bit of its segment is left out; two fingerprints meet in an equal variant exactly if
a segment differs in at most that bit. The rows of a variant are verified in full, and only a spanning forest
of the verified links leaves the task, never all pairs. Equal fingerprints are one node.

A variant's rows are 16 bytes each and hold distinct fingerprints only; long runs are searched outward from
one fingerprint at a time against those not yet reached, so a dense group costs its size, not its square.

A variant's key has 21 or 22 bits of the fingerprint, so its runs grow with the number of distinct fingerprints: of 10^9 a
run has some 500, all of which are compared with what is not yet reached. Beyond some 10^10 one segment less
is too few bits: fingerprints of more bits, and wider segments with them, are needed then.

Defined results: null text and text without words have fingerprint zero and link like any other; a null
doc_id gets a fingerprint, but links with nothing and has a null component; very long texts are hashed whole; of a group
the smallest doc_id names it; repeated rows give repeated rows; extra columns, whatever their names, are dropped by
``near_duplicates`` and ``similar`` and carried by ``keep_first`` and ``keep_similar``; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, enter, row_key, stored, without_rows
from .components import components

WORDS, BITS = 4, 4
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Variant runs up to this long are compared by shifts.
SHORT = 16


def shingle_hashes(text: str, words: int = WORDS) -> list[int]:
    """XXH64 (seed 42) of each run of ``words`` words, A-Z in lower case, repeats included."""
    from xxhash import xxh64_intdigest as digest

    found = text.encode().lower().split()
    if len(found) <= words:
        return [digest(b" ".join(found), 42)] if found else []
    line = b" ".join(found)
    size = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(size) - 1
    starts = (ends + 1 - size)[:len(found) - words + 1].tolist()
    return [digest(line[a:b], 42) for a, b in zip(starts, ends[words - 1:].tolist())]


def majority(found: list[list[int]]) -> np.ndarray:
    """uint64 per list of hashes: a bit is set if over half of them have it."""
    counts = np.fromiter(map(len, found), np.int64, len(found))
    out = np.zeros(len(found), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.fromiter(chain.from_iterable(found), "<u8", int(counts.sum())).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[some]
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        major = (2 * sums > counts[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(texts: list[str], words: int = WORDS) -> np.ndarray:
    return majority([shingle_hashes(t, words) for t in texts])


def with_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_key, fp long) for every row of docs; fp holds the 64 bits."""

    def run(batches):
        enter("simhash")
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in blocks(texts, 1_000_000):
                own = [c.slice(a, b - a) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(fingerprints(texts[a:b], words).view(np.int64))], names=["doc_id", "text_key", "fp"])

    return docs.select("doc_id", row_key().alias("text_key"), "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key long, fp long")


def variants(fp) -> list:
    """The 64 keys of a fingerprint column: which bit is left out, and its segment without it."""
    out = []
    for first, width in SEGMENTS:
        segment = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))
        out += [segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << k))).bitwiseOR(F.lit((first + k) << 22)) for k in range(width)]
    return out


def _reach(fp: np.ndarray, node: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one run."""
    links, left = [], np.arange(len(fp))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            k = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[k]) <= bits
            got = left[near]
            links += [(node[k], node[x]) for x in got]
            queue += got.tolist()
            left = left[~near]
    return links


def links_of_runs(key: np.ndarray, fp: np.ndarray, node: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect, within each run of equal keys, all that is within ``bits`` bits."""
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(cuts, len(key)))
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    short = np.repeat(size <= SHORT, size)
    at = np.flatnonzero(short)
    for s in range(1, int(size[size <= SHORT].max(initial=1))):
        at = at[at + s < len(key)]
        at = at[key[at] == key[at + s]]
        near = at[np.bitwise_count(fp[at] ^ fp[at + s]) <= bits]
        a.append(node[near])
        b.append(node[near + s])
    for first, n in zip(cuts[size > SHORT].tolist(), size[size > SHORT].tolist()):
        got = _reach(fp[first:first + n], node[first:first + n], bits)
        if got:
            x = np.array(got, np.int64)
            a.append(x[:, 0])
            b.append(x[:, 1])
    return np.concatenate(a), np.concatenate(b)


def sorted_runs(batches, columns: int, most: int = 1_000_000):
    """Arrays of whole runs of the first column from batches sorted by it."""
    held: list[list[np.ndarray]] = []
    n = 0
    for batch in batches:
        held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(columns)])
        n += batch.num_rows
        if n < most:
            continue
        whole = [np.concatenate(c) for c in zip(*held)]
        last = np.searchsorted(whole[0], whole[0][-1])
        if last:
            yield [c[:last] for c in whole]
        held = [[c[last:] for c in whole]]
        n = 0
    if held:
        whole = [np.concatenate(c) for c in zip(*held)]
        if len(whole[0]):
            yield whole


def near_links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b) links between nodes (fp, node), enough to connect all within ``bits`` bits."""

    def run(batches):
        for key, fp, node in sorted_runs(batches, 3):
            a, b = links_of_runs(key, fp.view(np.uint64), node, bits)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    keyed = nodes.select(F.explode(F.array(*variants(F.col("fp")))).alias("key"), "fp", "node")
    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """(doc_id, text_key, fp, component_id) for every row of docs. The pigeonhole needs ``bits`` of at most five."""
    if bits > 5:
        raise ValueError("three segments with one free bit find up to five differing bits")
    found = stored(with_fingerprints(docs, words), "fingerprints")
    nodes = stored(found.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    linked = components(near_links(nodes, bits))
    owner = nodes.join(linked, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return found.join(owner, "fp", "left").select("doc_id", "text_key", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def _first_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs without the rows that are not the first of their group by (doc_id, text_key); null ids stay."""
    able = found.where("doc_id IS NOT NULL")
    first = able.where("doc_id = component_id").groupBy("component_id").agg(F.min("text_key").alias("_first"))
    return without_rows(docs, able.join(first, "component_id").where("doc_id <> component_id OR text_key <> _first"))


def keep_first(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One document of each near-duplicate group: the smallest doc_id, of rows that share it the text with the smallest hash.
    Rows are told apart by doc_id and text, so rows equal in both stay or go together; rows with a null doc_id stay."""
    return _first_rows(docs, near_duplicates(docs, words, bits))


#: Bands of minima per document and minima in each: a pair of Jaccard similarity s shares a band with probability
#: 1 - (1 - s^ROWS)^BANDS, 0.9993 at 0.8.
BANDS, ROWS = 24, 6
#: Shingle sets in a block of exact comparison, leaders of a group, and shingles counted at once.
BLOCK, PIVOTS, PART = 256, 8, 4096
_MIX = np.random.default_rng(7).integers(1, 1 << 63, (BANDS, ROWS, 2), np.uint64) | np.uint64(1)


def bands(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """int64 (sets, BANDS): a hash of each band's minima, for sets of hashes joined in flat, none of them empty."""
    starts = np.cumsum(counts) - counts
    out = np.zeros((len(counts), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            for plus, times in _MIX[band]:
                least = np.minimum.reduceat((flat ^ plus) * times, starts)
                least ^= least >> np.uint64(31)
                out[:, band] = (out[:, band] + least) * times
            out[:, band] = (out[:, band] ^ (out[:, band] >> np.uint64(29))) * np.uint64(2 * band + 1)
    return out.view(np.int64)


def shingle_set(text: str, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def with_signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_key, fp, key, bands) for every row of docs; key is a hash of its distinct shingles, null without words."""

    def run(batches):
        from hashlib import blake2b

        enter("simhash")
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in blocks(texts, 500_000):
                hashes = [shingle_hashes(t, words) for t in texts[a:b]]
                sets = [np.unique(np.array(h, np.uint64)) for h in hashes]
                counts = np.fromiter(map(len, sets), np.int64, len(sets))
                some = np.flatnonzero(counts)
                keys = bands(np.concatenate(sets), counts[some]).tolist() if len(some) else []
                found = [[] for _ in sets]
                for k, row in zip(some.tolist(), keys):
                    found[k] = row
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(a, b - a) for c in batch.columns[:2]), pa.array(majority(hashes).view(np.int64)),
                    pa.array([blake2b(s.astype("<u8").tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], pa.string()),
                    pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "text_key", "fp", "key", "bands"])

    return docs.select("doc_id", row_key().alias("text_key"), "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key long, fp long, key string, bands array<long>")


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sets have in common."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(often > 1) - 1
    held = often[which] > 1
    owner, column = owner[held], number[which[held]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, PART):
        a, b = np.searchsorted(column, [first, first + PART])
        m = np.zeros((len(sets), int(column[b - 1]) - first + 1), np.float32)
        m[owner[a:b], column[a:b] - first] = 1
        out += m @ m.T
    return out


def _similar_links(batches, threshold: float):
    """Rows (task, side, node, shingles) sorted by task: links that connect the pairs of a task with that Jaccard similarity.
    Rows of side 1 are compared with all rows; where a task has none, all are compared with each other."""

    def compare(rows):
        sets = [np.frombuffer(r[3], "<u4") for r in rows]
        size = np.array([len(s) for s in sets], np.float64)
        common = _shared(sets)
        near = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
        side = np.array([r[1] for r in rows])
        if side.any():
            near &= (side[:, None] + side[None, :]) > 0
        a, b, left = [], [], np.arange(len(rows))
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                k = queue.pop()
                hit = near[k, left]
                a += [rows[k][2]] * int(hit.sum())
                b += [rows[x][2] for x in left[hit]]
                queue += left[hit].tolist()
                left = left[~hit]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    for _, own in groupby(rows, key=itemgetter(0)):
        yield compare(list({r[2]: r for r in sorted(own, key=itemgetter(1))}.values()))


def _compared(dealt: DataFrame, threshold: float) -> DataFrame:
    """(a, b) links of rows (task, side, node, shingles)."""
    dealt = dealt.repartition("task").sortWithinPartitions("task", "node")
    return dealt.mapInArrow(lambda b: _similar_links(b, threshold), "a long, b long")


def similar(docs: DataFrame, words: int = 5, threshold: float = 0.8, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, text_key, component_id) for every row: groups of documents linked by a Jaccard similarity of their distinct shingles.

    Candidates are what the deletion variants link and what shares a band of minima, since fingerprints of 64 bits
    are too far apart at 0.8; only coarse groups of candidates are compared, exactly. A group goes in blocks, each of
    which is compared in itself and with the group's ``pivots`` leaders, chosen by a hash. Of a group of several blocks, what this has not
    joined to its largest part is then compared with the whole group, in pairs of blocks: all links that could still join
    something, while a dense group costs its size and not its square.

    Equal sets are one node, texts without words are equal, and a null doc_id links with nothing. Shingles are compared by
    32 bits of their hashes.
    """
    found = stored(with_signatures(docs, words), "signatures")
    able = found.where("doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "text_key", "fp", "bands")).alias("f")
    owner = stored(able.groupBy("key").agg(first).select("key", "f.*", F.xxhash64("key").alias("node")), "nodes")
    nodes = owner.where("key IS NOT NULL")

    def band_links(batches):
        for key, node in sorted_runs(batches, 2):
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            first = np.repeat(node[cuts], np.diff(np.append(cuts, len(key))))
            yield pa.RecordBatch.from_arrays([pa.array(first[first != node]), pa.array(node[first != node])], names=["a", "b"])

    banded = nodes.select(F.explode("bands").alias("band"), "node").repartition("band").sortWithinPartitions("band", "node").mapInArrow(band_links, "a long, b long")
    coarse = stored(components(banded.union(near_links(nodes.select("fp", "node")))), "coarse")

    def sets(batches):
        enter("simhash")
        for batch in batches:
            for a, b in blocks(batch.column(2).to_pylist(), 500_000):
                texts = batch.column(2).slice(a, b - a).to_pylist()
                raw = [(shingle_set(t, words) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:2]), pa.array(raw, pa.binary())], names=["node", "component", "shingles"])

    named = coarse.join(nodes.select("node", "doc_id", "text_key"), "node")
    texts = docs.select(F.col("doc_id").alias("_id"), row_key().alias("_key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.dropDuplicates(["_id", "_key"]).join(named, (F.col("_id") == F.col("doc_id")) & (F.col("_key") == F.col("text_key"))).select("node", "component", "text")
    shingles = stored(texts.mapInArrow(sets, "node long, component long, shingles binary"), "shingles")

    leaders = [F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(pivots)]
    large = coarse.groupBy("component").agg(F.count("*").alias("n"), F.array(*leaders).alias("lead")).where(F.col("n") > block)
    large = large.select("component", F.ceil(F.col("n") / block).cast("long").alias("n"), "lead")
    dealt = shingles.join(large, "component", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    every = F.when(F.array_contains("lead", F.col("node")), F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("n"))))
    dealt = dealt.withColumn("i", F.explode(every))
    linked = stored(_compared(dealt.select(F.concat_ws(":", "component", "i").alias("task"), F.lit(0).alias("side"), "node", "shingles"), threshold), "links")
    parts = components(linked)
    # large groups: what is outside the largest part against everything
    part = coarse.join(large.select("component", "n"), "component").join(parts.select("node", F.col("component").alias("part")), "node", "left").withColumn("part", F.coalesce("part", "node"))
    part = stored(part, "parts")
    sizes = part.groupBy("component", "part").agg(F.count("*").alias("c"))
    main = sizes.groupBy("component").agg(F.max_by("part", F.struct("c", "part")).alias("main"), F.sum("c").alias("all"), F.max("c").alias("c"))
    main = main.where("all > c").select("component", "main", F.ceil((F.col("all") - F.col("c")) / block).cast("long").alias("m"))
    rest = shingles.join(part.drop("component"), "node").join(main, "component").withColumn("outside", F.col("part") != F.col("main"))
    own, other = F.pmod(F.xxhash64("node"), F.col("n")), F.pmod(F.xxhash64("node", F.lit(1)), F.col("m"))
    grid = lambda a, b, side: F.struct(a.alias("i"), b.alias("j"), F.lit(side).alias("side"))
    inside = F.transform(F.sequence(F.lit(0).cast("long"), F.col("m") - 1), lambda j: grid(own, j, 0))
    outside = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: grid(i, other, 1))
    rest = rest.withColumn("g", F.explode(F.when(F.col("outside"), F.concat(outside, inside)).otherwise(inside)))
    more = _compared(rest.select(F.concat_ws(":", "component", "g.i", "g.j").alias("task"), F.col("g.side").alias("side"), "node", "shingles"), threshold)
    fine = stored(components(linked.union(more)), "similar")
    grouped = owner.join(fine, "node", "left").withColumn("group", F.coalesce("component", "node"))
    least = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(least, "group").select("key", "component_id")
    out = found.select("doc_id", "text_key", F.col("key").alias("_key")).join(named, F.col("_key").eqNullSafe(F.col("key")), "left")
    return out.select("doc_id", "text_key", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_similar(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """One document of each group of similar documents, chosen as by ``keep_first``."""
    return _first_rows(docs, similar(docs, words, threshold))
