"""Removal of repeated byte strings by per-shard suffix arrays.

An input shard is a block of documents. Its suffix array is built by Larsson-Sadakane refinement (order by the first 7 bytes
or more, then sort only the groups that are still equal by the rank of what follows, doubling the depth) and Kasai's common
prefixes, of which only those that don't follow from the position before are compared. Windows with a common prefix of
100 bytes are equal: all but the earliest repeat it and become spans at once, so one place per distinct window leaves an
input shard.

What is left meets the windows of other input shards. Every 100-byte window belongs to its smallest 24-byte gram by hash (the
first of equals), so equal windows belong to equal grams wherever they stand; consecutive windows of one gram form a
segment of at most 176 bytes, and segments are dealt to merge tasks by their gram. A gram that a sample of documents
shows to be so common that its segments would swamp a task is dealt by the window's smallest other gram as well. A
merge task drops segments whose gram stands in one place only, builds a suffix array for each run of input shards'
segments, and merges the runs pairwise: binary search finds one side's windows in the other's sorted windows, byte by
byte, the later of two equal windows repeats the earlier, and the earlier ones stay as one sorted list. It does so whenever
it holds ``MERGE_BYTES``, and goes on with the windows that are left, so copies of one passage don't add up in memory.

Order is (doc_id, then 32 bits of the text's hash for rows that share a doc_id, start). Defined results: null text is empty;
texts under 100 bytes are left whole; very long texts go in pieces that together hold every window once; a null doc_id
comes before all others; rows equal in doc_id and text are one place, so they get the same spans and none for repeating
each other; an empty table gives no rows; extra columns are carried by ``remove_repeats`` in the struct ``row``, whatever their names.
"""

from __future__ import annotations

import struct
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import enter, quoted

LENGTH, GRAM = 100, 24
#: Bytes of documents packed together, and in an input shard, which has its own suffix array.
BLOCK_BYTES, INPUT_BYTES = 3 << 19, 1 << 18
#: Bytes of segments in one suffix array of a merge task, and held before it merges them.
RUN_BYTES, MERGE_BYTES = 1 << 19, 6 << 20
#: Bytes of segments that a merge task is planned for.
SHARD_BYTES = 12 << 20
#: Documents in the sample that shows which grams are common.
SAMPLE_ROWS = 20_000
#: Documents, and characters of each, from which the compression dictionary of that many bytes is made.
PRESS_ROWS, PRESS_CHARS, PRESS_BYTES = 500, 2000, 112 << 10

_RNG = np.random.default_rng(4)
_BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64)
_STEP = _RNG.integers(1 << 62, 1 << 63, 8, np.uint64) | np.uint64(1)
_OTHER = _RNG.integers(1, 1 << 63, 1, np.uint64)[0] | np.uint64(1)


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 24 bytes from each position: those of 16 bytes and of the 16 that end 8 later."""
    h = _BYTE[buf]
    with np.errstate(over="ignore"):
        for level, k in enumerate((1, 2, 4, 8, 8)):
            x = h[:-k] * _STEP[level]
            x += h[k:]
            x ^= x >> np.uint64(29)
            h = x
        h *= _STEP[7]
        h ^= h >> np.uint64(32)
    return h


def _smallest(grams: np.ndarray) -> np.ndarray:
    """The place of the smallest gram of the window from each position, by the upper 40 bits, then the first."""
    low = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
    k = 1
    while k < 64:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    low = np.minimum(low[:-13], low[13:])  # 77 grams begin in a window
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)


def _anchors(buf: np.ndarray, step: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """(gram hash from each position, smallest gram's place of the window from each position), in parts that stay in cache."""
    grams, anchor = np.empty(len(buf) - GRAM + 1, np.uint64), np.empty(len(buf) - LENGTH + 1, np.int64)
    for a in range(0, len(anchor), step):
        part = gram_hashes(buf[a:a + step + LENGTH - 1])
        grams[a:a + len(part)] = part
        anchor[a:a + step] = _smallest(part) + a
    return grams, anchor


def _windows(n: int, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of n positions begin a window of a string."""
    edge = np.zeros(n + 1, np.int8)
    whole = sizes >= LENGTH
    edge[starts[whole]] = 1
    edge[(starts + sizes)[whole] - LENGTH + 1] = -1
    return np.cumsum(edge[:n], dtype=np.int8).view(bool)


def segments(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, mask: np.ndarray | None = None, hot: np.ndarray | None = None):
    """(dealing key, gram's place, first window, last window, document) of each segment, in order, of documents joined in
    buf. mask: the windows to keep, of those there are. hot: sorted gram hashes whose windows are dealt by another gram too."""
    grams, anchor = _anchors(buf)
    at = np.flatnonzero(_windows(len(buf), starts, sizes) if mask is None else mask)
    a = anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)  # windows of two documents are never neighbours
    key = None
    if hot is not None and len(hot):
        key = grams[a]
        common = np.isin(key, hot)
        if common.any():
            with np.errstate(over="ignore"):
                rest = grams * _OTHER
                rest[np.isin(grams, hot)] = np.uint64((1 << 64) - 1)
                second = rest[_smallest(rest)[at]] | np.uint64(1)
                key = np.where(common, (key ^ second) * _OTHER, key)
            new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    doc = np.searchsorted(starts, at[first], side="right") - 1
    return grams[a[first]] if key is None else key[first], a[first], at[first], at[last], doc


def _take(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The strings of buf one after the other."""
    data = buf.tobytes()
    return np.frombuffer(b"".join([data[a:b] for a, b in zip(start.tolist(), (start + size).tolist())]), np.uint8)


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """The number of each row's class of equal keys, in key order."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new)
    return which


def _steps(x: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Differences of neighbours, which pack better; each part's first stays."""
    out = np.diff(x, prepend=0)
    out[begins] = x[begins]
    return out


def _edges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and after-last positions of the maximal runs of set flags."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def press_words(docs: DataFrame) -> bytes:
    """A dictionary for what is compressed on its way, made from the first characters of a few documents, so that short blobs
    shrink as well: the more merge tasks there are, the less each block has for one. It changes sizes only, no result.
    Empty where there is too little to make it from."""
    import zstandard

    rows = docs.select(F.substring("text", 1, PRESS_CHARS).alias("t")).where("length(t) >= 100").limit(PRESS_ROWS).collect()
    texts = [r.t.encode() for r in rows]
    if sum(map(len, texts)) < 2 * PRESS_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(PRESS_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # texts that are all alike
        return b""


def _press(level: int, words: bytes):
    import zstandard

    if not words:
        return zstandard.ZstdCompressor(level=level)
    known = zstandard.ZstdCompressionDict(words)
    known.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=known)


def _unpress(words: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)) if words else zstandard.ZstdDecompressor()


def _order(first: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of each window of strings that stand one after the other, from that of their first windows; -1: no window."""
    order = np.repeat(first - starts, sizes)
    order += np.arange(len(order))
    order[~_windows(len(order), starts, sizes)] = -1
    return order


def pack_block(buf: np.ndarray, starts, sizes, doc_id, doc_key, shards: int, shift=0, hot: np.ndarray | None = None, input_bytes: int = INPUT_BYTES, words: bytes = b""):
    """(shard, blob) rows of a block of input shards: the spans of windows that repeat an earlier one of their input shard,
    and segments of the others, one place each. shift: where each piece begins in its document."""
    press = _press(3, words)
    shift = np.zeros(len(sizes), np.int64) + shift
    if not (sizes >= LENGTH).any():
        return
    rank = _ranks(doc_id, doc_key) << 32
    repeats, left = np.zeros(len(buf), bool), np.zeros(len(buf), bool)
    k, ends = 0, starts + sizes
    while k < len(starts):
        after = max(k + 1, int(np.searchsorted(ends, starts[k] + input_bytes, side="right")))
        lo, hi = int(starts[k]), int(ends[after - 1])
        run = Run(buf[lo:hi], _order(rank[k:after] + shift[k:after], starts[k:after] - lo, sizes[k:after]))
        repeats[lo:hi] = run.repeats
        left[run.heads + lo] = True
        k = after
    del run
    first, after = _edges(repeats)
    if len(first):
        doc = np.searchsorted(starts, first, side="right") - 1
        own = shift[doc] - starts[doc]
        parts = [doc_id[doc].astype("<i8"), doc_key[doc].astype("<u4"), (first + own).astype("<i8"), (after - first).astype("<u4")]
        yield int(doc_key[0]) % shards, press.compress(b"S" + struct.pack("<I", len(first)) + b"".join(p.tobytes() for p in parts))
    key, anchor, first, last, doc = segments(buf, starts, sizes, left, hot)
    shard = (key >> np.uint64(40)).astype(np.int64) % shards
    by = np.argsort(shard, kind="stable")
    shard, anchor, first, doc = shard[by], (anchor - first)[by], first[by], doc[by]
    size = last[by] - first + LENGTH
    begins = np.flatnonzero(np.diff(shard, prepend=-1))
    cuts = np.append(begins, len(by)).tolist()
    next_ = np.diff(doc, prepend=-1) != 0  # documents stand in order in each blob, so steps of 0 and 1 number them
    next_[begins] = True
    docs = doc[next_]
    doc_cuts = np.append(np.cumsum(next_)[begins] - 1, len(docs)).tolist()
    pos = _steps(first - (starts - shift)[doc], begins).astype("<u4")
    ids, keys = _steps(doc_id[docs], np.array(doc_cuts[:-1], np.int64)).astype("<i8"), doc_key[docs].astype("<u4")
    next_[begins] = False
    small, data, ends = (size.astype("u1"), anchor.astype("u1"), next_.view("u1"), pos), _take(buf, first, size).data, np.append(0, np.cumsum(size)).tolist()
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        x, y = doc_cuts[k:k + 2]
        parts = [struct.pack("<2I", b - a, y - x), *(p[a:b].tobytes() for p in small), ids[x:y].tobytes(), keys[x:y].tobytes(), data[ends[a]:ends[b]]]
        yield int(shard[a]), press.compress(b"T" + b"".join(parts))


class Segments(NamedTuple):
    """Strings of consecutive windows with one place each; ``anchor`` is where the gram begins in the string."""

    gram: np.ndarray
    size: np.ndarray
    anchor: np.ndarray
    doc_id: np.ndarray
    doc_key: np.ndarray
    pos: np.ndarray
    data: np.ndarray

    def pick(self, rows: np.ndarray) -> "Segments":
        start = np.cumsum(self.size) - self.size
        return Segments(*(x[rows] for x in self[:6]), _take(self.data, start[rows], self.size[rows]))

    def strings(self) -> np.ndarray:
        """The strings as numpy bytes, padded with zeros."""
        wide = int(self.size.max(initial=1))
        out = np.zeros((len(self.size), wide), np.uint8)
        out[np.arange(wide) < self.size[:, None]] = self.data
        return out.view(f"S{wide}").ravel()


def _joined(parts: list[Segments]) -> Segments:
    return Segments(*(np.concatenate(x) for x in zip(*parts))) if len(parts) != 1 else parts[0]


def _grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``gram_hashes`` of the given places alone."""
    out = np.empty(len(at), np.uint64)
    for a in range(0, len(at), 4096):
        part = at[a:a + 4096]
        h = _BYTE[np.lib.stride_tricks.sliding_window_view(data, GRAM)[part].T]
        with np.errstate(over="ignore"):
            for level in range(5):
                left, right = (h[::2], h[1::2]) if level < 3 else (h[:-1], h[1:])
                h = left * _STEP[level]
                h += right
                h ^= h >> np.uint64(29)
            h = h[0] * _STEP[7]
            h ^= h >> np.uint64(32)
        out[a:a + 4096] = h
    return out


def _summed(steps: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What ``_steps`` was made from, of parts of the given sizes that stand one after the other."""
    out = np.cumsum(steps, dtype=steps.dtype)
    return out - np.repeat(out[begins] - steps[begins], sizes)


def _unpack(blobs: list[bytes]) -> Segments:
    """The segments of all blobs, read together, as there may be many with few segments."""
    fields: list[list[bytes]] = [[] for _ in range(7)]
    counts = []
    for raw in blobs:
        n, docs = counts_ = struct.unpack_from("<2I", raw, 1)
        counts.append(counts_)
        at = 9
        for field, size in zip(fields, (n, n, n, 4 * n, 8 * docs, 4 * docs, len(raw))):
            field.append(raw[at:at + size])
            at += size
    size, anchor, next_, pos, ids, keys, data = (np.frombuffer(b"".join(x), kind) for x, kind in zip(fields, ("u1", "u1", "u1", "<u4", "<i8", "<u4", "u1")))
    n, docs = np.array(counts, np.int64).T
    begins = np.cumsum(n) - n
    doc = np.cumsum(next_, dtype=np.int64) + np.repeat(np.arange(len(blobs)), n)  # a blob's first segment has a step of 0
    ids = _summed(ids, np.cumsum(docs) - docs, docs)
    size, anchor = size.astype(np.int64), anchor.astype(np.int64)
    gram = _grams(data, np.cumsum(size) - size + anchor)
    return Segments(gram, size, anchor, ids[doc], keys[doc].astype(np.int64), _summed(pos, begins, n).astype(np.int64), data)


def _unpack_spans(raw: bytes):
    n, at, out = struct.unpack_from("<I", raw, 1)[0], 5, []
    for kind in ("<i8", "<u4", "<i8", "<u4"):
        out.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
        at += n * int(kind[2])
    ids, keys, first, length = out
    return ids, keys, first, first + length


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, zeros after the text, as numbers whose lowest byte comes first."""
    w = np.concatenate([text, np.zeros(7, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        w = w[:-k] | (w[k:] << np.uint64(8 * k))
    return w


def _first_letters(text: np.ndarray) -> tuple[np.ndarray, int]:
    """(number of the first letters from each position, in the order of the suffixes, how many letters): bytes that occur are
    numbered from 1, in as few bits as they need, and 0 stands after the text."""
    used = np.bincount(text, minlength=256) > 0
    bits = int(used.sum()).bit_length()
    depth = 63 // bits
    part = np.concatenate([np.cumsum(used).astype(np.uint64)[text], np.zeros(depth, np.uint64)])
    key, have, k = None, 0, 1
    while True:
        if depth & k:  # the number of k letters goes before what there is
            key = part if key is None else (part[:-have or None][:len(key) - k] << np.uint64(bits * have)) | key[k:]
            have += k
        k *= 2
        if k > depth:
            return key[:len(text)], depth
        part = (part[:-k // 2] << np.uint64(bits * k // 2)) | part[k // 2:]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes of text in order, by Larsson-Sadakane refinement. It goes to the end, as Kasai's bound needs the full order."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    key, h = _first_letters(text)
    sa = np.argsort(key)
    key = key[sa]
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    size = np.diff(last, prepend=-1)
    place = np.repeat(last, size)
    rank = np.zeros(n + 1, np.int64)  # of a group: its last place, from 1; 0 is the rank of what is after the text
    rank[sa] = place + 1
    open_ = np.flatnonzero(np.repeat(size > 1, size))
    own, place = sa[open_], place[open_]
    bits = n.bit_length()
    low = (1 << bits) - 1
    while len(open_):
        if 3 * bits <= 63:  # all in one number sorts faster than an order does
            key = (((place << bits) | rank[own + h]) << bits) | own
            key.sort()
            own = key & low
            key >>= bits
        else:
            key = place * (n + 1) + rank[own + h]
            order = np.argsort(key)
            own, key = own[order], key[order]
        last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
        size = np.diff(last, prepend=-1)
        place = np.repeat(open_[last], size)
        sa[open_] = own
        rank[own] = place + 1
        more = np.repeat(size > 1, size)
        open_, own, place = open_[more], own[more], place[more]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Kasai: for each place in sa, the common prefix with the suffix before it, up to ``most``. Where the byte before both
    suffixes is equal, the prefix is that of the position before, less one; only the others are compared, in steps that double."""
    n = len(text)
    if not n:
        return np.zeros(0, np.uint8)
    before = text[sa - 1]
    ask = np.ones(n, bool)
    ask[1:] = before[1:] != before[:-1]
    first = int(np.flatnonzero(sa == 0)[0])
    ask[first:first + 2] = True  # position 0 has nothing before it
    ask = np.flatnonzero(ask)[1:]
    a, b = sa[ask], sa[ask - 1]
    words = _words(text)
    differ = words[a] ^ words[b]
    h = (np.bitwise_count((differ & np.negative(differ)) - np.uint64(1)) >> 3).astype(np.int64)
    live = np.flatnonzero(h == 8)
    wide, padded = 16, np.concatenate([text, np.zeros(4096, np.uint8)])
    longest = n - np.maximum(a, b)
    while len(live):
        rows, going = np.lib.stride_tricks.sliding_window_view(padded, wide), []
        for k in range(0, len(live), (1 << 20) // wide):  # the arrays of one step stay small
            own = live[k:k + (1 << 20) // wide]
            differ = rows[a[own] + h[own]] != rows[b[own] + h[own]]
            equal = differ.argmax(axis=1)
            equal[~differ[np.arange(len(own)), equal]] = wide
            h[own] += equal
            going.append(own[(equal == wide) & (h[own] < longest[own])])
        live = np.concatenate(going)
        wide = min(2 * wide, 4096)
    np.minimum(h, longest, out=h)
    end = np.zeros(n, np.int64)
    end[a] = a + h
    end[sa[0]] = sa[0]
    end = np.maximum.accumulate(end)  # where a common prefix ends never falls from one position to the next
    end -= np.arange(n)
    return np.minimum(end, most, out=end).astype(np.uint8)[sa]


class Run:
    """One suffix array: which windows of text repeat an earlier one, and the earliest of each group of equal windows, in
    suffix order. order: the order of each window (-1: no window)."""

    def __init__(self, text: np.ndarray, order: np.ndarray):
        sa = suffix_array(text)
        same = common_prefixes(text, sa) >= LENGTH
        own = order[sa]
        kept = own >= 0
        self.repeats = np.zeros(len(text), bool)
        alike = same.copy()  # suffixes of groups of two and more
        alike[:-1] |= same[1:]
        alike = np.flatnonzero(alike)
        group = np.cumsum(~same[alike])
        windows = kept[alike]
        alike, group = alike[windows], group[windows]
        if len(alike):
            own = own[alike]
            cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            least = np.repeat(np.minimum.reduceat(own, cuts), np.diff(np.append(cuts, len(own))))
            self.repeats[sa[alike[own > least]]] = True
            earliest = np.flatnonzero(own == least)
            _, at = np.unique(group[earliest], return_index=True)  # places may stand in text twice
            kept[alike] = False
            kept[alike[earliest[at]]] = True
        self.heads = sa[kept]


def _search(data: np.ndarray, heads: np.ndarray, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of the windows ``ask`` among ``heads``, which are in suffix order: (place, whether the window there is equal)."""
    rows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    word = lambda at: np.ascontiguousarray(rows[at, :8]).view(">u8").ravel().astype(np.uint64)
    string = lambda at: rows[at].view(f"S{LENGTH}").ravel()
    own, asked = word(heads), word(ask)
    low, high = np.searchsorted(own, asked), np.searchsorted(own, asked, side="right")
    same = np.zeros(len(ask), bool)
    for a in range(0, len(ask), 16384):
        lo, hi = low[a:a + 16384], high[a:a + 16384]
        end, want = hi.copy(), string(ask[a:a + 16384])
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            less = string(heads[mid]) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        at = np.flatnonzero(lo < end)
        same[a + at] = string(heads[lo[at]]) == want[at]
    return low, same


class Merge:
    """Suffix arrays of runs of ``data``, merged by binary search. ``order`` is the order of each window (-1: no window)."""

    def __init__(self, data: np.ndarray, order: np.ndarray, cuts: list[int]):
        self.data, self.order = data, order
        self.repeats = np.zeros(len(data), bool)
        level = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            run = Run(data[a:b], order[a:b])
            self.repeats[a:b] = run.repeats
            level.append(run.heads + a)
        while len(level) > 1:
            level = [self._pair(*level[k:k + 2]) for k in range(0, len(level), 2)]
        self.heads = level[0]

    def _pair(self, a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
        """The distinct windows of two sorted lists in order; the later of two equal windows repeats the earlier."""
        if b is None or not len(b):
            return a
        if len(a) < len(b):
            a, b = b, a
        low, same = _search(self.data, a, b)
        mine, theirs = a[low[same]], b[same]
        later = self.order[mine] > self.order[theirs]
        self.repeats[mine[later]] = True
        self.repeats[theirs[self.order[mine] < self.order[theirs]]] = True
        a = a.copy()
        a[low[same][later]] = theirs[later]
        return np.insert(a, low[~same], b[~same])


def _merge(held: Segments, run_bytes: int):
    """Yields the spans of windows that repeat an earlier one, returns segments of the windows that are left."""
    _, which, often = np.unique(held.gram, return_inverse=True, return_counts=True)
    many = often[which] > 1
    alone, some = np.flatnonzero(~many), np.flatnonzero(many)
    if not len(some):
        return held
    own = held.pick(some)
    # equal strings first: in suffix order, the later places of a string repeat its earliest
    order = (_ranks(own.doc_id, own.doc_key) << 32) + own.pos
    string = own.strings()
    by = np.argsort(string, kind="stable")  # merges what is in order already by binary search
    new = np.ones(len(by), bool)
    new[1:] = (string[by][1:] != string[by][:-1]) | (own.size[by][1:] != own.size[by][:-1])
    del string
    cuts = np.flatnonzero(new)
    least = np.repeat(np.minimum.reduceat(order[by], cuts), np.diff(np.append(cuts, len(by))))
    late = by[order[by] > least]
    yield own.doc_id[late], own.doc_key[late], own.pos[late], own.pos[late] + own.size[late] - LENGTH + 1
    early = by[order[by] == least]
    early = np.sort(early[np.unique(np.cumsum(new)[order[by] == least], return_index=True)[1]])
    _, which, often = np.unique(own.gram[early], return_inverse=True, return_counts=True)
    many = often[which] > 1
    alone, own = _joined([held.pick(alone), own.pick(early[~many])]), own.pick(early[many])
    if not len(own.size):
        return alone
    ends = np.cumsum(own.size)
    begin = ends - own.size
    order = _order((_ranks(own.doc_id, own.doc_key) << 32) + own.pos, begin, own.size)
    cuts = [0]
    while cuts[-1] < len(own.data):
        cuts.append(max(int(ends[np.searchsorted(ends, cuts[-1] + run_bytes, side="right") - 1]), int(ends[np.searchsorted(ends, cuts[-1], side="right")])))
    merged_ = Merge(own.data, order, cuts)
    first, after = _edges(merged_.repeats)
    k = np.searchsorted(ends, first, side="right")
    yield own.doc_id[k], own.doc_key[k], own.pos[k] + first - begin[k], own.pos[k] + after - begin[k]
    left = np.zeros(len(own.data), bool)
    left[merged_.heads] = True
    first, after = _edges(left)
    k = np.searchsorted(ends, first, side="right")
    size = after - first + LENGTH - 1
    rest = Segments(own.gram[k], size, own.anchor[k] - (first - begin[k]), own.doc_id[k], own.doc_key[k], own.pos[k] + first - begin[k], _take(own.data, first, size))
    return _joined([alone, rest])


def shard_repeats(blobs, run_bytes: int = RUN_BYTES, merge_bytes: int = MERGE_BYTES, words: bytes = b""):
    """(doc_id, doc_key, first window, after last window) arrays of all windows of a merge task that repeat an earlier one."""
    press = _unpress(words)
    left: list[Segments] = []
    held: list[bytes] = []
    size, most = 0, merge_bytes
    for blob in blobs:
        raw = press.decompress(blob)
        if raw[:1] == b"S":
            yield _unpack_spans(raw)
            continue
        held.append(raw)
        n, docs = struct.unpack_from("<2I", raw, 1)
        size += len(raw) - 9 - 7 * n - 12 * docs  # bytes of strings
        if size > most:
            new, held = _unpack(held), []
            left = [(yield from _merge(_joined([*left, new]), run_bytes))]
            del new
            size = len(left[0].data)
            most = max(merge_bytes, 2 * size)
    if held:
        left.append(_unpack(held))
    if left:
        yield from _merge(_joined(left), run_bytes)


def _pieces(batches, block_bytes: int):
    """(doc_id, text_key, where it begins, bytes) of texts of 100 bytes or more; a text longer than a block goes in pieces
    that share no window."""
    from xxhash import xxh64_intdigest

    for batch in batches:
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_buffer()
            if t is None or t.size < LENGTH:
                continue
            t = t.to_pybytes()
            key = xxh64_intdigest(t, 42) & 0xFFFFFFFF
            for at in range(0, len(t) - LENGTH + 1, block_bytes):
                yield -(1 << 63) if k is None else k, key, at, t[at:at + block_bytes + LENGTH - 1]


def common_grams(docs: DataFrame, n_docs: int, total_bytes: int, shard_bytes: int = SHARD_BYTES, sample_rows: int = SAMPLE_ROWS, block_bytes: int = BLOCK_BYTES) -> np.ndarray:
    """Sorted hashes of grams by which segments of more than two merge tasks' size would be dealt, by a sample of about
    ``sample_rows`` documents chosen by a hash. They decide only how work is dealt, no result; at most a few of a
    document's grams can be that common, so what the driver gets is bounded by the sample."""
    share = 2 * shard_bytes / max(total_bytes * 7 / 2, 1)
    seen = min(n_docs, sample_rows)
    if share >= 1 or not seen:
        return np.empty(0, np.uint64)
    parts = max(1, n_docs // sample_rows)

    def grams(batches):
        for _, _, _, piece in _pieces(batches, block_bytes):
            found = np.unique(segments(np.frombuffer(piece, np.uint8), np.array([0]), np.array([len(piece)]))[0]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["gram"])

    sample = docs.select("doc_id", "text").where(F.pmod(F.xxhash64("text"), F.lit(parts)) == 0)
    mean = max(total_bytes / max(n_docs, 1), 1.0)
    least = max(3, int(share * seen * mean * 3.5 / 140))
    rows = sample.mapInArrow(grams, "gram long").groupBy("gram").count().where(F.col("count") >= least).select("gram").collect()
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def repeated_spans(docs: DataFrame, shards: int | None = None, block_bytes: int = BLOCK_BYTES, hot: np.ndarray | None = None, words: bytes = b"") -> DataFrame:
    """(doc_id, text_key, spans): spans as start * 2^32 + stop of repeated bytes, several a document, not yet merged."""
    if shards is None:
        total, n = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("text")).first()
        shards = max(64, -(-int(total) * 7 // 2 // SHARD_BYTES))
        hot = common_grams(docs, n, int(total)) if hot is None else hot

    known = docs.sparkSession.sparkContext.broadcast(words)  # of fixed size

    def pack(batches):
        enter("suffix")
        held: list[tuple] = []
        size = 0

        def flush():
            ids, keys, shift, texts = zip(*held)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            buf = np.frombuffer(b"".join(texts), np.uint8)
            for shard, blob in pack_block(buf, np.cumsum(sizes) - sizes, sizes, np.array(ids, np.int64), np.array(keys, np.int64), shards, np.array(shift), hot, words=known.value):
                yield shard, blob

        def batch_of(rows):
            shard, blob = zip(*rows) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(blob, pa.binary())], names=["shard", "blob"])

        for piece in _pieces(batches, block_bytes):
            if held and size + len(piece[3]) > block_bytes:
                yield batch_of(list(flush()))
                held, size = [], 0
            held.append(piece)
            size += len(piece[3])
        if held:
            yield batch_of(list(flush()))

    def find(batches):
        enter("suffix")
        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1))))
        for _, own in groupby(rows, key=itemgetter(0)):
            for ids, keys, start, stop in shard_repeats((blob for _, blob in own), words=known.value):
                span = (start << 32) | (stop - 1 + LENGTH)
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == -(1 << 63)), pa.array(keys), pa.array(span)], names=["doc_id", "text_key", "span"])

    blobs = docs.select("doc_id", "text").mapInArrow(pack, "shard long, blob binary")
    spans = blobs.repartition("shard").sortWithinPartitions("shard").mapInArrow(find, "doc_id long, text_key long, span long")
    return spans.groupBy("doc_id", "text_key").agg(F.collect_list("span").alias("spans"))


def merged(spans: list[int] | np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of packed spans."""
    out: list[list[int]] = []
    for x in sorted(spans):
        start, stop = x >> 32, x & 0xFFFFFFFF
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _squeezed(batches, words: bytes):
    """The fourth column compressed, so that texts take little room on their way to the join."""
    press = _press(3, words)
    for batch in batches:
        packed = [press.compress(b) for b in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], names=["row", "_id", "_key", "_bytes"])


def _whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs widened to the borders of UTF-8 characters that they cut."""
    out: list[tuple[int, int]] = []
    for a, b in runs:
        while a > 0 and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, shards: int | None = None, block_bytes: int = BLOCK_BYTES, characters: bool = False, hot: np.ndarray | None = None) -> DataFrame:
    """row (docs' columns but the text), removed (array of start, stop in bytes) and kept (the remaining bytes of the text).
    characters: a character that loses some of its bytes goes whole."""
    words = press_words(docs)
    known = docs.sparkSession.sparkContext.broadcast(words)
    found = repeated_spans(docs, shards, block_bytes, hot, words)
    left = docs.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF)))
    left = left.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), F.col("doc_id").alias("_id"), "_key", F.coalesce("text", F.lit("")).cast("binary").alias("_bytes")).drop("text")
    left = left.withColumn("row", F.col("row").dropFields("text")) if len(docs.columns) > 1 else left
    left = left.mapInArrow(lambda b: _squeezed(b, known.value), left.schema)
    right = found.select(F.col("doc_id").alias("_id2"), F.col("text_key").alias("_key2"), "spans")
    both = left.join(right, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")), "left")

    def cut(batches):
        press = _unpress(known.value)
        for batch in batches:
            kept, removed = [], []
            for packed, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = press.decompress(packed)
                runs = merged(spans) if spans else []
                runs = _whole_characters(data, runs) if characters else runs
                at, parts = 0, []
                for a, b in runs:
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                kept.append(b"".join(parts) if runs else data)
                removed.append([{"start": a, "stop": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], names=["row", "kept", "removed"])

    row = both.select("row", "_bytes", "spans")
    span = StructType([StructField("start", LongType()), StructField("stop", LongType())])
    return row.mapInArrow(cut, StructType([row.schema["row"], StructField("kept", BinaryType()), StructField("removed", ArrayType(span))]))


def without_repeats(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """docs with the remaining bytes as text; a character that lost some of its bytes goes whole, all others stay. Null text stays null."""
    extra = "_null"
    while extra in docs.columns:
        extra += "_"
    done = remove_repeats(docs.withColumn(extra, F.col("text").isNull()), shards, characters=True)
    text = F.when(~F.col(f"row.`{extra}`"), F.col("kept").cast("string"))
    return done.select(*[text.alias("text") if c == "text" else F.col("row." + quoted(c)).alias(c) for c in docs.columns])
