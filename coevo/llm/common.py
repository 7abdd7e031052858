"""Shared helpers: inputs, tables in the shared folder, a word-keyed feature cache."""

from __future__ import annotations

import ctypes
import gc
import sys
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.residues import quote_identifier as quoted
from ..sources.shared import delete_tables, shared_dir, stored  # noqa: F401 (used by the operators)

#: What a Python worker keeps between tasks, by the operator that needs it.
_KEPT: dict[str, list] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(operator: str, held):
    """Register a dict or list that ``operator`` keeps between tasks; returns it."""
    _KEPT.setdefault(operator, []).append(held)
    return held


def enter(operator: str) -> None:
    """Called as a task begins: a worker that served other operators before lets go of what they kept."""
    other = [h for name, kept in _KEPT.items() if name != operator for h in kept if h]
    if not other:
        return
    for h in other:
        h.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def row_key(text: str = "text"):
    """A hash of the text that tells rows of one doc_id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(quoted(text)), F.lit("")))


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id (null like any other) and text are among gone's (doc_id, text_key)."""
    left = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), F.col("doc_id").alias("_id"), row_key().alias("_key"))
    gone = gone.select(F.col("doc_id").alias("_id2"), F.col("text_key").alias("_key2")).distinct()
    left = left.join(gone, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")), "left_anti")
    return left.select(*[F.col("row." + quoted(c)).alias(c) for c in docs.columns])


class WordTable(dict):
    """word -> row number of a growing flat table of small arrays, one per word.

    ``make(words)`` returns one 1-d array per word. Words repeat far more often than they are
    new, so the costly function runs once per distinct word and worker. The table is emptied
    when it holds ``most`` words, which bounds its memory.
    """

    def __init__(self, make, dtype, most: int = 300_000):
        super().__init__()
        self.make, self.dtype, self.most = make, dtype, most
        self._reset()

    def _reset(self):
        self.clear()
        self.pending: list[str] = []
        self.flat = np.empty(1 << 16, self.dtype)
        self.used = 0
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)

    def __missing__(self, word):
        self.pending.append(word)
        n = self[word] = len(self)
        return n

    def _fill(self):
        arrays = self.make(self.pending)
        sizes = np.fromiter(map(len, arrays), np.int64, len(arrays))
        n, total = len(self), int(sizes.sum())
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while len(self.start) < n:
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        if total:
            self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(arrays), self.dtype, total)
        ends = self.used + np.cumsum(sizes)
        self.start[n - len(arrays):n] = ends - sizes
        self.size[n - len(arrays):n] = sizes
        self.used += total
        self.pending = []

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' arrays one after the other, and each word's length."""
        if len(self) > self.most:
            self._reset()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.pending:
            self._fill()
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        take = np.arange(total) + np.repeat(self.start[at] - (ends - size), size)
        return self.flat[take], size


def blocks(texts: list, most: int = 2_000_000, rows: int = 100_000):
    """(first, after) ranges of texts with about ``most`` characters and at most ``rows`` texts each."""
    first, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= most or k + 1 - first >= rows:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def split_blank(text: str) -> list[str]:
    """Words between spaces, tabs and line ends; other white space stays inside a word."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def per_document(table: WordTable, texts: list[str], split):
    """The texts' word arrays, joined: (flat values, values per text)."""
    words: list[str] = []
    counts = np.empty(len(texts), np.int64)
    gc.disable()  # millions of short-lived strings, no cycles
    try:
        for k, t in enumerate(texts):
            w = split(t)
            counts[k] = len(w)
            words += w
        flat, size = table.rows(words)
    finally:
        gc.enable()
    ends = np.concatenate([[0], np.cumsum(size)])
    cut = np.concatenate([[0], np.cumsum(counts)])
    return flat, ends[cut[1:]] - ends[cut[:-1]]
