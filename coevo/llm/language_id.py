"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 (seeded by its code point). A three-letter window binds its
letters' vectors by multiplying them, after rolling each by its place; a text's vector bundles (adds)
those of its windows, taken within words padded by one blank. A language's prototype adds up
the vectors of its training texts. The language is the prototype with the highest cosine.

A text's vector is the product of its window counts with the windows' vectors; windows are counted for a block of
texts at once, which costs one small matrix product; a block has a bounded number of texts. Prototype sums are whole
numbers, so they don't depend on how the input is cut. Only languages x dimensions numbers, the model itself, reach
the driver and are broadcast.

Defined results: null text and text without letters give ``und`` and score 0; without any training
rows every text is ``und``; equal cosines go to the language first in the alphabet; very long texts are profiled whole;
a null doc_id is kept (the query counts it as not held out); repeated rows get equal answers;
an empty table gives no rows; extra columns, whatever their names, are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, enter, keep

DIMENSIONS = 1024
_VECTORS: dict[tuple[int, int], np.ndarray] = keep("language", {})
_LETTERS: list[np.ndarray] = []


def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    if (code, dimensions) not in _VECTORS:
        if len(_VECTORS) > 20_000:
            _VECTORS.clear()
        _VECTORS[code, dimensions] = np.random.default_rng(code).integers(0, 2, dimensions, np.int8) * 2 - 1
    return _VECTORS[code, dimensions]


def _alphabetic() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, windows, text numbers): code points with the blank first, and for each letter of the texts the three numbers
    of its window, of the letter before, its own and the one after; where a word begins or ends the blank stands in."""
    lower = [t.lower() for t in texts]
    code = np.frombuffer(f" {' '.join(lower)} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _alphabetic()[code]
    at = np.flatnonzero(letter)
    ends = np.cumsum(np.fromiter(map(len, lower), np.int64, len(lower)) + 1)
    letters = np.flatnonzero(np.bincount(code[at], minlength=33))
    number = np.zeros(max(int(letters[-1]) + 1 if len(letters) else 0, 33), np.int64)
    number[letters] = np.arange(1, len(letters) + 1)
    value = np.zeros(len(code), np.int64)  # all that is no letter counts as a blank
    value[at] = number[code[at]]
    three = np.stack([value[at - 1], value[at], value[at + 1]])
    return np.concatenate([[32], letters]), three, np.searchsorted(ends, at, side="left")


def text_vectors(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """float64 rows of whole numbers, one per text."""
    enter("language")
    letters, three, doc = windows(texts)
    out = np.zeros((len(texts), dimensions))
    if not three.shape[1]:
        return out
    n = len(letters)
    code = (three[0] * n + three[1]) * n + three[2]
    if n**3 <= 1 << 22:  # a table of all windows is small
        found = np.flatnonzero(np.bincount(code, minlength=n**3))
        place = np.empty(n**3, np.int64)
        place[found] = np.arange(len(found))
        at = place[code]
    else:
        found, at = np.unique(code, return_inverse=True)
    base = np.stack([letter_vector(int(c), dimensions) for c in letters])
    rolled = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base
    for a in range(0, len(found), 4096):
        part = (at >= a) & (at < a + 4096) if len(found) > 4096 else slice(None)
        own = found[a:a + 4096]
        bound = rolled[0][own // n**2] * rolled[1][own // n % n] * rolled[2][own % n]
        counts = np.bincount(doc[part] * len(own) + at[part] - a, minlength=len(texts) * len(own)).reshape(len(texts), len(own))
        out += counts.astype(np.float32) @ bound.astype(np.float32)
    return out


def fit(docs: DataFrame, dimensions: int = DIMENSIONS, held: int = 1000) -> tuple[list[str], np.ndarray]:
    """(languages in order, one prototype row each) from the rows' text and lang. A task sums ``held`` languages at a time and
    passes its sums on when it meets more, so any number of labels gives the same prototypes."""

    def add(batches):
        sums: dict[str, np.ndarray] = {}

        def flush():
            for lang, s in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([s.astype("<i8").tobytes()], pa.binary())], names=["lang", "sums"])
            sums.clear()

        for batch in batches:
            texts, langs = [t or "" for t in batch.column(0).to_pylist()], np.array(batch.column(1).to_pylist(), object)
            for a, b in blocks(texts, 200_000, 1000):
                v = text_vectors(texts[a:b], dimensions)
                for lang in sorted(set(langs[a:b].tolist())):
                    if lang not in sums and len(sums) >= held:
                        yield from flush()
                    sums[lang] = sums.get(lang, 0) + v[langs[a:b] == lang].sum(0)
        yield from flush()

    def total(batches):
        now, sums = None, None
        for batch in batches:
            for lang, raw in zip(*[c.to_pylist() for c in batch.columns]):
                if lang != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([sums.tobytes()], pa.binary())], names=["lang", "sums"])
                    now, sums = lang, np.zeros(dimensions, "<i8")
                sums += np.frombuffer(raw, "<i8")
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([sums.tobytes()], pa.binary())], names=["lang", "sums"])

    parts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(add, "lang string, sums binary")
    rows = parts.repartition("lang").sortWithinPartitions("lang").mapInArrow(total, "lang string, sums binary").collect()
    rows = sorted(rows, key=lambda r: r.lang)
    sums = np.array([np.frombuffer(r.sums, "<i8") for r in rows], float).reshape(-1, dimensions)
    used = sums.any(axis=1)
    return [r.lang for r, u in zip(rows, used) if u], sums[used]


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score); score is the cosine, not below 0."""
    unit = prototypes / np.linalg.norm(prototypes, axis=1, keepdims=True) if len(langs) else prototypes
    shared = docs.sparkSession.sparkContext.broadcast((langs, unit))
    dimensions = prototypes.shape[1]

    def run(batches):
        names, unit = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in blocks(texts, 200_000, 1000):
                v = text_vectors(texts[a:b], dimensions)
                norm = np.linalg.norm(v, axis=1)
                cos = v @ unit.T / np.maximum(norm, 1e-30)[:, None] if names else np.zeros((b - a, 1))
                best = cos.argmax(1)
                none = (norm == 0) | (not names)
                pred = ["und" if x else names[k] for x, k in zip(none.tolist(), best.tolist())]
                score = np.where(none, 0.0, np.clip(cos[np.arange(b - a), best], 0, 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(pred, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")
