"""BPE encoding and decoding with a public tokenizer file.

A text longer than ``LEAF`` characters is encoded as a tree: it is cut into leaves of that many characters, wherever the
cut falls, each leaf is encoded on its own, and neighbours are joined level by level, so that all leaves, and all joins of
a level, could run side by side. A join re-encodes a window around the seam and lets it grow until what it begins and
ends with is what the two sides have there. There are two kinds of seam:

- Between words the tokenizer never merges. The window grows to the next blank on either side; both sides agree if
  their pieces (letter runs, single digits, runs of other signs) next to the seam are those of the window's two halves, and
  the pieces in the window then replace them.
- Within a piece of more than ``LONG`` characters (long unsplit text) the same is done with tokens: a token sequence is the
  BPE encoding of its text exactly if each two neighbours are an encoding of their own text, so agreement on one
  token on either side makes the join exact.

Each distinct short piece is encoded once per worker and looked up in the leaves and windows.

Defined results: null text is the empty text; empty text gives no ids; very long texts are encoded whole; repeated rows
give repeated rows; extra columns, whatever their names, are dropped; the row order is not kept; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordTable, blocks, enter, keep, per_document, split_blank

#: Characters of a leaf of a text; of the longest piece that is encoded at once, and of a leaf of longer ones.
LEAF, LONG, PIECE_LEAF = 2048, 2048, 512
_ENCODERS: dict[str, "Encoder"] = keep("tokens", {})

#: Lower-case letters, numbers and white space up to U+017F, where no two characters compose (so NFC
#: changes nothing); texts beyond take the library's own normalizer and splitter.
_L = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_N}]|[^\\t-\\r \x85\xa0{_L}{_N}]+")
#: Blanks at which the tokenizer always cuts.
BLANKS = " \t\n\r"
_BEYOND = re.compile("[^\x00-\u017f]")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself, or the next free one from U+0100."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """Exact ids for whole texts; one per Python worker and tokenizer file."""

    def __init__(self, path: str, most_words: int = 300_000, leaf: int = LEAF, long: int = LONG, piece_leaf: int = PIECE_LEAF):
        from tokenizers import Tokenizer, models

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.outer = models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix, cache_capacity=0)
        # without the word-end mark, for text that goes on
        self.inner = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)
        self.letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.strings = {i: s for s, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.leaf, self.long, self.piece_leaf = leaf, long, piece_leaf
        self.joins = {"text": 0, "piece": 0}
        self.pieces = WordTable(self._new, np.uint32, most_words)

    def _new(self, pieces: list[str]) -> list[list[int]]:
        tokens, long = self.outer.tokenize, self.long
        return [[t.id for t in tokens(p)] if p.isascii() and p.isalpha() and len(p) <= long else self._piece(p) for p in pieces]

    def _piece(self, piece: str) -> list[int]:
        """Ids of one piece, given in lower case and not yet as byte letters."""
        if piece in self.special:
            return [self.special[piece]]
        text = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.letters)
        return [i for i, _ in self._tree(text)] if len(text) > self.long else [t.id for t in self.outer.tokenize(text)]

    def split(self, text: str) -> list[str]:
        """The pieces of a text in lower case, special tokens as they are."""
        if self.cut and "<|" in text and self.cut.search(text):
            return [p for part in self.cut.split(text) if part for p in ([part] if part in self.special else self.split(part))]
        if not text.isascii() and _BEYOND.search(text):
            plain = self.tokenizer.normalizer.normalize_str(text)
            return [plain[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
        out: list[str] = []
        add, add_all, cut = out.append, out.extend, _PIECES.findall
        for w in split_blank(text.lower()):
            if w.isalpha():
                add(w)
            elif w:
                head = w[:-1]
                if w[-1] in ".,!?" and head.isalpha():
                    add(head)
                    add(w[-1])
                else:
                    add_all(cut(w))
        return out

    def tree(self, text: str) -> list[str]:
        """The pieces of a whole text, by leaves and joins."""
        if len(text) <= self.leaf:
            return self.split(text)
        level = [(a, self.split(text[a:a + self.leaf])) for a in range(0, len(text), self.leaf)]
        ends = [*(a for a, _ in level[1:]), len(text)]
        while len(level) > 1:
            joined, new = [], []
            for k in range(0, len(level) - 1, 2):
                joined.append((level[k][0], self._seam(text, level[k], level[k + 1], ends[k + 1])))
                new.append(ends[k + 1])
            if len(level) % 2:
                joined.append(level[-1])
                new.append(ends[-1])
            level, ends = joined, new
        return level[0][1]

    def _seam(self, text: str, left: tuple[int, list[str]], right: tuple[int, list[str]], stop: int) -> list[str]:
        self.joins["text"] += 1
        start, before = left
        seam, after = right
        wide = 16
        while True:
            a, b = max(start, seam - wide), min(stop, seam + wide)
            begin = max(text.rfind(c, a, seam) for c in BLANKS) + 1
            end = min((k for c in BLANKS if (k := text.find(c, seam, b)) >= 0), default=-1)
            if (begin or a == start) and (end >= 0 or b == stop):
                begin, end = max(begin, a), end if end >= 0 else stop
                tail, head = self.split(text[begin:seam]), self.split(text[seam:end])
                kept = len(before) - len(tail)
                if before[kept:] == tail and after[:len(head)] == head:
                    return before[:kept] + self.split(text[begin:end]) + after[len(head):]
            wide *= 2

    def encode(self, texts: list[str]):
        """(ids of all texts one after the other, ids per text)."""
        return per_document(self.pieces, texts, self.tree)

    def decode(self, ids) -> str:
        return " ".join([self.strings[i] for i in ids])

    def _tokens(self, text: str, last: bool) -> list[tuple[int, int]]:
        """(id, characters) of a piece; last: the piece ends its word."""
        got = (self.outer if last else self.inner).tokenize(text)
        out = [(t.id, len(t.value)) for t in got]
        if last and out:
            out[-1] = (out[-1][0], out[-1][1] - len(self.suffix))
        return out

    def _tree(self, text: str) -> list[tuple[int, int]]:
        if len(text) <= self.piece_leaf:
            return self._tokens(text, True)
        starts = list(range(0, len(text), self.piece_leaf))
        level = [self._tokens(text[s:s + self.piece_leaf], s == starts[-1]) for s in starts]
        while len(level) > 1:
            joined, new = [], []
            for k in range(0, len(level), 2):
                if k + 1 == len(level):
                    joined.append(level[k])
                    new.append(starts[k])
                    continue
                right_end = starts[k + 2] if k + 2 < len(starts) else len(text)
                joined.append(self._join(text, level[k], level[k + 1], starts[k + 1], right_end == len(text)))
                new.append(starts[k])
            level, starts = joined, new
        return level[0]

    def _join(self, text: str, left: list, right: list, seam: int, last: bool) -> list:
        self.joins["piece"] += 1
        wide = 4
        while True:
            a, b = min(wide, len(left)), min(wide, len(right))
            begin = seam - sum(n for _, n in left[len(left) - a:])
            end = seam + sum(n for _, n in right[:b])
            at_end = last and b == len(right)
            window = self._tokens(text[begin:end], at_end)
            if (a == len(left) or window[0] == left[-a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[:len(left) - a] + window + right[b:]
            wide *= 2


def encoder(path: str) -> Encoder:
    enter("tokens")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded_blocks(path: str, texts: list):
    """(first, after, ids, ids per text) for blocks of texts of bounded size."""
    enc = encoder(path)
    texts = ["" if t is None else t for t in texts]
    for a, b in blocks(texts):
        ids, counts = enc.encode(texts[a:b])
        yield a, b, ids, counts


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary little-endian uint32, n_tokens, decoded string) of every whole text."""

    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            key, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b, ids, counts in encoded_blocks(tokenizer, texts):
                ends = np.cumsum(counts)
                parts = [ids[e - n:e] for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [key.slice(a, b - a), pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()), pa.array(counts, pa.int64()),
                     pa.array([enc.decode(p.tolist()) for p in parts], pa.string())],
                    names=[id_col, "ids", "n_tokens", "decoded"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, n_tokens long, decoded string")


def decode_ids(df: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) from binary little-endian uint32 ids."""

    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            out = [enc.decode(np.frombuffer(b or b"", "<u4").tolist()) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[id_col, "decoded"])

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded string")
