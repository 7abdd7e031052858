"""Quality rules as a learned decision list, applied as one Spark conditional expression.

Statistics of every whole text come from DataFrame functions. The list is learned by sequential
covering on a bounded sample of labelled documents (``sample_rows``, chosen by a hash of doc_id):
grow a conjunction of thresholds by information gain on two thirds of the rows, prune its last
conditions on the other third, keep the rule if it is precise there, remove what it covers, go on.
The rules become ordered CASE WHEN branches; rows that none covers are kept.

Defined results: null text has no words (all counts 0, base_failed, not kept); labels that are null or
whose document is missing teach nothing; without labels of both kinds the list is empty, and only
base_failed rejects; very long texts are measured whole; of conditions with equal gain the first in the order of
``FEATURES`` and of values is taken; a null doc_id is judged but teaches nothing; repeated rows are judged alike; an empty
table gives no rows; extra columns, whatever their names, are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract.
SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

FEATURES = {
    "symbol_rate": "n_symbols / n_words",
    "dup_line_rate": "n_dup_lines / n_lines",
    "repeat_rate": "n_repeat_words / n_words",
    "mean_word": "word_chars / n_words",
    "upper_rate": "n_upper / word_chars",
    "bang_rate": "n_bang / n_words",
    "distinct_rate": "n_distinct / n_words",
    "words": "n_words",
}


def _let(value: Column, body) -> Column:
    """body(value) with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def _without(chars: str) -> Column:
    return F.length(F.translate("text", chars, ""))


def _repeated(words: Column) -> Column:
    """Words in 3-word windows that stand twice or more in the text: sort the windows, keep those
    equal to a neighbour, and count the words that their places cover."""

    def of(w: Column) -> Column:
        m = F.size(w) - 2
        windows = F.arrays_zip(F.slice(w, F.lit(1), m).alias("a"), F.slice(w, F.lit(2), m).alias("b"), F.slice(w, F.lit(3), m).alias("c"), F.sequence(F.lit(1), m).alias("at"))
        return F.when(m < 2, F.lit(0)).otherwise(_let(F.sort_array(windows), covered))

    def same(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: ((k > 0) & same(x, F.get(s, k - 1))) | ((k < F.size(s) - 1) & same(x, F.get(s, k + 1))))
        places = F.sort_array(F.transform(twice, lambda x: x["at"]))
        start = F.struct(F.lit(-9).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(places, start, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")), lambda a: a["n"])

    return _let(words, of)


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text."""
    upper = "".join(map(chr, range(65, 91)))
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def counts(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(w)).cast("long").alias("n_distinct"), _repeated(w).cast("long").alias("n_repeat_words"))

    def line_counts(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    got = text.select(
        "doc_id", _let(words, counts).alias("_w"), _let(lines, line_counts).alias("_l"),
        _without(BLANKS).cast("long").alias("word_chars"),
        *[(F.length("text") - _without(c)).cast("long").alias(n) for n, c in (("n_symbols", SYMBOLS), ("n_upper", upper), ("n_bang", "!?"))])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return got.select("doc_id", "_w.*", "_l.*", "word_chars", "n_symbols", "n_upper", "n_bang").withColumn("base_failed", failed)


def with_features(stats: DataFrame) -> DataFrame:
    return stats.select("*", *[F.expr(f"coalesce(try_divide({x.split(' / ')[0]}, {x.split(' / ')[1]}), 0D)" if " / " in x else f"cast({x} as double)").alias(n) for n, x in FEATURES.items()])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    value: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.value!r}D"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)


def learn_list(rows: list[tuple[list[float], bool]], names: list[str], most_rules: int = 12, most_conditions: int = 3, cuts: int = 24, precision: float = 0.9, least: int = 5) -> list[Rule]:
    """Rules for the true class, in order. Row sets are bit masks, so a condition's cover is one AND and a count."""
    n = len(rows)
    bad = sum(1 << k for k, (_, y) in enumerate(rows) if y)
    everything = (1 << n) - 1
    grow = sum(1 << k for k in range(n) if k % 3) if n >= 30 else everything
    prune = everything & ~grow if n >= 30 else everything
    options: list[tuple[Condition, int]] = []
    for f, name in enumerate(names):
        values = sorted({x[f] for x, y in rows if y})
        order = sorted(range(n), key=lambda k: rows[k][0][f])
        for v in sorted({values[(len(values) - 1) * c // cuts] for c in range(cuts + 1)} if values else []):
            low = sum(1 << k for k in order if rows[k][0][f] <= v)
            options += [(Condition(name, False, v), low), (Condition(name, True, v), everything & ~low)]
    rules: list[Rule] = []
    left = everything
    while len(rules) < most_rules and (left & bad & grow).bit_count() >= least:
        taken: list[tuple[Condition, int]] = []
        cover = left
        while len(taken) < most_conditions:
            p0, n0 = (cover & bad & grow).bit_count(), (cover & ~bad & grow).bit_count()
            if not n0:
                break
            best, gain = None, 0.0
            for condition, mask in options:
                p = (cover & mask & bad & grow).bit_count()
                if p < least:
                    continue
                q = (cover & mask & ~bad & grow).bit_count()
                g = p * (log2(p / (p + q)) - log2(p0 / (p0 + n0)))
                if g > gain + 1e-9:
                    best, gain = (condition, mask), g
            if best is None:
                break
            taken.append(best)
            cover &= best[1]

        def worth(k: int) -> float:
            m = left & prune
            for _, mask in taken[:k]:
                m &= mask
            p, q = (m & bad).bit_count(), (m & ~bad).bit_count()
            return (p - q) / (p + q) if p + q else -1.0

        if not taken:
            break
        keep = max(range(1, len(taken) + 1), key=lambda k: (worth(k), -k))
        cover = left
        for _, mask in taken[:keep]:
            cover &= mask
        p, q = (cover & bad).bit_count(), (cover & ~bad).bit_count()
        if not p or p < precision * (p + q) or worth(keep) < 2 * precision - 1:
            break
        rules.append(Rule(tuple(c for c, _ in taken[:keep]), p / (p + q)))
        left &= ~cover
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000) -> list[Rule]:
    """Rules that reject: learned where quality is 0 against 1, on at most ``sample_rows`` labelled documents."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", "quality")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    stats = with_features(text_statistics(docs.join(F.broadcast(chosen), "doc_id", "left_semi")))
    names = list(FEATURES)
    # filtered and sorted on the driver, over sample_rows at most: Spark would push the filter below the semi-join
    # and so compute the statistics of all rows, and a sort would sample its input and compute them once more
    got = stats.join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id").alias("_h"), "doc_id", "quality", "base_failed", *names).collect()
    got = sorted((r for r in got if not r.base_failed), key=tuple)
    return learn_list([([float(r[n]) for n in names], r.quality == 0) for r in got], names)


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional expression; base_failed comes first."""
    out = F.when(F.col("base_failed"), F.lit(False))
    for r in rules:
        out = out.when(F.expr(r.sql()), F.lit(False))
    return out.otherwise(F.lit(True))


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    stats = with_features(text_statistics(docs))
    return stats.withColumn("kept", verdict(rules))
