"""Secret scans: fixed patterns, and sliding-window entropy over long strings with an allow list.

Places come from one regular-expression scan a kind: the pieces between matches and the matches
themselves give each start, in code points. Candidates for the entropy scan are runs of 20 or more key
characters that hold a digit. A window of ``WINDOW`` characters slides over a candidate; entering and
leaving characters change their own counts only, and with them the sum of c*log2(c), from which the
entropy follows. A candidate whose highest window entropy reaches its class's threshold is a span,
unless the allow list knows it or a base span already covers it.

Defined results: null text is the empty text; a text without spans has the hash of the empty string
and an empty ``spans``; very long texts are scanned whole, in time that grows with their length; spans that start at one
place are listed in the order of ``KINDS``; repeated rows give repeated rows; an empty table gives no rows; other columns,
whatever their names, are dropped by ``secret_spans`` and carried by ``redact``.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted

#: Fixed values of the contract.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Highest entropy of a window from which a candidate is a secret, in bits, by class.
THRESHOLDS = {"hex": 3.0, "key": 3.9}
#: Long strings that are no secrets: UUIDs, dates with times, numbers, words joined by signs.
ALLOWED = (
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "^[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-]?[0-9-]*Z?$",
    "^[0-9+=_/-]+$",
    "^(?:[A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]{1,4})(?:[-_/+=]+(?:[A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]{1,4}))*[-_/+=]*$",
    "(?i)(?:example|placeholder|changeme|dummy)",
)
#: The characters that the counts know; any other cannot be in a candidate.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

#: Matches that are placed one after the other.
PART = 256
SPAN = "struct<kind:int,start:int,stop:int,value:string>"


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """All leftmost non-overlapping matches: kind, start, stop (code points) and the string. Matches go in parts of ``PART``:
    an array that grows by appending is copied each time, so only those of a part and the parts' starts grow that way."""
    none = F.array().cast(f"array<{SPAN}>")

    def within(part: Column, first: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            begin = a["at"] + F.length(x["gap"])
            stop = begin + F.length(x["hit"])
            span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), stop.alias("stop"), x["hit"].alias("value"))
            return F.struct(stop.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

        return F.aggregate(part, F.struct(first.alias("at"), none.alias("out")), step, lambda a: a["out"])

    def placed(found: Column) -> Column:
        pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("hit"))
        parts = _let(pairs, lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / PART).cast("int")), lambda k: F.slice(p, k * PART + 1, F.lit(PART))))
        width = lambda part: F.aggregate(part, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["hit"]))
        none_yet = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        firsts = lambda q: F.aggregate(q, none_yet, lambda a, part: F.struct((a["at"] + width(part)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        many = _let(parts, lambda q: F.flatten(F.zip_with(q, firsts(q), within)))
        return F.when(F.size(found) == 0, none).when(F.size(found) <= PART, within(pairs, F.lit(0))).otherwise(many)

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _weight(count: Column) -> Column:
    """c * log2(c) for the counts of a window."""
    return F.element_at(F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(WINDOW + 1)]), count + 1)


def highest_entropy(value: Column) -> Column:
    """The highest Shannon entropy of any window; shorter strings are below every threshold."""

    def slide(chars: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("least"), F.lit(0).alias("at"))

        def step(a: Column, c: Column) -> Column:
            gone = F.when(a["at"] >= WINDOW, F.get(chars, a["at"] - WINDOW)).otherwise(F.lit(-1))
            old, new = F.get(a["counts"], gone), F.get(a["counts"], c)

            def changed(same: Column) -> Column:
                less = F.when((gone >= 0) & ~same, _weight(old - 1) - _weight(old)).otherwise(F.lit(0.0))
                more = F.when((gone >= 0) & same, F.lit(0.0)).otherwise(_weight(new + 1) - _weight(new))
                return a["sum"] + less + more

            total = changed(gone == c)
            counts = F.transform(a["counts"], lambda n, k: n + (k == c).cast("int") - (k == gone).cast("int"))
            least = F.when(a["at"] >= WINDOW - 1, F.least(a["least"], total)).otherwise(a["least"])
            return F.struct(counts.alias("counts"), total.alias("sum"), least.alias("least"), (a["at"] + 1).alias("at"))

        return F.aggregate(chars, start, step, lambda a: F.lit(log2(WINDOW)) - a["least"] / WINDOW)

    return _let(F.transform(F.split(value, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c)), slide)


def _suspicious(span: Column, base: Column) -> Column:
    value = span["value"]
    known = F.lit(False)
    for pattern in ALLOWED:
        known = known | value.rlike(pattern)
    limit = F.when(value.rlike("^[0-9A-Fa-f]+$"), F.lit(THRESHOLDS["hex"])).otherwise(F.lit(THRESHOLDS["key"]))
    covered = F.exists(base, lambda b: (b["start"] <= span["start"]) & (span["stop"] <= b["stop"]))
    return F.when(~value.rlike("[0-9]") | known | covered, F.lit(False)).otherwise(highest_entropy(value) >= limit)


def secret_spans(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id (or the columns named in ``carry``), text, base and added: arrays of (kind, start, stop, value)."""
    carry = ["doc_id"] if carry is None else carry
    text = docs.select(*[quoted(c) for c in carry if c != "text"], F.coalesce("text", F.lit("")).alias("text"))
    t = F.col("text")
    long_enough = F.filter(_spans(t, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6)
    base = F.array_sort(F.concat(long_enough, _spans(t, ACCESS, 1), _spans(t, HEX, 2)), _by_place)
    found = text.withColumn("base", base).withColumn("_c", F.filter(_spans(t, CANDIDATE, 3), lambda s: s["value"].rlike("[0-9]")))
    return found.withColumn("added", F.filter("_c", lambda s: _suspicious(s, F.col("base")))).drop("_c")


def _by_place(x: Column, y: Column) -> Column:
    return F.when((x["start"] == y["start"]) & (x["kind"] == y["kind"]), F.lit(0)).when((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["kind"] < y["kind"])), F.lit(-1)).otherwise(F.lit(1))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """All columns of docs, with each maximal run of span characters in text replaced by ``mask``, of spans that touch or
    overlap together; null text stays null."""
    names = docs.columns
    inside = docs.select(F.struct(*[quoted(c) for c in names]).alias("row"), F.col("text"))
    found = secret_spans(inside, ["row"])
    spans = F.array_sort(F.concat("base", "added"), _by_place)
    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        lead = F.concat(F.substr(F.col("text"), F.greatest(a["at"], F.lit(0)) + 1, s["start"] - F.greatest(a["at"], F.lit(0))), F.lit(mask))
        out = F.when(s["start"] > a["at"], F.concat(a["out"], F.array(lead))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), out.alias("out"))

    clean = F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(F.col("text"), F.greatest(a["at"], F.lit(0)) + 1, F.length("text"))))
    text = F.when(F.col("row.text").isNull(), F.lit(None)).when(F.size("base") + F.size("added") == 0, F.col("text")).otherwise(clean)
    done = found.select("row", text.alias("_text"))
    return done.select(*[F.col("_text").alias("text") if c == "text" else F.col("row." + quoted(c)).alias(c) for c in names])
