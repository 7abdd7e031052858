"""Column functions on residues, descriptions, names and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Residue letters in code order (-20 to 20), the code of any other sign, job states.
ALPHABET = "acdefghiklmnpqrstvwy-ACDEFGHIKLMNPQRSTVWY"
INVALID = 21
STATES = {-1: "NOOPT", 0: "DONE", 1: "RUNNING", 2: "PENDING", 3: "RETRYING", 4: "FAILED"}
#: The parts of a sequence description, in the order in which they stand.
PARTS = ("OS", "OX", "GN", "PE", "SV")


def encode(seq: Column) -> Column:
    """array<int> of residue codes; a dot is a gap."""
    signs = F.split(F.translate(seq, ".", "-"), "")
    codes = F.array(*[F.lit(k) for k in (INVALID, *range(-20, 21))])
    return F.transform(signs, lambda c: F.get(codes, F.call_function("instr", F.lit(ALPHABET), c)))


def invalid(seq: Column) -> Column:
    """Whether a string has a sign that is no residue and no gap."""
    return seq.rlike(f"[^{ALPHABET.replace('-', '')}.-]")


def gap_signs(seq: Column) -> Column:
    return F.length(seq) - F.length(F.translate(seq, "-.", ""))


def decode(codes: Column) -> Column:
    letters = F.array(*map(F.lit, ALPHABET))
    return F.array_join(F.transform(codes, lambda c: F.coalesce(F.get(letters, c + 20), F.lit("X"))), "")


def describe(description: Column) -> Column:
    """struct os, ox, gn, pe, sv. A part goes to the next blank before a later part, or to the end, blanks within it included;
    all are null without OS, and one that is missing is null."""
    lead, *rest = PARTS
    pattern = f"{lead}=(.*?)" + "".join(f"(?:\\s{p}=(.*?))?" for p in rest) + "$"
    part = lambda k: F.nullif(F.regexp_extract(description, pattern, k), F.lit(""))
    return F.struct(part(1).alias("os"), part(2).try_cast("int").alias("ox"), part(3).alias("gn"), part(4).alias("pe"), part(5).alias("sv"))


def gaps(codes: Column) -> Column:
    return F.size(F.filter(codes, lambda c: c == 0))


def matches(a: Column, b: Column) -> Column:
    """Places at which two code arrays agree; gaps agree with gaps."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def name_hash(name: Column) -> Column:
    """The first four bytes of the name's SHA-256."""
    return F.unhex(F.substring(F.sha2(name, 256), 1, 8))


def fan_out(name: Column) -> Column:
    h = F.sha2(name, 256)
    return F.concat_ws("/", F.substring(h, 1, 2), F.substring(h, 3, 2), name)


def state_name(status: Column) -> Column:
    out = F.lit(None)
    for k, v in STATES.items():
        out = F.when(status == k, F.lit(v)).otherwise(out)
    return out


def quote_identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def search_threshold(length: Column, per_residue: float) -> Column:
    """The score that a homologue search takes as its threshold, as text."""
    return (length * F.lit(per_residue)).cast("string")


def option(options: Column, key: str, default: float) -> Column:
    """A number of a map of options, or the default."""
    return F.coalesce(F.element_at(options, F.lit(key)), F.lit(default))
