"""Scalar expressions that several stages use; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT_ID = "^[A-Fa-f0-9]{24}$"


def split_line(line: Column, delimiter: str) -> Column:
    """Cells of a raw line, line end removed; empty last cells stay (a trailing TAB is a cell, not white space)."""
    return F.split(F.regexp_replace(line, "[\\r\\n]+$", ""), "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E", -1)


def csv_cell(c: Column, delimiter: str = ",") -> Column:
    """A cell as a minimally quoting CSV writer puts it; null is empty."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    special = text.contains(delimiter) | text.contains('"') | text.contains("\n") | text.contains("\r")
    return F.when(special, F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_line(columns: list[Column], delimiter: str = ",") -> Column:
    return F.concat_ws(delimiter, *[csv_cell(c, delimiter) for c in columns])


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def round_half_away(c: Column, digits: int) -> Column:
    """A double rounded as C does, ties away from zero: they are told on c * 10^digits, and zero keeps its sign.

    Spark's round tells ties on the shortest decimal form of c instead, so that 2003.5 * 0.001 becomes 2.004 and not 2.003.
    """
    scaled = c * F.lit(10.0**digits)
    whole = F.round(scaled)  # a tie of a double is exact here
    return F.when(F.abs(scaled) == float("inf"), c).when(whole == 0.0, scaled * 0.0).otherwise(whole / F.lit(10.0**digits))


def sort_labels(values: Column, numeric: bool = False) -> Column:
    """array<struct<label, value>> by label: numerically for numeric labels, else by code point."""
    key = (lambda v: v["label"].cast("double")) if numeric else (lambda v: v["label"])
    by = F.transform(values, lambda v: F.struct(key(v).alias("k"), v["label"].alias("label"), v["value"].alias("value")))
    return F.transform(F.array_sort(by), lambda v: F.struct(v["label"].alias("label"), v["value"].alias("value")))


def run_key(*parts: object) -> str:
    """Identity of a run from everything that determines its output, dataset and deployment included."""
    import hashlib

    return hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()
