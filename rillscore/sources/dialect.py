"""Encoding, delimiter and quoting of a delimited file, found on the driver from a bounded sample."""

from __future__ import annotations

import csv
import re
import statistics
from dataclasses import dataclass

#: Names that stand for delimiters, and the delimiters that are allowed.
KEYWORDS = {"tab": "\t", "\\t": "\t", "pipe": "|"}
ALLOWED = (";", ",", "|", "\t", " ", "!", "  ")
SAMPLE_BYTES = 1_000_000
FAST_SAMPLE_BYTES = 200_000
FIELD_LIMIT = 131_072


@dataclass(frozen=True)
class Dialect:
    delimiter: str = ","
    quotechar: str = '"'
    doublequote: bool = True
    escapechar: str | None = None
    skipinitialspace: bool = False

    def reader_options(self) -> dict[str, str]:
        return {"sep": self.delimiter, "quote": self.quotechar, "escape": self.escapechar or self.quotechar, "ignoreLeadingWhiteSpace": str(self.skipinitialspace).lower(), "ignoreTrailingWhiteSpace": "false"}


def delimiter_of(name: str | None) -> str | None:
    """A delimiter given by keyword or as itself; anything else is an error."""
    if name is None:
        return None
    d = KEYWORDS.get(name, name)
    if d not in ALLOWED:
        raise ValueError(f"delimiter {name!r} is not one of {', '.join(map(repr, ALLOWED))}")
    return d


def candidates(sample: str, lines: int = 20, quote: str = '"') -> list[str]:
    """Non-word characters that occur equally often, and at all, on each of the first full lines, outside quotes."""
    rows, row, quoted = [], [], False
    for ch in sample:
        if ch == quote:
            quoted = not quoted
        elif ch == "\n" and not quoted:
            rows.append(row)
            row = []
            if len(rows) == lines:
                break
        elif not quoted and not re.match(r"\w", ch) and ch != "\r":
            row.append(ch)
    if not rows:
        return []
    chars = {c for r in rows for c in r}
    return sorted(c for c in chars if all(r.count(c) > 0 for r in rows) and (len(rows) < 2 or statistics.stdev(r.count(c) for r in rows) == 0))


def sniff(sample: str, delimiter: str | None = None, skip: bool = False) -> Dialect:
    """The sample's dialect. skip takes the common one (with the delimiter, if given) without looking."""
    if skip:
        return Dialect(delimiter or ",")
    if not sample.strip():
        raise ValueError("the sample is empty: no dialect")
    try:
        found = csv.Sniffer().sniff(sample, delimiters=delimiter)
    except csv.Error:
        only = [delimiter] if delimiter else candidates(sample)
        if len(only) != 1:
            raise ValueError(f"cannot tell the delimiter, candidates: {only}") from None
        return Dialect(only[0])
    return Dialect(delimiter or found.delimiter, found.quotechar or '"', True, None, bool(found.skipinitialspace))


def encoding_of(sample: bytes, declared: str | None = None) -> str:
    """The declared encoding, or the sample's: a byte order mark, UTF-8 if it decodes, else what a detector says."""
    if declared:
        return declared.lower()
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if sample.startswith(mark):
            return name
    for cut in range(4):  # the sample may end inside a character
        try:
            sample[: len(sample) - cut].decode("utf-8")
            return "utf-8"
        except UnicodeDecodeError:
            continue
    try:
        from charset_normalizer import from_bytes

        best = from_bytes(sample).best()
        return best.encoding.lower() if best else "windows-1252"
    except ImportError:
        return "windows-1252"
