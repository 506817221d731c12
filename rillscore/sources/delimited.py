"""Delimited text as DataFrames of strings, parsed (slow) or split by line (fast), plain or gzipped."""

from __future__ import annotations

import csv
import io
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillscore.functions.scalar import split_line
from rillscore.sources.dialect import FAST_SAMPLE_BYTES, FIELD_LIMIT, SAMPLE_BYTES, Dialect, encoding_of, sniff

SPARK_CHARSETS = {"US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32"}
JAVA_NAMES = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "utf_8": "UTF-8", "utf-16": "UTF-16", "latin-1": "ISO-8859-1", "latin1": "ISO-8859-1", "ascii": "US-ASCII", "cp1252": "windows-1252", "cp1250": "windows-1250", "cp1251": "windows-1251"}


#: A line as Spark's line reader cuts it: other characters that some call line ends are part of it.
LINE = "[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+$"


def sample_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    """The first n bytes of the (unpacked) file, read on the driver through Spark's file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    f = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        data = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(spark._jvm.org.apache.commons.io.input.BoundedInputStream(f, n)))
    finally:
        f.close()
    return zlib.decompressobj(31).decompress(data, n) if path.endswith(".gz") else data


def header_names(line: list[str]) -> list[str]:
    return [c.strip() for c in line]


def column_names(header: list[str]) -> list[str]:
    """Names that Spark can hold: blank headers get a position name, of duplicates the last one keeps the name."""
    last = {c: i for i, c in enumerate(header)}
    return [c if c and last[c] == i else f"_{i}" for i, c in enumerate(header)]


def check_single_lines(sample: str, dialect: Dialect, lines: int = 100) -> None:
    """Fast mode needs one record a line: the first records must be as many as the physical lines they stand on."""
    text = re.findall(LINE, sample)[: lines + 1]
    records = list(csv.reader(io.StringIO("".join(text)), delimiter=dialect.delimiter[0], quotechar=dialect.quotechar))
    if len(records) != len(text):
        raise ValueError("a record spans several lines: this file cannot be read line by line")


class DelimitedSource:
    """A delimited file with its encoding, dialect and header; nothing is read from it but a sample until a scan runs."""

    def __init__(self, spark: SparkSession, path: str, delimiter: str | None = None, encoding: str | None = None, skip_dialect: bool = False, fast: bool = False, field_limit: int = FIELD_LIMIT, multi_line: bool = True):
        """multi_line=False promises that no record spans lines: a parsed scan is then split, else a task reads a whole file."""
        self.spark, self.path, self.fast, self.field_limit, self.multi_line = spark, path, fast, field_limit, multi_line
        raw = sample_bytes(spark, path, FAST_SAMPLE_BYTES if fast else SAMPLE_BYTES)
        self.encoding = encoding_of(raw, encoding)
        self.sample = raw.decode(self.encoding, "ignore" if len(raw) >= FAST_SAMPLE_BYTES else "strict")
        self.dialect = sniff(self.sample, delimiter, skip_dialect)
        rows = csv.reader(io.StringIO(self.sample, newline=""), delimiter=self.dialect.delimiter[0], quotechar=self.dialect.quotechar)
        self.header = header_names(next(rows, []))
        self.columns = column_names(self.header)
        if next((r for r in rows if r), None) is None:
            raise ValueError(f"Input file '{path}' is empty.")
        if self.charset().upper() not in SPARK_CHARSETS:
            spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # else Spark's readers refuse it
        if fast or not multi_line:
            check_single_lines(self.sample, self.dialect)

    def charset(self) -> str:
        return JAVA_NAMES.get(self.encoding, self.encoding)

    def scan(self) -> DataFrame:
        """All data rows as strings in file order within a split: _line, the columns, and _cells (how many were found).

        Parsed mode drops empty lines, as a parser does; a line of blanks is a row of one cell. Fast mode keeps every
        line after the header, equal ones to the header too. Empty cells are empty strings, not nulls. A cell over the
        limit is an error when it is read.
        """
        return self._fast() if self.fast else self._parsed()

    def _parsed(self) -> DataFrame:
        schema = ", ".join(f"`{c}` STRING" for c in self.columns)
        options = {**self.dialect.reader_options(), "encoding": self.charset(), "multiLine": str(self.multi_line).lower(), "mode": "PERMISSIVE", "maxCharsPerColumn": str(self.field_limit), "emptyValue": "", "nullValue": "\x00", "header": "true", "enforceSchema": "true"}
        df = self.spark.read.schema(schema).options(**options).csv(self.path)
        return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in self.columns])

    def _fast(self) -> DataFrame:
        text = self.spark.read.text(self.path).select("value", F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
        # The header is the first line of the file's first block, whatever other lines are equal to it.
        header = text.where("_start = 0").select("_at").take(1)[0][0]
        text = text.where(F.col("_at") != header).select("value")
        if self.charset() != "UTF-8":  # the line reader hands over bytes as they are
            if self.charset().startswith("UTF-"):
                raise ValueError(f"fast mode cannot split {self.encoding} into lines")
            text = text.select(F.decode(F.col("value").cast("binary"), self.charset()).alias("value"))
        cells = split_line(F.col("value"), self.dialect.delimiter)
        rows = text.select(cells.alias("c"), "value")
        wide = F.exists("c", lambda c: F.length(c) > self.field_limit)
        rows = rows.withColumn("c", F.when(wide, F.raise_error(F.lit(f"a cell is longer than {self.field_limit} characters")).cast("array<string>")).otherwise(F.col("c")))
        return rows.select(F.col("value").alias("_line"), *[F.coalesce(F.get("c", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(self.columns)], F.size("c").alias("_cells"))

    def check_cells(self, df: DataFrame) -> DataFrame:
        """Fast rows must have as many cells as the header if columns are kept: raises on the first that does not."""
        n = len(self.columns)
        return df.where(F.when(F.col("_cells") == n, F.lit(True)).otherwise(F.raise_error(F.format_string(f"expected {n} cells, found %d", "_cells")).cast("boolean")))


def drop_empty_lines(df: DataFrame, text: str) -> DataFrame:
    """A row per non-empty line of a text column; a line of blanks is kept."""
    return df.withColumn("line", F.explode(F.split(text, "\r\n|\r|\n"))).where("line <> ''")


def peek(df: DataFrame, order: str) -> DataFrame:
    """The first row, for the schema and the validation call."""
    return df.orderBy(order).limit(1)
