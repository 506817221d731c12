"""CSV sinks: one file in row_id order, or a folder of parts; exact minimal quoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillscore.functions.scalar import csv_line


def lines(df: DataFrame, delimiter: str = ",") -> Column:
    """The row as one CSV line, as the sink and request payloads write it."""
    return csv_line([F.col(f"`{c}`") for c in df.columns], delimiter)


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The parts that a sink has written, in order."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = [str(f.getPath()) for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(f for f in found if f.rsplit("/", 1)[1].startswith("part-"))


def write_csv(df: DataFrame, path: str, delimiter: str = ",", order: str | None = None, single: bool = False, mode: str = "errorifexists", header: bool = True) -> None:
    """Write df; parts by range of `order`, or one file where a reader needs one (a single task then writes it all)."""
    if order:
        df = df.orderBy(order)
    if single:
        df = df.coalesce(1) if not order else df.repartition(1).sortWithinPartitions(order)
    df.write.mode(mode).options(header=str(header).lower(), sep=delimiter, quote='"', escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
