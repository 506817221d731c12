"""Batch plans: fixed chunks, rows per batch from a sample, halving of batches that are too large."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the sampling rule.
GOAL_BYTES = 2_500_000
SAMPLE_BYTES = 500_000
SMALL_INPUT_ROWS = 500
FALLBACK_ROWS = 10
MAX_BATCH_BYTES = 5 * 1024 * 1024


def with_batch_id(df: DataFrame, rows: int) -> DataFrame:
    """Adds batch_id: the row_id of the first row of the row's chunk of `rows`."""
    return df.withColumn("batch_id", F.col("row_id") - F.col("row_id") % rows)


def batch_plan(df: DataFrame) -> DataFrame:
    """(batch_id, n_rows), the last batch may be short."""
    return df.groupBy("batch_id").agg(F.count("*").alias("n_rows"))


def sampled_rows(lines: DataFrame, line: str, order: str, header_bytes: int) -> DataFrame:
    """One row, n_samples: rows per batch so that a batch is about GOAL_BYTES.

    The first SAMPLE_BYTES, header included, are measured. Less than three quarters of that means a small input:
    SMALL_INPUT_ROWS. If not even the header ends there, FALLBACK_ROWS; else the goal by the mean of the lines that begin
    there but the last, which is probably cut off, plus one.
    """
    first = lines.select(order, (F.octet_length(line) + 1).alias("bytes")).orderBy(order).limit(SAMPLE_BYTES)
    upto = F.sum("bytes").over(Window.orderBy(order)) + header_bytes
    got = first.withColumn("upto", upto).where(F.col("upto") - F.col("bytes") < SAMPLE_BYTES).agg(F.count("*").alias("n"), F.least(F.coalesce(F.max("upto"), F.lit(header_bytes)), F.lit(SAMPLE_BYTES)).alias("size"))
    mean = F.floor(F.col("size") / F.col("n"))
    return got.select(F.when(F.col("size") < 0.75 * SAMPLE_BYTES, F.lit(SMALL_INPUT_ROWS)).when(F.col("n") < 1, F.lit(FALLBACK_ROWS)).otherwise(F.floor(GOAL_BYTES / mean) + 1).cast("long").alias("n_samples"))


def halve(sizes: list[int], start: int, most: int) -> list[tuple[int, int, int]]:
    """(first row, rows, bytes) of the pieces: a batch of `most` bytes or more is cut at half its rows, again and again."""
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    out, todo = [], [(0, len(sizes))]
    while todo:
        a, z = todo.pop()
        if total[z] - total[a] >= most and z - a > 1:
            half = a + (z - a) // 2
            todo += [(half, z), (a, half)]
        else:
            out.append((start + a, z - a, total[z] - total[a]))
    return out


def split_plan(df: DataFrame, size: Column, most: int = MAX_BATCH_BYTES) -> DataFrame:
    """(batch_id, n_rows, n_bytes, oversize): what batches are sent as. One row that is too large alone is oversize.

    Only ids and sizes are grouped, at most a batch's rows at a time.
    """

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id")
        return pd.DataFrame(halve(pdf["size"].tolist(), int(pdf["batch_id"].iloc[0]), most), columns=["batch_id", "n_rows", "n_bytes"])

    pieces = df.select("batch_id", "row_id", size.cast("long").alias("size")).groupBy("batch_id").applyInPandas(split, "batch_id long, n_rows long, n_bytes long")
    return pieces.withColumn("oversize", F.col("n_bytes") >= most)


def oversize_rows(df: DataFrame, size: Column, most: int = MAX_BATCH_BYTES) -> DataFrame:
    """Rows that no batch can hold; they end as errors."""
    return df.where(size >= most)
