"""Global 0-based row ids in the order of given keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillscore.operators.scratch import written

ROWS_A_TASK = 1_000_000
BYTES_A_TASK = 64_000_000


def tasks_of(df: DataFrame, size: Column, most: int = BYTES_A_TASK) -> int:
    """How many tasks df's rows, of `size` bytes each, are for when none is to have much more than `most`."""
    return max(1, math.ceil((df.agg(F.sum(size.cast("long"))).first()[0] or 0) / most))


def with_row_id(df: DataFrame, *keys: str, rows_a_task: int = ROWS_A_TASK, name: str = "row_id") -> DataFrame:
    """Adds row_id: contiguous from 0 in the order of keys (of any orderable types, unique together).

    The rows are dealt by ranges of all keys, so that no task has much more than rows_a_task of them and one frequent
    first key is no hot range, and sorted there. A row's id is its place in its partition plus the rows of the partitions
    before. The places are written once, since ranges found again by sampling could differ; the counts are one row a
    partition. A single partition needs neither.
    """
    parts = math.ceil(df.count() / rows_a_task)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    if parts <= 1:
        return df.repartition(1).sortWithinPartitions(*keys).withColumn(name, place)
    dealt = written(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumns({"_part": F.spark_partition_id(), "_place": place}))
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return dealt.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_place")).cast("long")).drop("_part", "_place", "_before")  # a row per partition


def with_row_id_of_wide(df: DataFrame, *keys: str, parts: int, name: str = "row_id") -> DataFrame:
    """As with_row_id, for rows too wide to be sorted a million a task and written: only the keys are numbered.

    Each key's first id meets its rows in one of `parts` hash partitions. A key that several rows share, or null, has as
    many ids as rows, so no row is lost or doubled.
    """
    firsts = with_row_id(df.select(*keys), *keys, name=name).groupBy(*keys).agg(F.min(name).alias("_first"))
    both = df.withColumn("_first", F.lit(None).cast("long")).unionByName(firsts, allowMissingColumns=True).repartition(parts, *keys)
    after = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_first")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = both.withColumn(name, F.first("_first").over(after) + F.row_number().over(after) - 2)
    return told.where("_first IS NULL").drop("_first")
