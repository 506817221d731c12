"""A scoring run: source, row ids, batch plan, what the journal leaves, scorer, projection, sink, journal, report."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rillscore.functions.scalar import run_key
from rillscore.operators.batching import MAX_BATCH_BYTES, split_plan, with_batch_id
from rillscore.operators.journal import RunJournal, account, pending
from rillscore.operators.project import Output, project, project_legacy
from rillscore.operators.scorers import HttpScorer, Scorer


log = logging.getLogger("rillscore")


@dataclass
class RunReport:
    rows_planned: int
    rows_done: int
    rows_lost: int
    batches_missing: int
    errors_fixed: int
    counters: dict | None = None

    @property
    def exit_code(self) -> int | None:
        return 1 if self.rows_lost or self.batches_missing else None


def score_table(df: DataFrame, scorer: Scorer, out: Output, legacy: bool = False) -> DataFrame:
    """Lazily: df(row_id, ...) scored and projected. An expression scorer adds no stage to the plan."""
    return (project_legacy if legacy else project)(scorer.score(df), scorer.contract, out)


def dry_run(df: DataFrame, rows: int, size: Column | None = None, most: int = MAX_BATCH_BYTES) -> DataFrame:
    """One row: what a run would send. Chunks of equal rows follow from the count; with a size of each row (and row ids)
    batches are halved as a run would halve them, and rows that are too large alone are counted."""
    if size is None:
        n = F.col("n_rows")
        batches = (F.floor((n + rows - 1) / rows)).cast("long")
        return df.agg(F.count("*").alias("n_rows")).select(batches.alias("n_batches"), "n_rows", F.least(n, F.lit(rows).cast("long")).alias("largest_batch"))
    plan = split_plan(with_batch_id(df, rows), size, most)
    return plan.agg(F.count("*").alias("n_batches"), F.sum("n_rows").cast("long").alias("n_rows"), F.max("n_rows").cast("long").alias("largest_batch"), F.count(F.when(F.col("oversize"), 1)).alias("n_oversize"))


def run(spark: SparkSession, df: DataFrame, scorer: HttpScorer, out: Output, folder: str, manifest: dict, rows: int = 1000, resume: bool | None = None, keep_state: bool = False) -> RunReport:
    """Score df(row_id, ...) against a service, resumably; results are Parquet parts in folder/rows, one write a run.

    Rows of a run are written before its journal entries. A run that dies in between leaves rows without entries: they
    are removed by name when the run is resumed, so no row is there twice.
    """
    journal, run_id = RunJournal(spark, f"{folder}/journal"), run_key(*sorted(manifest.items()))
    journal.open(manifest, resume)
    planned = with_batch_id(df, rows)
    done = journal.read().where("status = 'ok'").select(F.explode(F.sequence("batch_id", F.col("batch_id") + F.col("n_rows") - 1)).alias("row_id"))
    todo = planned.join(done, "row_id", "left_anti")
    part = f"{folder}/attempts/{journal.read().count()}"
    sent, read = Observation("sent"), Observation("read")
    todo_seen = todo.observe(read, F.count(F.lit(1)).alias("rows_read"))
    ends_of = lambda status: F.count(F.when(F.col("status") == status, 1))
    scorer.attempts(todo_seen).observe(sent, F.count(F.lit(1)).alias("batches_sent"), ends_of("ok").alias("batches_ok"), ends_of("error").alias("batches_error")).write.mode("overwrite").parquet(part)
    attempts = spark.read.parquet(part)
    unpacked = scorer.unpack(attempts)
    good = unpacked.where("status = 'ok'").drop("batch_id", "status")
    table = (project_legacy if scorer.legacy else project)(todo.join(good, "row_id"), scorer.contract, out)
    table.write.mode("overwrite").parquet(f"{folder}/rows/part={part.rsplit('/', 1)[1]}")
    bad = unpacked.where("status <> 'ok'").select("batch_id", F.col("status").alias("why")).distinct()
    ends = attempts.join(bad, "batch_id", "left").select(F.lit(run_id).alias("run_id"), "batch_id", "n_rows", F.when(F.col("why").isNull(), F.col("status")).otherwise("error").alias("status"), F.coalesce("why", "message").alias("message"))
    journal.append(ends)
    pieces = journal.read().groupBy("batch_id").agg(F.max("n_rows").alias("n_rows"))
    report = RunReport(*account(pieces, journal.read()).first())
    total = df.count()
    report.rows_planned = total
    report.counters = {**read.get, **sent.get, "rows_skipped": total - read.get["rows_read"]}
    log.info("read and sent: %s; done %d rows, lost %d", report.counters, report.rows_done, report.rows_lost)
    if report.exit_code is None and report.rows_done == total and not keep_state:
        journal.clear()
    return report


__all__ = ["RunReport", "dry_run", "pending", "run", "score_table"]
