"""Run journal, resume and accounting: row ranges in Parquet, anti-joins, and one report at the end."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_id string, batch_id long, n_rows long, status string, message string"


def pending(df: DataFrame, journal: DataFrame) -> DataFrame:
    """Rows whose batch the journal does not have as done. Pieces of a split batch count by their first rows."""
    done = journal.where("status = 'ok'").select("batch_id").distinct()
    return df.join(done, "batch_id", "left_anti")


def account(plan: DataFrame, journal: DataFrame) -> DataFrame:
    """One row: rows and batches planned, done and lost, batches missing, errors that a later attempt fixed.

    plan(batch_id, n_rows), journal(batch_id, n_rows, status). A batch is done if any attempt ended ok.
    """
    ends = journal.groupBy("batch_id").agg(F.max(F.when(F.col("status") == "ok", F.col("n_rows"))).alias("done"), F.max(F.when(F.col("status") == "error", F.col("n_rows"))).alias("failed"))
    both = plan.join(ends, "batch_id", "left")
    n = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0)).cast("long")
    done, failed = F.col("done").isNotNull(), F.col("failed").isNotNull()
    return both.agg(
        F.sum("n_rows").cast("long").alias("rows_planned"), n(done, F.col("done")).alias("rows_done"), n(failed & ~done, F.col("failed")).alias("rows_lost"),
        n(~done & ~failed, F.lit(1)).alias("batches_missing"), n(failed & done, F.lit(1)).alias("errors_fixed"),
    )


def errors_by_batch(journal: DataFrame) -> DataFrame:
    """Messages of each batch in order, joined with `; `."""
    bad = journal.where("status <> 'ok'")
    return bad.groupBy("batch_id").agg(F.count("*").alias("n_messages"), F.array_join(F.array_sort(F.collect_list("message")), "; ").alias("messages"))


def last_attempt(attempts: DataFrame) -> DataFrame:
    """Of each batch the attempt that counts: the first that ended ok, else the last one."""
    rank = F.struct((F.col("status") == "ok").alias("ok"), F.when(F.col("status") == "ok", -F.col("attempt")).otherwise(F.col("attempt")).alias("a"))
    best = attempts.groupBy("batch_id").agg(F.max_by(F.struct(*attempts.columns), rank).alias("r"))
    return best.select("r.*")


class RunJournal:
    """A folder with a manifest and a Parquet journal. Appending is a Spark write, so an entry is there whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self) -> bool:
        fs, p = self._fs()
        return fs.exists(p)

    def start(self, manifest: dict) -> None:
        self.clear()
        self.spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "manifest string").coalesce(1).write.parquet(f"{self.folder}/manifest")

    def resume(self, manifest: dict) -> None:
        """The run must be the same one: every field of the manifest equal."""
        if not self.exists():
            raise ValueError(f"nothing to resume: {self.folder} does not exist")
        was = json.loads(self.spark.read.parquet(f"{self.folder}/manifest").first()[0])
        if wrong := sorted(k for k in {*was, *manifest} if was.get(k) != manifest.get(k)):
            raise ValueError(f"cannot resume, the run differs in: {', '.join(wrong)}")

    def open(self, manifest: dict, resume: bool | None) -> bool:
        """Resume if asked to, or if unasked and there is a journal of the same run; else start anew. True if resumed."""
        if resume is False or (resume is None and not self.exists()):
            self.start(manifest)
            return False
        self.resume(manifest)
        return True

    def append(self, entries: DataFrame) -> None:
        entries.select("run_id", "batch_id", "n_rows", "status", "message").write.mode("append").parquet(f"{self.folder}/entries")

    def read(self) -> DataFrame:
        fs, _ = self._fs()
        at = f"{self.folder}/entries"
        if not fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(at)):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(at)

    def clear(self) -> None:
        fs, p = self._fs()
        fs.delete(p, True)
