"""Scoring a stream: the same batch stages under foreachBatch, with Spark's checkpoint as the journal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rillscore.operators.project import Output
from rillscore.operators.scorers import Scorer
from rillscore.plans.run import score_table


def score_stream(stream: DataFrame, scorer: Scorer, out: Output, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write each micro-batch's predictions to path/batch=<id>, overwriting, so a batch that runs twice is there once.

    The stream has a row_id (it is never made up here: ids over an unbounded input are the source's to give).
    """

    def write(df: DataFrame, batch: int) -> None:
        score_table(df, scorer, out).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
