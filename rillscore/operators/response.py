"""Service responses as columns: the current format (arrays of structs) and the legacy one (maps)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed response schemas. Labels and predictions stay lexical; their JSON type is part of a scorer's contract.
EXPLANATION = "ARRAY<STRUCT<feature: STRING, strength: DOUBLE>>"
V10 = f"STRUCT<data: ARRAY<STRUCT<rowId: BIGINT, prediction: STRING, predictionThreshold: DOUBLE, predictionValues: ARRAY<STRUCT<label: STRING, value: DOUBLE>>, predictionExplanations: {EXPLANATION}, reasonCodes: {EXPLANATION}>>>"
LEGACY = "STRUCT<task: STRING, predictions: ARRAY<STRUCT<row_id: BIGINT, prediction: STRING, class_probabilities: MAP<STRING, DOUBLE>>>>"


def _status(got: Column, expected: str) -> Column:
    return F.when(got.isNull(), "malformed").when(F.size(got) != F.col(expected), "short").otherwise("ok")


def unpack_v10(batches: DataFrame, text: str = "response") -> DataFrame:
    """(batch_id, n_rows, response) -> a row per prediction: batch_id, row_id, status and the response's fields.

    A malformed response or one with another number of rows than were sent gives one row with its status and no
    prediction, so no row is lost silently.
    """
    data = F.from_json(F.col(text), V10)["data"]
    df = batches.withColumn("_data", data).withColumn("status", _status(F.col("_data"), "n_rows"))
    rows = df.select("batch_id", "status", F.explode_outer(F.when(F.col("status") == "ok", F.col("_data"))).alias("p"))
    return rows.select(
        "batch_id", (F.col("batch_id") + F.col("p.rowId")).alias("row_id"), "status", F.col("p.prediction").alias("prediction"), F.col("p.predictionThreshold").alias("threshold"), F.col("p.predictionValues").alias("values"),
        F.coalesce("p.predictionExplanations", "p.reasonCodes").alias("explanations"),
    )


def unpack_legacy(batches: DataFrame, text: str = "response") -> DataFrame:
    """As unpack_v10 for the legacy format: class probabilities become values; tasks other than two raise on use."""
    got = F.from_json(F.col(text), LEGACY)
    df = batches.withColumn("_got", got).withColumn("status", _status(F.col("_got.predictions"), "n_rows"))
    df = df.withColumn("status", F.when(F.col("_got.task").isin("Regression", "Binary") | F.col("_got").isNull(), F.col("status")).otherwise("unsupported task"))
    rows = df.select("batch_id", "status", F.explode_outer(F.when(F.col("status") == "ok", F.col("_got.predictions"))).alias("p"))
    values = F.transform(F.map_entries("p.class_probabilities"), lambda e: F.struct(e["key"].alias("label"), e["value"].alias("value")))
    return rows.select("batch_id", (F.col("batch_id") + F.col("p.row_id")).alias("row_id"), "status", F.col("p.prediction").alias("prediction"), values.alias("values"))
