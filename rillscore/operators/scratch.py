"""Cutting a plan with a written copy in the folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder; nothing is created yet."""
    return f"{_base(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df from a reliable checkpoint: computed once, partitions kept, safe from lost executors."""
    _base(df.sparkSession)
    return df.checkpoint()


def _base(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only on one machine a temporary one stands in where it is unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        sc.setCheckpointDir(base or tempfile.mkdtemp(prefix="rillscore-"))
    return sc.getCheckpointDir().rstrip("/")
