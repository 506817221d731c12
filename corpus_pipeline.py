"""The corpus pipeline: documents in, a mixed corpus out, one operator a stage, each stage's result written and read again.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Null ids, texts, languages and sources are handled as each operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillscore.llm.common import scratch_path, table
from rillscore.llm.decontaminate import decontaminate
from rillscore.llm.langid import fit_language_id, identify_language
from rillscore.llm.mixing import mix_sources
from rillscore.llm.neardup import near_duplicates
from rillscore.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this score a prediction is no better than a guess between two families and two languages.
LEAST_LANGUAGE_SCORE = 0.3
TOXIC = 0.3
#: SQL cannot express trained classifiers, fingerprints or this join; the stages are tested against brute force instead.
ORACLE_SQL = None


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts whose language cannot be told."""
    out = identify_language(docs, fit_language_id(docs, F.lit(True)), carry=COLUMNS)
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score as toxic, labelled or not."""
    model = fit_toxicity(docs, _read(spark, sf_dir, "labels"), F.lit(True))
    return score_toxicity(docs, model, threshold=TOXIC, carry=COLUMNS).where("predicted = 0").select(*COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the document with the smallest id stays, once.

    Where an id is repeated, rows take part and not ids: texts that are not alike all stay, of alike ones the row with the
    smallest id and then the smallest hash of its columns. Texts without words are in no group and stay, and so do rows
    without an id. The ids that go are written first, so that Spark knows their size when it decides how to join them.
    """
    docs, alike = docs.select(*COLUMNS), {"k": 5, "num": 80, "den": 100}
    if docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        rows = table(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
        groups = near_duplicates(rows.where("doc_id IS NOT NULL"), id_col="_row", **alike).select("_row", "component_id")
        first = F.min(F.struct("doc_id", "_hash", "_row")).alias("first")
        chosen = groups.join(rows.select("_row", "doc_id", F.xxhash64(*COLUMNS).alias("_hash")), "_row").groupBy("component_id").agg(first)
        return rows.join(table(chosen.select("first._row"), "chosen"), "_row", "left_semi").unionByName(rows.where("doc_id IS NULL")).select(*COLUMNS)
    groups = near_duplicates(docs, **alike)
    gone = table(groups.where("component_id <> doc_id").select("doc_id"), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    return decontaminate(docs.select(*COLUMNS), _read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken to bring the sources to their target weights."""
    return mix_sources(docs)


STAGES = [("language", language), ("toxicity", toxicity), ("near_duplicate", near_duplicate), ("benchmark", benchmark), ("mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written to the shared folder and read back."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
