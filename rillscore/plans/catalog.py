"""The query catalogue: one entry per operator over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillscore.functions.scalar import csv_line, round_half_away, sigmoid, sort_labels
from rillscore.operators import batching, journal, response
from rillscore.operators.project import Contract, Output, project, project_legacy, value_columns
from rillscore.operators.rowid import tasks_of, with_row_id, with_row_id_of_wide
from rillscore.operators.scorers import ExpressionScorer, class_values
from rillscore.operators.scratch import scratch_path
from rillscore.operators.sink import lines, part_files, write_csv
from rillscore.plans.run import dry_run, score_table
from rillscore.sources.delimited import DelimitedSource, drop_empty_lines, peek
from rillscore.sources.dialect import FIELD_LIMIT, candidates

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__], _sql[f.__name__] = f, sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_id(_read(spark, sf_dir, "orders"), "o_orderkey")


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_id(_read(spark, sf_dir, "customer"), "c_custkey")


ORDERS = "o AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders)"
CUSTOMER = "c AS (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS row_id FROM customer)"
POSITIVE = "1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.00001::DOUBLE * o_totalprice - 1.5::DOUBLE)))"


def _binary() -> ExpressionScorer:
    p = round_half_away(sigmoid(F.lit(0.00001) * F.col("o_totalprice") - F.lit(1.5)), 6)
    return ExpressionScorer(Contract(("0.0", "1.0"), numeric_labels=True, has_threshold=True), {"1.0": p, "0.0": round_half_away(F.lit(1.0) - p, 6)}, F.when(p >= 0.5, "1.0").otherwise("0.0"), 0.5)


def _regression() -> ExpressionScorer:
    value = round_half_away(F.lit(0.01) * F.col("c_acctbal") + F.lit(2.5), 6)
    return ExpressionScorer(Contract(("z",), target_type="Regression"), {"z": value}, value)


# Row ids, plans, samples


@query(f"WITH {ORDERS} SELECT o_orderkey, row_id FROM o")
def rowid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("o_orderkey", "row_id")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate,
          row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) - 1 AS row_id FROM lineitem""")
def rowid_lineitem_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"]
    return with_row_id(_read(spark, sf_dir, "lineitem").select(*keys), *keys, rows_a_task=20_000)


@query(f"WITH {ORDERS} SELECT row_id - row_id % 1000 AS batch_id, count(*) AS n_rows FROM o GROUP BY 1")
def batch_plan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.batch_plan(batching.with_batch_id(_orders(spark, sf_dir), 1000))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 1")
def peek_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peek(_read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")


@query("""
WITH l AS (SELECT o_orderkey, strlen(concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)) + 1 AS bytes FROM orders),
r AS (SELECT sum(bytes) OVER (ORDER BY o_orderkey) + 49 AS upto, bytes FROM l),
g AS (SELECT count(*) FILTER (upto - bytes < 500000) AS n_lines_after_header, least(49 + sum(bytes), 500000) AS size FROM r)
SELECT CASE WHEN size < 375000 THEN 500 WHEN n_lines_after_header + 1 < 2 THEN 10 ELSE floor(2500000 / floor(size / n_lines_after_header)) + 1 END::BIGINT AS n_samples FROM g""")
def auto_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    df = _read(spark, sf_dir, "orders").select("o_orderkey", csv_line([F.col(c) for c in cols]).alias("line"))
    return batching.sampled_rows(df, "line", "o_orderkey", len(",".join(cols)) + 1)


@query("""
WITH RECURSIVE d AS (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, strlen(text) AS size FROM documents),
c AS (SELECT row_id, size, sum(size) OVER (ORDER BY row_id) AS upto FROM d),
p(a, z, bytes) AS (
  SELECT row_id - row_id % 100, max(row_id) + 1, sum(size)::BIGINT FROM c GROUP BY row_id - row_id % 100
  UNION ALL
  SELECT h.a, h.z, (SELECT sum(size)::BIGINT FROM c WHERE row_id >= h.a AND row_id < h.z) FROM (
    SELECT a, a + (z - a) // 2 AS z FROM p WHERE bytes >= 200000 AND z - a > 1
    UNION ALL SELECT a + (z - a) // 2, z FROM p WHERE bytes >= 200000 AND z - a > 1) h)
SELECT a AS batch_id, z - a AS n_rows, bytes AS n_bytes, bytes >= 200000 AS oversize FROM p WHERE bytes < 200000 OR z - a = 1""")
def split_plan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row_id(_read(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("size")), "doc_id")
    return batching.split_plan(batching.with_batch_id(docs, 100), F.col("size"), 200_000)


@query("SELECT doc_id, strlen(text) AS n_bytes FROM documents WHERE strlen(text) >= 20000")
def oversize_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.oversize_rows(_read(spark, sf_dir, "documents"), F.octet_length("text"), 20_000).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))


# Sources


@query("""SELECT doc_id, count(*) AS n_lines FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
          WHERE line <> '' GROUP BY doc_id""")
def drop_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_empty_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"), "text").groupBy("doc_id").agg(F.count("*").alias("n_lines"))


def _file(df: DataFrame, name: str, delimiter: str = ",") -> str:
    """df as one delimited file with a header, written by the sink."""
    folder = scratch_path(df.sparkSession, name)
    write_csv(df, folder, delimiter, single=True)
    return part_files(df.sparkSession, folder)[0]


@query("""SELECT n_nationkey::VARCHAR AS "key", n_name AS nation, r_name AS region, '' AS last, 4::BIGINT AS n_cells
          FROM nation JOIN region ON n_regionkey = r_regionkey
          UNION ALL SELECT 'key', 'nation', 'region', 'last', 4""")
def fast_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file holds a line that equals its header, and an empty last cell on each other one."""
    both = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    data = both.select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"), F.lit("").alias("last"))
    data = data.unionByName(spark.createDataFrame([("key", "nation", "region", "last")], data.schema))
    source = DelimitedSource(spark, _file(data, "nations", "|"), "|", skip_dialect=True, fast=True)
    return source.check_cells(source.scan()).select("key", "nation", "region", "last", F.col("_cells").cast("long").alias("n_cells"))


@query(f"SELECT count(*) FILTER (length(text) > {FIELD_LIMIT}) AS n_wide, max(length(text))::BIGINT AS widest FROM documents")
def wide_field_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    return _read(spark, sf_dir, "documents").agg(F.count(F.when(n > FIELD_LIMIT, 1)).alias("n_wide"), F.max(n).cast("long").alias("widest"))


@query("""
WITH l AS (SELECT n_nationkey AS line, concat_ws(',', n_nationkey, n_name, n_regionkey) AS t FROM nation ORDER BY n_nationkey LIMIT 20),
ch AS (SELECT line, unnest(string_split(regexp_replace(t, '\\w', '', 'g'), '')) AS ch FROM l),
n AS (SELECT line, ch, count(*) AS k FROM ch WHERE ch <> '' GROUP BY ALL)
SELECT ch FROM n GROUP BY ch HAVING count(*) = (SELECT count(*) FROM l) AND min(k) = max(k)""")
def delimiter_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the detector finds in the first lines, at most 20."""
    nation = _read(spark, sf_dir, "nation")
    rows = nation.select("n_nationkey", csv_line([F.col(c) for c in nation.columns]).alias("t")).orderBy("n_nationkey").limit(20).collect()
    return spark.createDataFrame([(c,) for c in candidates("".join(f"{r.t}\n" for r in rows))], "ch string")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey, c_mktsegment FROM customer")
def scan_roundtrip_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by the sink, read by a parsed scan with its own detection of encoding and dialect."""
    data = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return DelimitedSource(spark, _file(data, "customers"), multi_line=False).scan()


# Sinks


QUOTED = """CASE WHEN regexp_matches({0}, '[{1}"\\r\\n]') THEN '"' || replace({0}, '"', '""') || '"' ELSE {0} END"""


def _quoted(c: str, delimiter: str) -> str:
    return QUOTED.format(c, delimiter)


@query(f"WITH {CUSTOMER} SELECT row_id, c_custkey || ',' || {_quoted('c_name', ',')} || ',' || {_quoted('c_mktsegment', ',')} AS line FROM c")
def render_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _customer(spark, sf_dir)
    return df.select("row_id", lines(df.select("c_custkey", "c_name", "c_mktsegment")).alias("line"))


@query(f"WITH {CUSTOMER} SELECT row_id, c_custkey || '|' || {_quoted('c_name', '|')} || '|' || {_quoted('c_mktsegment', '|')} AS line FROM c")
def render_csv_pipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _customer(spark, sf_dir)
    return df.select("row_id", lines(df.select("c_custkey", "c_name", "c_mktsegment"), "|").alias("line"))


@query(f"""WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, text FROM documents)
SELECT row_id - row_id % 100 AS batch_id, sha256('doc_id,text' || chr(10) || string_agg(doc_id || ',' || {_quoted('text', ',')} || chr(10), '' ORDER BY row_id)) AS payload_sha256
FROM d GROUP BY 1""")
def encode_payload_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts are dealt by bytes, first by key and then by batch."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    parts = tasks_of(docs, F.octet_length("text"))
    numbered = with_row_id_of_wide(docs, "doc_id", parts=parts)
    rows = batching.with_batch_id(numbered, 100).select("batch_id", F.struct("row_id", F.concat(csv_line([F.col("doc_id"), F.col("text")]), F.lit("\n")).alias("line")).alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "")
    return rows.repartition(parts, "batch_id").groupBy("batch_id").agg(F.sha2(F.concat(F.lit("doc_id,text\n"), body).cast("binary"), 256).alias("payload_sha256"))


# Scores


@query(f'WITH {ORDERS} SELECT row_id, o_orderstatus, round(1.0 - p, 6) AS "0.0", p AS "1.0" FROM (SELECT *, round({POSITIVE}, 6) AS p FROM o)')
def score_binary_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(_orders(spark, sf_dir), _binary(), Output(keep_cols=("o_orderstatus",)))


@query(f"WITH {ORDERS} SELECT row_id, round({POSITIVE}, 6) AS healthy FROM o")
def score_binary_pred_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(_orders(spark, sf_dir), _binary(), Output(pred_name="healthy"))


@query(f'WITH {ORDERS} SELECT o_orderkey, round(1.0 - p, 6) AS "0.0", p AS "1.0" FROM (SELECT *, round({POSITIVE}, 6) AS p FROM o)')
def score_skip_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(_orders(spark, sf_dir), _binary(), Output(keep_cols=("o_orderkey",), skip_row_id=True))


@query(f"WITH {CUSTOMER} SELECT row_id, c_mktsegment, c_name, round(0.01::DOUBLE * c_acctbal + 2.5::DOUBLE, 6) AS z FROM c")
def keep_cols_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(_customer(spark, sf_dir), _regression(), Output(keep_cols=("c_mktsegment", "c_name")))


@query(f"WITH {CUSTOMER} SELECT row_id, round(0.01::DOUBLE * c_acctbal + 2.5::DOUBLE, 6) AS z FROM c")
def score_regression_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(_customer(spark, sf_dir), _regression(), Output())


@query(f"WITH {CUSTOMER} SELECT row_id, round(0.01::DOUBLE * c_acctbal + 2.5::DOUBLE, 6) AS new_name FROM c")
def score_regression_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(_customer(spark, sf_dir), _regression(), Output(pred_name="new_name"))


@query("""
WITH e AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row_id, exp(3.0::DOUBLE * embedding[1]::DOUBLE) AS a, exp(3.0::DOUBLE * embedding[2]::DOUBLE) AS b, exp(3.0::DOUBLE * embedding[3]::DOUBLE) AS c FROM embeddings)
SELECT row_id, round(a / (a + b + c), 6) AS "1", round(c / (a + b + c), 6) AS "10", round(b / (a + b + c), 6) AS "2" FROM e""")
def score_multiclass_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_row_id(_read(spark, sf_dir, "embeddings"), "vec_id")
    a, b, c = (F.exp(F.lit(3.0) * F.get("embedding", F.lit(i)).cast("double")) for i in range(3))
    total = a + b + c
    scorer = ExpressionScorer(Contract(("1", "2", "10")), {"1": round_half_away(a / total, 6), "2": round_half_away(b / total, 6), "10": round_half_away(c / total, 6)})
    return score_table(df, scorer, Output())


@query(f"""WITH {ORDERS} SELECT row_id, p AS healthy, 0.5::DOUBLE AS threshold, CASE WHEN p >= 0.5 THEN '1.0' ELSE '0.0' END AS label
FROM (SELECT *, round({POSITIVE}, 6) AS p FROM o)""")
def threshold_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(_orders(spark, sf_dir), _binary(), Output(pred_name="healthy", pred_threshold="threshold", pred_decision="label"))


def _contributions(least: float):
    """Contributions of three features, the strongest first; those below `least` are left out."""
    parts = [F.struct(round_half_away(F.col("c_acctbal") * 0.001, 3).alias("strength"), F.lit("c_acctbal").alias("feature")), F.struct(round_half_away(F.col("c_nationkey") * F.lit(0.1), 3).alias("strength"), F.lit("c_nationkey").alias("feature")), F.struct(round_half_away((F.col("c_custkey") % 7) * F.lit(0.5), 3).alias("strength"), F.lit("c_custkey").alias("feature"))]
    some = F.filter(F.sort_array(F.array(*parts), asc=False), lambda e: e["strength"] >= least)
    return F.transform(some, lambda e: F.struct(e["feature"].alias("feature"), F.format_string("%.3f", e["strength"]).alias("strength")))


def _explained(spark: SparkSession, sf_dir: str, least: float, most: int) -> DataFrame:
    value = round_half_away(F.lit(0.01) * F.col("c_acctbal") + F.lit(2.5), 6)
    scorer = ExpressionScorer(Contract(("z",), has_explanations=True, target_type="Regression"), {"z": value}, value, explanations=_contributions(least))
    return score_table(_customer(spark, sf_dir), scorer, Output(max_explanations=most))


EXPLAIN = """
WITH {customer},
parts AS (
  SELECT row_id, unnest([{{'s': round(c_acctbal * 0.001::DOUBLE, 3), 'f': 'c_acctbal'}}, {{'s': round(c_nationkey * 0.1::DOUBLE, 3), 'f': 'c_nationkey'}}, {{'s': round((c_custkey % 7) * 0.5::DOUBLE, 3), 'f': 'c_custkey'}}]) AS e FROM c),
ranked AS (SELECT row_id, e.f AS f, printf('%.3f', e.s) AS s, row_number() OVER (PARTITION BY row_id ORDER BY e.s DESC, e.f DESC) AS k FROM parts WHERE e.s >= {least})
SELECT c.row_id, max(round(0.01::DOUBLE * c_acctbal + 2.5::DOUBLE, 6)) AS z, {columns} FROM c LEFT JOIN ranked r USING (row_id) GROUP BY c.row_id"""


def _explain_sql(least: float, most: int) -> str:
    cols = ", ".join(f"coalesce(max(CASE WHEN k = {i} THEN r.{c} END), '') AS explanation_{i}_{n}" for i in range(1, most + 1) for c, n in (("f", "feature"), ("s", "strength")))
    return EXPLAIN.format(customer=CUSTOMER, least=least, columns=cols)


@query(_explain_sql(-1e9, 2))
def explanations_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _explained(spark, sf_dir, -1e9, 2)


@query(_explain_sql(1.0, 4))
def explanations_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _explained(spark, sf_dir, 1.0, 4)


@query(f"""WITH {CUSTOMER} SELECT row_id, 'c_nationkey' AS explanation_1_feature, printf('%.1f', c_nationkey * 0.5::DOUBLE) AS explanation_1_strength,
'' AS explanation_2_feature, '' AS explanation_2_strength FROM c""")
def explanations_reason_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.struct(F.lit("c_nationkey").alias("feature"), (F.col("c_nationkey") * F.lit(0.5)).alias("strength"))
    item = F.struct(F.lit(0).cast("long").alias("rowId"), F.lit("0").alias("prediction"), F.array(code).alias("reasonCodes"))
    sent = _customer(spark, sf_dir).select(F.col("row_id").alias("batch_id"), F.lit(1).alias("n_rows"), F.to_json(F.struct(F.array(item).alias("data"))).alias("response"))
    return project(response.unpack_v10(sent), Contract((), has_explanations=True), Output(max_explanations=2))


# Responses


def _responses(df: DataFrame, item, name: str, **more) -> DataFrame:
    """Batches of 100 rows as the service would answer them, the items of a response out of order."""
    rows = batching.with_batch_id(df, 100).withColumn("item", item).groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.collect_list(F.struct(F.xxhash64("row_id").alias("h"), "item")).alias("items"))
    by_hash = F.array_sort("items", lambda a, b: F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1).otherwise(0))
    items = F.transform(by_hash, lambda x: x["item"])
    return rows.select("batch_id", "n_rows", F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in more.items()], items.alias(name))).alias("response"))


def _item_v10(value):
    pair = class_values({"yes": value, "no": F.lit(100.0) - value})
    return F.struct((F.col("row_id") - F.col("batch_id")).alias("rowId"), F.col("event_type").alias("prediction"), F.lit(0.5).alias("predictionThreshold"), pair.alias("predictionValues"))


EVENTS = "e AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS row_id FROM events)"


@query(f"WITH {EVENTS} SELECT row_id, event_type AS prediction, 0.5::DOUBLE AS threshold, round(100.0::DOUBLE - value, 6) AS no, value AS yes FROM e")
def unpack_v10(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_row_id(_read(spark, sf_dir, "events"), "event_id")
    got = response.unpack_v10(_responses(batching.with_batch_id(df, 100), _item_v10(F.col("value")), "data"))
    _, yes = value_columns(F.col("values"), Contract(("no", "yes")))
    return got.where("status = 'ok'").select("row_id", "prediction", "threshold", round_half_away(F.get(sort_labels(F.col("values")), F.lit(0))["value"], 6).alias("no"), yes)


@query(f"WITH {EVENTS} SELECT row_id, event_id, event_type FROM e")
def result_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_row_id(_read(spark, sf_dir, "events"), "event_id")
    got = response.unpack_v10(_responses(batching.with_batch_id(df, 100), _item_v10(F.col("value")), "data"))
    return got.select("row_id", "prediction").join(df.select("row_id", "event_id"), "row_id").select("row_id", "event_id", F.col("prediction").alias("event_type")).orderBy("row_id")


def _legacy(df: DataFrame, value, task: str) -> DataFrame:
    item = F.struct((F.col("row_id") - F.col("batch_id")).alias("row_id"), value.cast("string").alias("prediction"), F.create_map(F.lit("1.0"), value, F.lit("0.0"), round_half_away(F.lit(1.0) - value, 6)).alias("class_probabilities"))
    return response.unpack_legacy(_responses(batching.with_batch_id(df, 100), item, "predictions", task=task)).where("status = 'ok'").drop("batch_id", "status")


@query(f'WITH {ORDERS} SELECT row_id, round(1.0 - p, 6) AS "0.0", p AS "1.0" FROM (SELECT *, round({POSITIVE}, 6) AS p FROM o)')
def legacy_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = round_half_away(sigmoid(F.lit(0.00001) * F.col("o_totalprice") - F.lit(1.5)), 6)
    return project_legacy(_legacy(_orders(spark, sf_dir), p, "Binary"), Contract(("0.0", "1.0")), Output())


@query(f"WITH {CUSTOMER} SELECT row_id, round(0.01::DOUBLE * c_acctbal + 2.5::DOUBLE, 6) AS z FROM c")
def legacy_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = round_half_away(F.lit(0.01) * F.col("c_acctbal") + F.lit(2.5), 6)
    return project_legacy(_legacy(_customer(spark, sf_dir), value, "Regression"), Contract(("z",), target_type="Regression"), Output(pred_name="z"))


@query(f"WITH {ORDERS} SELECT row_id, o_orderpriority, o_orderkey, round({POSITIVE}, 6) AS healthy FROM o")
def legacy_keep_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _orders(spark, sf_dir)
    p = round_half_away(sigmoid(F.lit(0.00001) * F.col("o_totalprice") - F.lit(1.5)), 6)
    return project_legacy(df.join(_legacy(df, p, "Binary"), "row_id"), Contract(("0.0", "1.0")), Output(keep_cols=("o_orderpriority", "o_orderkey"), pred_name="healthy"))


@query("""SELECT vec_id, '10' AS lexical_first, '9' AS lexical_last, '2' AS numeric_first, '10' AS numeric_last, embedding[3]::DOUBLE AS numeric_last_value FROM embeddings""")
def label_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "embeddings")
    values = class_values({"9": F.get("embedding", F.lit(0)), "2": F.get("embedding", F.lit(1)), "10": F.get("embedding", F.lit(2))})
    by, num = sort_labels(values), sort_labels(values, numeric=True)
    return df.select("vec_id", F.get(by, F.lit(0))["label"].alias("lexical_first"), F.element_at(by, -1)["label"].alias("lexical_last"), F.get(num, F.lit(0))["label"].alias("numeric_first"), F.element_at(num, -1)["label"].alias("numeric_last"), F.element_at(num, -1)["value"].alias("numeric_last_value"))


# Alignment, resume, attempts, accounting


@query(f"WITH {ORDERS} SELECT a.row_id, a.o_orderkey, b.o_totalprice FROM o a JOIN o b USING (row_id)")
def align_by_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _orders(spark, sf_dir)
    return df.select("row_id", "o_orderkey").join(df.select("row_id", "o_totalprice"), "row_id")


@query(f"WITH {ORDERS} SELECT row_id, o_orderkey FROM o WHERE (row_id // 1000) % 2 = 1")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = batching.with_batch_id(_orders(spark, sf_dir), 1000)
    entries = batching.batch_plan(df).withColumn("status", F.when((F.col("batch_id") / 1000) % 2 == 0, "ok").otherwise("error"))
    return journal.pending(df, entries).select("row_id", "o_orderkey")


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of 500 fails its first attempt if its number is divisible by 7, and the second too if by 35."""
    plan = batching.batch_plan(batching.with_batch_id(_orders(spark, sf_dir), 500))
    k = (F.col("batch_id") / 500).cast("long")
    tries = plan.withColumn("attempt", F.explode(F.when(k % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    status = F.when((k % 35 == 0) | ((k % 7 == 0) & (F.col("attempt") == 1)), "error").otherwise("ok")
    return tries.withColumn("status", status).withColumn("message", F.when(F.col("status") == "error", F.concat(F.lit("attempt "), "attempt", F.lit(" failed"))))


ATTEMPTS = f"""{ORDERS}, b AS (SELECT row_id - row_id % 500 AS batch_id, count(*) AS n_rows, (row_id - row_id % 500) // 500 AS k FROM o GROUP BY ALL),
t AS (SELECT batch_id, n_rows, k, unnest(CASE WHEN k % 7 = 0 THEN [1, 2] ELSE [1] END) AS attempt FROM b),
s AS (SELECT *, CASE WHEN k % 35 = 0 OR (k % 7 = 0 AND attempt = 1) THEN 'error' ELSE 'ok' END AS status FROM t)""".replace("row_id - row_id % 500 AS batch_id, count(*) AS n_rows, (row_id - row_id % 500) // 500 AS k FROM o GROUP BY ALL", "(row_id // 500) * 500 AS batch_id, count(*) AS n_rows, row_id // 500 AS k FROM o GROUP BY row_id // 500")


@query(f"WITH {ATTEMPTS} SELECT batch_id, n_rows, attempt, status FROM s QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY attempt DESC) = 1")
def retry_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    tries = _attempts(spark, sf_dir)
    first, second = tries.where("attempt = 1"), tries.where("attempt = 2")
    return journal.last_attempt(first.unionByName(second)).select("batch_id", "n_rows", "attempt", "status")


@query(f"""WITH {ATTEMPTS}, e AS (SELECT batch_id, n_rows, bool_or(status = 'ok') AS ok, bool_or(status = 'error') AS bad FROM s GROUP BY ALL)
SELECT sum(n_rows)::BIGINT AS rows_planned, coalesce(sum(n_rows) FILTER (ok), 0)::BIGINT AS rows_done, coalesce(sum(n_rows) FILTER (bad AND NOT ok), 0)::BIGINT AS rows_lost,
0::BIGINT AS batches_missing, count(*) FILTER (bad AND ok) AS errors_fixed FROM e""")
def run_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tries = _attempts(spark, sf_dir)
    return journal.account(tries.where("attempt = 1").select("batch_id", "n_rows"), tries)


@query(f"""WITH {ATTEMPTS} SELECT batch_id, count(*) AS n_messages, string_agg('attempt ' || attempt || ' failed', '; ' ORDER BY attempt) AS messages
FROM s WHERE status <> 'ok' GROUP BY batch_id""")
def errors_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.errors_by_batch(_attempts(spark, sf_dir))


@query("""SELECT count(DISTINCT k // 4096) AS n_batches, count(*) AS n_rows, least(4096, count(*))::BIGINT AS largest_batch
FROM (SELECT row_number() OVER () - 1 AS k FROM lineitem)""")
def dry_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dry_run(_read(spark, sf_dir, "lineitem"), 4096)
