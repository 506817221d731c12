"""Every catalogue query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from rillscore.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def agrees(spark, name, sf, tables, tmp_path):
    """The query and its SQL give the same rows of tables that are folders in sf."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet/*.parquet'")
    catalog.queries()[name](spark, sf).write.parquet(f"{tmp_path}/got")
    got, sql = f"'{tmp_path}/got/*.parquet'", catalog.oracle_sql()[name]
    cols = ", ".join(f'"{x[0]}"' for x in con.execute(f"DESCRIBE {sql}").fetchall())
    for a, b in ((f"({sql})", got), (got, f"({sql})")):
        assert con.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b} LIMIT 5").fetchall() == []


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, tmp_path, name):
    catalog.queries()[name](spark, SF).write.parquet(f"{tmp_path}/got")
    sql = catalog.oracle_sql()[name]
    names = sorted(x[0] for x in duck.execute(f"DESCRIBE {sql}").fetchall())
    got = f"'{tmp_path}/got/*.parquet'"
    assert names == sorted(x[0] for x in duck.execute(f"DESCRIBE SELECT * FROM {got}").fetchall())
    cols = ", ".join(f'"{n}"' for n in names)
    for a, b in ((f"({sql})", got), (got, f"({sql})")):
        assert duck.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b}").fetchall() == []


@pytest.mark.parametrize("name", ["explanations_mixed", "explanations_topk", "score_regression_customer"])
def test_explanations_of_balances_that_are_ties(spark, tmp_path, name):
    """Products such as 2003.5 * 0.001 are told from ties as the SQL does, and -0.0 keeps its sign."""
    balances = [2003.5, 2007.5, -0.3, -0.5, 1234.5, 0.0] + [i / 2 for i in range(-1999, 19_999)]
    sf = str(tmp_path / "sf")
    spark.createDataFrame([(i - 3, i % 25, b, "M", "n") for i, b in enumerate(balances)], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string, c_name string").write.parquet(f"{sf}/customer.parquet")
    agrees(spark, name, sf, ["customer"], tmp_path)


def test_class_values_that_are_ties(spark, tmp_path):
    sf = str(tmp_path / "sf")
    values = [0.0157235, 0.0313485, 0.0418965, 0.0469735, 100.0, 100.0000001] + [i / 1e7 for i in range(5, 20_000, 10)]
    spark.createDataFrame([(i, "view", v) for i, v in enumerate(values)], "event_id long, event_type string, value double").write.parquet(f"{sf}/events.parquet")
    agrees(spark, "unpack_v10", sf, ["events"], tmp_path)


def test_payload_texts_go_to_tasks_by_their_bytes(spark, tmp_path):
    """150 MB of text: no step sends them all to one task."""
    spark.range(150).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1_000_000).alias("text")).write.parquet(f"{tmp_path}/sf/documents.parquet")
    todo, found = [catalog.queries()["encode_payload_csv"](spark, f"{tmp_path}/sf")._jdf.queryExecution().optimizedPlan()], []
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName().startswith("Repartition") and any(x in node.output().toString() for x in ("text#", "r#")):
            found.append(node.numPartitions())
    assert found and min(found) >= 3
    agrees(spark, "encode_payload_csv", f"{tmp_path}/sf", ["documents"], tmp_path)


def test_scoring_stays_in_the_jvm(spark):
    plan = catalog.queries()["score_binary_orders"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "ReadSchema" in plan and "o_orderdate" not in plan.split("ReadSchema")[1].split("\n")[0]
