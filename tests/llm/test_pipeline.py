"""The pipeline's stages, each against what its operator decides by brute force on the stage's own input."""

import os

import pytest
from test_groups import brute

import corpus_pipeline
from rillscore.llm import decontaminate

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "mix":
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        rows = before.collect()
        assert set(kept[name]) <= {r.doc_id for r in rows}
        if name == "language":
            assert set(kept[name]) == {r.doc_id for r in rows if any(map(str.isalpha, r.text or ""))}
        elif name == "near_duplicate":
            assert set(kept[name]) == {i for i, _, c in brute([(r.doc_id, r.text) for r in rows], 5, 80) if i == c}
        elif name == "benchmark":
            items = [decontaminate.tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

            def leaks(text):
                ws = decontaminate.tokens(text)
                near = (decontaminate.similarity(decontaminate.bag(ws[p : p + len(t)], 5), decontaminate.bag(t, 5)) for t in items for p in range(len(ws) - len(t) + 1) if set(t[:9]) & set(ws[p : p + 9]))
                return any(s >= 0.8 for s in near)

            gone = {r.doc_id for r in rows} - set(kept[name])
            assert gone and all(leaks(r.text) for r in rows if r.doc_id in gone)
            assert not any(" ".join(t) in " ".join(decontaminate.tokens(r.text)) for r in kept[name].values() for t in items)
        elif name == "mix":
            assert len(kept[name]) == len(rows) and sum(r.taken for r in kept[name].values()) > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_run(spark, tmp_path):
    """run() is its stages one after the other."""
    want = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        want = stage(spark, want, SF)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, want.collect()))


def test_empty_tables_and_more_columns(spark, docs, tmp_path):
    """Without documents nothing comes out; without labels and items nothing is toxic or leaked; other columns do not matter."""
    docs = docs.selectExpr("*", "length(text) AS n_chars")
    for name, df in (("documents", docs), ("labels", spark.createDataFrame([], "doc_id long, toxic int")), ("benchmark", spark.createDataFrame([], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.toxicity(spark, docs, str(tmp_path)).count() == docs.count()
    assert corpus_pipeline.benchmark(spark, docs, str(tmp_path)).count() == docs.count()
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_repeated_rows_and_nulls(spark, docs):
    docs = docs.select("doc_id", "text", "lang", "source").selectExpr("*", "length(text) AS n_chars")
    left = sorted((r.doc_id is None, r.doc_id or 0) for r in corpus_pipeline.near_duplicate(spark, docs, SF).collect())
    # 2 is a near copy of 1, 3 equals it but for case, 9 repeats 8; rows without an id stay.
    assert left == [(False, i) for i in (1, 4, 5, 6, 7, 8, 10, 11, 12)] + [(True, 0)] * 2


def test_an_id_with_several_texts(spark):
    """Texts that are not alike stay under one id; copies of either go, and an id does not join their groups."""
    one = "the old harbour lay quiet under a grey sky while the boats came slowly home one after another"
    two = "nothing of that was known to those who had spent the whole summer counting birds in the marshes"
    rows = [(1, one, "en"), (1, two, "en"), (1, one, "en"), (2, one + " today", "en"), (3, two.upper(), "en"), (4, "", "en"), (4, None, "en"), (None, one, "en"), (5, "a text of its own with words of its own", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' AS source", "length(text) AS n_chars", "0 AS component_id")
    left = corpus_pipeline.near_duplicate(spark, df, SF)
    assert left.columns == corpus_pipeline.COLUMNS
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(1, one), (1, two), (4, ""), (4, None), (5, rows[-1][1]), (None, one)], key=str)
