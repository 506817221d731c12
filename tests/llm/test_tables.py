"""op2, op4, op5, op8, op10: against SQL, brute force and round trips."""

import io
import os
import struct
import urllib.parse

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from rillscore.llm import chat, mixing, queries, search, urls, warc

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def against_sql(got, sql, tables, tmp_path):
    con = duckdb.connect()
    for name, df in tables.items():
        if isinstance(df, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{df}'")
        else:
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    got.write.mode("overwrite").parquet(f"{tmp_path}/got")
    cols = ", ".join(sorted(got.columns))
    assert sorted(got.columns) == sorted(x[0] for x in con.execute(f"DESCRIBE {sql}").fetchall())
    for a, b in ((f"({sql})", f"'{tmp_path}/got/*.parquet'"), (f"'{tmp_path}/got/*.parquet'", f"({sql})")):
        assert con.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b}").fetchall() == []


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_against_sql(spark, tmp_path, name):
    against_sql(queries.queries()[name](spark, SF), queries.oracle_sql()[name], {t: f"{SF}/{t}.parquet" for t in TABLES}, tmp_path)


def test_mixing_awkward_rows(spark, docs, tmp_path):
    got = mixing.mix_sources(docs)
    against_sql(got, mixing.ORACLE, {"documents": docs.select("doc_id", "text", "source")}, tmp_path)
    rows = got.collect()
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows) and sum(r.taken for r in rows) <= sum(r["size"] for r in rows)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix_sources(docs.where("doc_id IN (4, 5, 6)")).collect()] == [0, 0, 0]


def test_more_passes(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"), F.when(F.col("id") < 280, "a").otherwise("b").alias("source"))
    got = mixing.mix_sources(df, weights=(1, 9), passes=6).join(df.select("doc_id", "source"), "doc_id").collect()
    b = [r for r in got if r.source == "b"]
    assert all(r.taken <= 6 * r["size"] for r in got) and abs(sum(r.taken for r in b) - b[0].target) <= 7 and b[0].target == 6 * b[0].source_size


def test_targets_stop_at_three_times_the_source(spark):
    sizes = [("a", 1000), ("b", 10), ("c", 10), ("d", 0), (None, 500)]
    got = {r.source: (r.w, r.target) for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    assert [got[s][0] for s in ("a", "b", "c", "d", None)] == [1, 2, 3, 1, 2]
    assert got["b"][1] == got["c"][1] == 30 and got["d"][1] == 0
    assert sum(t for _, t in got.values()) == pytest.approx(1520) and got[None][1] == pytest.approx(2 * got["a"][1])


def test_each_source_is_near_its_target(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 40 + 1).cast("int")).alias("text"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"))
    for r in mixing.mix_sources(df).join(df.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 40


# Chat


def test_chat_round_trip(spark):
    data = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] & &amp; &#91; &#60;s>"), (1, 1, "assistant", "tie"), (2, 1, "assistant", "first"), (2, 0, "system", None), (3, 0, None, "x"), (3, 1, "tool [/ROLE]", "<s>"),
        (None, None, "user", ""), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a " * 50_000), (4, 3, "user", "[INST"), (5, 0, "user", "]"), (5, 0, "user", "]"),
    ]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("ts", F.lit(1)).withColumn("segments", F.lit(2))
    many = spark.range(3000).selectExpr("9L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "cast(id AS string) AS text")
    long = chat.digests(chat.format_chats(many)).first()
    assert long.n_turns == 3000 and long.valid and long.loss_chars == sum(len(str(i)) for i in range(1, 3000, 2))
    chats = chat.format_chats(df)
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chats.select("conv_id", chat.read_chats(text).alias("turns")).collect()}
    want = {}
    for c, turn, role, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", t or ""))
    assert got == want
    assert {r.conv_id: r.valid for r in chats.collect()} == {1: False, 2: False, 3: False, None: True, 4: True, 5: False}
    for r in chats.collect():
        assert [s.text for s in r.segments if s.loss] == [s.text for s in r.segments[1::3] if s.loss]
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


@needs_tables
def test_the_machine_decides_in_the_query(spark):
    plan = queries.op5_chat_format(spark, SF).drop("valid")._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"{state}>{role}" in plan for state, role in chat.TURNS) and "Python" not in plan


# Search


def brute_search(rows, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and len(v) == 3 and None not in v and np.isfinite(np.array(v, np.float64)).all() and any(v)]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            found = sorted((-(x * q).sum(), j) for j, x in ok if j != i)[:k]
            out[i] = [(j, -s) for s, j in found]
    return out


def test_search_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).round(2).tolist()) for i in range(200)] + [(i, [1.0, 2.0, 3.0]) for i in range(200, 300)]
    rows += [(300, None), (320, [0.0, 0.0, 0.0]), (340, [1.0, None, 2.0]), (360, [1.0, float("nan"), 2.0]), (380, [1.0, float("inf"), 2.0]), (400, [1.0]), (None, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("leaf", F.lit("x")).withColumn("v", F.lit(1))
    found = search.search(df, F.col("vec_id") % 20 == 0, k=5, recall=1.0, block=16, leaf_rows=20)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_search(rows, 5)
    assert set(got) == set(want)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    full = [q for q in want if [j for j, _ in got[q]] == [j for j, _ in want[q]]]
    assert len(full) >= 0.9 * len(want) and all([s for _, s in got[q]] == pytest.approx([float(s) for _, s in want[q]]) for q in full)
    assert search.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = search.search(df.where("vec_id < 3"), F.col("vec_id") % 20 == 0, k=5)
    assert sorted(r.vec_id for r in few.collect()) == [1, 2]
    assert search.search(df.where("vec_id = 1"), F.col("vec_id") % 20 == 0).count() == 0


def test_a_query_is_never_short_of_rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 8))
    tree = search.KMeansTree.fit(x, 8, 20)
    rows = np.bincount(tree.assign(x), minlength=tree.leaves)
    for q in x[:50]:
        leaves = tree.visit(q, 1, rows, 150)
        assert rows[leaves].sum() >= 150 and len(set(leaves)) == len(leaves) < tree.leaves
    assert sorted(tree.visit(x[0], tree.leaves)) == list(range(tree.leaves))


def clustered(n, seed=5):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(n // 60, 8))[rng.integers(0, n // 60, n)] + rng.normal(0, 0.05, (n, 8))
    return at / np.linalg.norm(at, axis=1, keepdims=True)


def test_leaves_do_not_grow_with_the_input(spark):
    share = {}
    for n in (3000, 12_000):
        x = clustered(n)
        src = spark.createDataFrame([(i, i % 50 == 0, v) for i, v in enumerate(x.tolist())], "vec_id long, is_query boolean, v array<double>").repartition(4)
        tree, indexed, rows = search.index(src, sample=400, leaf_rows=25)
        leaf = np.zeros(n, int)
        for r in indexed.select("vec_id", "leaf").collect():
            leaf[r.vec_id] = r.leaf
        assert rows.sum() == n and (np.bincount(leaf, minlength=tree.leaves) == rows).all() and (tree.assign(x) == leaf).all()
        assert np.percentile(rows, 95) <= 50 and tree.leaves >= n / 100
        assert sorted(tree.visit(x[0], tree.leaves)) == list(range(tree.leaves))
        seen = []
        for q in range(0, n, 100):  # rows of the leaves up to the one that completes 95 % of the nearest
            near = np.argsort(-(x @ x[q]))[1:21]
            order = tree.visit(x[q], tree.leaves)
            place = {v: i for i, v in enumerate(order)}
            seen.append(rows[order[: sorted(place[leaf[j]] for j in near)[18] + 1]].sum())
        share[n] = np.mean(seen) / n
    assert share[12_000] < 0.5 * share[3000] and share[12_000] < 0.1


def test_search_with_a_grown_tree(spark):
    x = clustered(3000)
    x = np.concatenate([x, np.repeat(x[7:8], 400, axis=0)])  # a leaf of equal vectors is left whole
    df = spark.createDataFrame([*enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in search.search(df, F.col("vec_id") % 50 == 0, k=5, sample=300, leaf_rows=20, block=64).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sorted(got) == list(range(0, len(x), 50))
    hits = 0
    for q, found in got.items():
        score = (x * x[q]).sum(1)
        score[q] = -np.inf
        hits += len(found & set(np.lexsort((np.arange(len(x)), -score))[:5].tolist()))
    assert hits >= 0.9 * 5 * len(got)


def test_search_sends_no_query_to_leaves(spark):
    x = np.random.default_rng(8).normal(size=(4000, 16)).astype(np.float32).astype(float)  # without structure: a query needs many leaves
    df = spark.createDataFrame([*enumerate(x.tolist())], "vec_id long, embedding array<float>")
    found = search.search(df, F.col("vec_id") % 4 == 0, k=10, sample=500, leaf_rows=20, most_queries=300)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Generate" not in plan and plan.count("Exchange") == 1  # queries are dealt out once, pairs never
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert sorted(got) == list(range(0, 4000, 4)) and all(sorted(g) == list(range(1, 11)) for g in got.values())
    hits = 0
    for q, g in got.items():
        score = (x * x[q]).sum(1)
        assert [s for _, s in (g[r] for r in range(1, 11))] == [score[i] for i, _ in (g[r] for r in range(1, 11))]
        score[q] = -np.inf
        hits += len({i for i, _ in g.values()} & set(np.argsort(-score)[:10].tolist()))
    assert hits >= 0.9 * 10 * len(got)


def test_search_counts_rows_and_not_their_copies(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(300, 4)).tolist())] + [(1001, [30.0, 0.0, 0.0, 0.0])] * 3 + [(2000, [2.0, 0.1, 0.0, 0.0])] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, r.score) for r in search.search(df, F.col("vec_id") == 2000, k=4, recall=1.0, leaf_rows=10, copies=3).orderBy("rank").collect()]
    assert [g[:2] for g in got[:3]] == [(1, 1001), (2, 1001), (3, 1001)] and {g[2] for g in got[:3]} == {60.0}
    few = search.search(df.where("vec_id < 30"), F.col("vec_id") == 20, k=50, recall=0.1, leaf_rows=2).collect()
    assert sorted(r.vec_id for r in few) == [i for i in range(30) if i != 20]  # short of rows, it goes through the other leaves too


@needs_tables
def test_search_recall(spark):
    rows = {r.vec_id: np.array(r.embedding, np.float64) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids, x = np.array(list(rows)), np.stack(list(rows.values()))
    got = {}
    for r in queries.op4_nearest(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in ids[ids % 20 == 0].tolist():
        s = np.where(ids == q, -np.inf, x @ rows[q])
        best = set(ids[np.argsort(-s)[:20]].tolist())
        hit, total = hit + len(best & got[q]), total + 20
    assert hit / total >= 0.9


# WARC


def pages(spark):
    data = [(3, "http://a/", "same"), (1, "http://b/ c", "same"), (1, "http://b/ c", "same"), (2, None, None), (4, "http://é/", ""), (5, "u", "x" * 300_000), (6, "v", "é"), (None, "n", "same"), (None, "m", "only null"), (None, "m", "only null")]
    return spark.createDataFrame(data, "page_id long, url string, html string").withColumn("sha", F.lit("x")).withColumn("kind", F.lit(7))


def test_warc_round_trip(spark):
    got = sorted(((r.page_id, r.record_type, r.payload_bytes, r.refers_to) for r in warc.round_trip(pages(spark), most=1).collect()), key=str)
    want = [
        (1, "response", 4, None), (1, "revisit", 4, 1), (2, "response", 0, None), (3, "revisit", 4, 1), (4, "revisit", 0, 2), (5, "response", 300_000, None), (6, "response", 2, None), (None, "revisit", 4, 1),
        (None, "response", 9, None), (None, "response", 9, None),
    ]
    assert got == sorted(want, key=str)
    got = warc.round_trip(pages(spark), min_bytes=3, payloads=True).where("record_type = 'response'").collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got if r.page_id in (2, 4, 6)) == [(2, b""), (4, b""), (6, "é".encode())]
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def archive(dictionary, *records):
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    return struct.pack("<II", warc.DICT_FRAME, len(dictionary)) + dictionary + b"".join(coder.compress(r) for r in records)


def test_archives_are_validated():
    good = [warc.record(1, "http://a", b"<p>" * 1000, None, False), warc.record(2, "http://b", b"<p>" * 1000, 1, True)]
    data = archive(b"WARC/1.1 <p> content", *good)
    for chunk in (1, 7, 1 << 20):
        got = list(warc.read_archive(io.BytesIO(data), chunk))
        assert [(r["page_id"], r["type"], r["size"], r["refers_to"]) for r in got] == [(1, "response", 3000, None), (2, "revisit", 3000, 1)]
    packed = zstandard.ZstdCompressor().compress(b"WARC/1.1 <p> content")
    assert len(list(warc.read_archive(io.BytesIO(struct.pack("<II", warc.DICT_FRAME, len(packed)) + packed + data[8 + 20 :])))) == 2
    bad = [data[8 + 20 :], data[:-5], data[:4], archive(b"d" * 20, good[0][:-1]), archive(b"d" * 20, good[0].replace(b"Content-Length: 3000", b"Content-Length: 2999")), archive(b"d" * 20, good[0].replace(b"<p><p>", b"<q><p>", 1)), archive(b"d" * 20, b"WARC/9" + good[0][8:])]
    for b in bad:
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_archive(io.BytesIO(b)))


# Urls


def test_url_rules_and_aliases(spark, tmp_path):
    link = '<html><link href="{}" rel=x><LINK REL="canonical" HREF="{}"></html>'
    data = [
        (1, "http://A.Net/x", None), (2, "http://example.net/en/1", ""), (3, "http://sub.example.com/de/", "<p>"), (4, "http://x.org/fr/?q#f", None), (5, None, None), (6, "no scheme", "x"), (7, "http://x.net", None), (8, "http://notnet/x", None),
        (10, "http://alias.io/a", link.format("z", "http://b.io/b#frag")), (11, "http://b.io/b", '<meta http-equiv="refresh" content="0; url=//evil.net/p">'), (12, "http://c.io/c#top", link.format("z", "/d")), (13, "http://c.io/d", link.format("z", "http://y.org/fr/ok")),
        (14, "http://e.io/e", link.format("z", "http://spam.net/")), (15, "http://e.io/e", link.format("z", "http://y.org/fr/2")), (16, "http://spam.net/", None), (16, "http://spam.net/", None), (None, "http://e.io/self", link.format("z", "http://e.io/self")),
    ]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("r", F.lit(1))
    got = urls.filter_urls(df)
    against_sql(got, urls.oracle(), {"pages": df.select("page_id", "url", "html")}, tmp_path)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert by[1] == ("a.net", "/x", "net/", "block") and by[2] == ("example.net", "/en/1", "example.net/en/", "allow")
    assert by[3][2:] == ("example.com/de/", "block") and by[4] == ("x.org", "/fr/", "org/fr/", "allow")
    assert by[5] == by[6] == ("", "", None, "allow") and by[7] == ("x.net", "", None, "allow") and by[8][2:] == (None, "allow")
    assert by[10][3] == by[11][3] == "block" and by[12][3] == by[13][3] == "allow"
    assert by[14][3] == by[15][3] == "allow" and by[16][3] == "block"
    more = urls.filter_urls(df, redirects=spark.createDataFrame([("http://notnet/x#y", "http://evil.net/p")], "a string, b string"))
    assert {r.page_id: r.verdict for r in more.collect()}[8] == "block"
    assert urls.filter_urls(df.limit(0)).count() == 0
    table = spark.createDataFrame(urls.RULES, "verdict string, host string, path string")
    assert sorted(map(str, urls.filter_urls(df, table).collect())) == sorted(map(str, got.collect()))


def test_url_targets_are_decoded_and_resolved(spark):
    at = "http://h.io/a/b/c.html?x=1#top"
    to = ["index.html", "?p=1", "../x", "../../../x", "./", "..", "d/./e/../f?q=../r#s", "/g/../h", "//evil.net/p", "https://o.org/../k", "x?u=http://y.org/", ".hidden", "..x/y", "", "#part"]
    rows = spark.createDataFrame([(t,) for t in to], "t string").select("t", urls.resolved(F.lit(at), F.col("t")).alias("r")).collect()
    assert {r.t: r.r.split("#")[0] for r in rows} == {t: t if "://o." in t else urllib.parse.urljoin(at, t).split("#")[0] for t in to}
    rows = spark.createDataFrame([("http://h.io", "x"), ("http://h.io?q", "../x"), ("http://h.io", "?p"), ("no scheme", "x"), ("no scheme", "http://y.org/")], "u string, t string").select(urls.resolved(F.col("u"), F.col("t")).alias("r")).collect()
    assert [r.r for r in rows] == ["http://h.io/x", "http://h.io/x", "http://h.io?p", None, "http://y.org/"]
    texts = {
        "?p=1&amp;q=2": "?p=1&q=2", "&#47;a&#x2F;b": "/a/b", "&eacute;&#233;&#xE9;&#x1F600;": "ééé\U0001f600", "?a&copy=1&lt": "?a&copy=1<", "&ampx&amp": "&ampx&", "&nosuch;&&#;&#x;": "&nosuch;&&#;&#x;",
        "&amp;amp;": "&amp;", "&#128;&#0;&#xD800;&#99999999999;&#x110000;": "€\ufffd\ufffd\ufffd\ufffd", "plain": "plain", "": "",
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", urls.decoded(F.col("t")).alias("d")).collect()
    assert {r.t: r.d for r in rows} == texts


def test_url_aliases_by_relative_and_encoded_targets(spark):
    link, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    data = [
        (1, "http://a.io/d/one", refresh.format("index.html")), (2, "http://a.io/d/index.html", link.format("//evil.net/p")),
        (3, "http://b.io/x?p=0", link.format("?p=1")), (4, "http://b.io/x?p=1", link.format("http://evil.net/q")),
        (5, "http://c.io/d/e/f", link.format("../x")), (6, "http://c.io/d/x", link.format("http://evil.net/r")),
        (7, "http://d.io/z", link.format("http://d.io/x?p=1&amp;q=2")), (8, "http://d.io/x?p=1&q=2", link.format("http://evil.net/s")),
        (9, "http://e.io/z", refresh.format("&#39;t&#39;")), (10, "http://e.io/t", link.format("http://evil.net/t")),
        (11, "http://f.io/z", '<base href="/deep/">' + link.format("t")), (12, "http://f.io/deep/t", link.format("http://evil.net/u")),
        (13, "http://f.io/t", None), (14, "http://g.io/z", link.format("mailto:x")), (15, "http://g.io/y", link.format("#part")),
        (-1, "http://i.io/z", link.format("http://j.io/other") + refresh.format("http://k.io/") + link.format("http://evil.net/v")), (-2, "HTTP://K.io", None), (-3, "http://j.io/other", None),
    ]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.filter_urls(df).collect()}
    assert got == {i: "block" if i <= 12 else "allow" for i, *_ in data}
