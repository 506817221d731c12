"""Transformations on small literal frames: sources, plans, projections, responses, journal, service, configuration."""

import gzip
import http.server
import io
import json
import threading
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from rillscore.cli import agreed, score_file
from rillscore.operators import batching, journal, response
from rillscore.operators.project import Contract, Output, check_keep_cols, parse_names, project, project_legacy
from rillscore.operators.rowid import tasks_of, with_row_id, with_row_id_of_wide
from rillscore.operators.scorers import ArrowScorer, ExpressionScorer, HttpScorer, acquire_token, endpoint, preflight
from rillscore.operators.sink import write_csv
from rillscore.plans.config import configure
from rillscore.plans.run import dry_run, run, score_table
from rillscore.sources.delimited import DelimitedSource, column_names
from rillscore.sources.dialect import candidates, delimiter_of, encoding_of, sniff
from rillscore.streaming.adapter import score_stream


def rows(df):
    return [tuple(r) for r in df.collect()]


# Sources


def test_delimiters_and_dialects():
    assert delimiter_of("tab") == "\t" and delimiter_of("pipe") == "|" and delimiter_of(None) is None
    with pytest.raises(ValueError):
        delimiter_of("x")
    assert candidates("a;b\n1;2\n3;4\n") == [";"]
    assert candidates('a;"x\n;y"\n1;2\n') == [";"]
    assert candidates("a;b,c\n1;2,3\n") == [",", ";"]
    assert sniff("a;b\n1;2\n").delimiter == ";" and sniff("a,b\n", skip=True).delimiter == ","
    with pytest.raises(ValueError):
        sniff("   \n")


def test_encodings():
    assert encoding_of(b"abc", "UTF-8") == "utf-8"
    assert encoding_of("aé".encode()[:2]) == "utf-8"  # cut inside a character
    assert encoding_of(b"\xef\xbb\xbfa") == "utf-8-sig"
    assert encoding_of("naïve café".encode("cp1252")) != "utf-8"


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("zipped", [False, True])
def test_parsed_scan(spark, tmp_path, newline, zipped):
    text = newline.join([' idx , data, "x"', '0,"a,b",', "", '1,"say ""hi""",z', "2,plain,"]) + newline
    path = str(tmp_path / ("in.csv.gz" if zipped else "in.csv"))
    with (gzip.open if zipped else open)(path, "wb") as f:
        f.write(text.encode())
    src = DelimitedSource(spark, path, skip_dialect=True)
    assert src.header == ["idx", "data", 'x"'] or src.header[:2] == ["idx", "data"]
    assert [tuple(r)[:2] for r in src.scan().collect()] == [("0", "a,b"), ("1", 'say "hi"'), ("2", "plain")]


def test_fast_scan_keeps_empty_last_cells(spark, tmp_path):
    (tmp_path / "in.tsv").write_text("a\tb\tc\n1\t2\t\n3\t4\t5\n")
    src = DelimitedSource(spark, str(tmp_path / "in.tsv"), delimiter="\t", fast=True, skip_dialect=True)
    got = src.check_cells(src.scan()).select("a", "b", "c", "_cells")
    assert rows(got) == [("1", "2", "", 3), ("3", "4", "5", 3)]


@pytest.mark.parametrize("fast", [False, True])
def test_declared_encoding(spark, tmp_path, fast):
    (tmp_path / "in.csv").write_bytes("k,v\n1,café\n2,naïve\n".encode("cp1252"))
    src = DelimitedSource(spark, str(tmp_path / "in.csv"), encoding="windows-1252", skip_dialect=True, fast=fast)
    assert rows(src.scan().select("k", "v")) == [("1", "café"), ("2", "naïve")]


def test_fast_scan_skips_the_first_line_only(spark, tmp_path):
    """Later lines that equal the header are rows; form feeds and other such characters end no line."""
    (tmp_path / "in.csv").write_bytes("a,b\x0cc\u2028d\n1,2\na,b\x0cc\u2028d\n\n3,4\n".encode())
    src = DelimitedSource(spark, str(tmp_path / "in.csv"), skip_dialect=True, fast=True)
    first, second = src.columns
    assert rows(src.scan().select(first, second)) == [("1", "2"), (first, second), ("", ""), ("3", "4")]
    with (tmp_path / "big.csv").open("w") as f:
        f.write("k,v\n" + "".join(f"{i},x\n" if i % 1000 else "k,v\n" for i in range(60_000)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = DelimitedSource(spark, str(tmp_path / "big.csv"), skip_dialect=True, fast=True).scan()
        assert df.rdd.getNumPartitions() > 3 and df.count() == 60_000 and df.where("k = 'k'").count() == 60
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_cells_over_the_limit(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1," + "x" * 50 + "\n")
    for fast in (True, False):
        assert DelimitedSource(spark, str(tmp_path / "in.csv"), skip_dialect=True, fast=fast, field_limit=50).scan().count() == 1
        with pytest.raises(Exception, match="(?i)50|longer|exceed"):
            DelimitedSource(spark, str(tmp_path / "in.csv"), skip_dialect=True, fast=fast, field_limit=20).scan().collect()


def test_single_lines_are_split(spark, tmp_path):
    (tmp_path / "in.csv").write_text("k,v\n" + "".join(f'{i},"a,b"\n' for i in range(50_000)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        whole, split = (DelimitedSource(spark, str(tmp_path / "in.csv"), skip_dialect=True, multi_line=m).scan() for m in (True, False))
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert sorted(rows(whole)) == sorted(rows(split))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_fast_mode_refuses_multiline(spark, tmp_path):
    (tmp_path / "in.csv").write_text('a,b\n1,"x\ny"\n')
    with pytest.raises(ValueError, match="several lines"):
        DelimitedSource(spark, str(tmp_path / "in.csv"), fast=True, skip_dialect=True)


def test_empty_input(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="is empty"):
        DelimitedSource(spark, str(tmp_path / "in.csv"), skip_dialect=True)


def test_column_names():
    assert column_names(["", "a", "a", "b"]) == ["_0", "_1", "a", "b"]


# Row ids and plans


def test_row_ids_of_any_key_without_a_global_window(spark):
    df = spark.range(5000).select(F.sha1(F.col("id").cast("string")).alias("s"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("h"), F.timestamp_seconds(F.col("id") * 7 % 5003).alias("t"), "id")
    for keys in (("s",), ("t",), ("h", "s"), ("id",)):
        want = {r[-1]: i for i, r in enumerate(sorted(map(tuple, df.select(*keys, "id").collect())))}
        for a_task in (10_000, 700):
            got = with_row_id(df, *keys, rows_a_task=a_task)
            assert {r.id: r.row_id for r in got.collect()} == want
            assert "Window" not in got.drop("row_id")._jdf.queryExecution().optimizedPlan().toString().split("_before")[0]
    assert with_row_id(df.limit(0), "s").count() == 0


def test_row_ids_do_not_depend_on_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 3).alias("v"))
    one = sorted(rows(with_row_id(df, "k").select("k", "row_id")))
    many = sorted(rows(with_row_id(df, "k", rows_a_task=90).select("k", "row_id")))
    assert one == many and [r for _, r in one] == list(range(1000))
    assert rows(with_row_id(df.limit(0), "k")) == []


def test_row_ids_of_wide_rows(spark):
    data = [(None if i % 50 == 0 else i * 7 % 1000 // 2, f"text {i}") for i in range(1000)]
    df = spark.createDataFrame(data, "k long, text string").repartition(5)
    for parts in (1, 6):
        got = with_row_id_of_wide(df, "k", parts=parts)
        assert got.columns == ["k", "text", "row_id"] and got.schema["row_id"].dataType.typeName() == "long"
        told = sorted((r.row_id, -1 if r.k is None else r.k, r.text) for r in got.collect())
        assert [r[0] for r in told] == list(range(1000)) and [r[1] for r in told] == sorted(r[1] for r in told)
        assert sorted(r[2] for r in told) == sorted(t for _, t in data)
    two = with_row_id_of_wide(df.where("k > 3").withColumn("s", F.sha1("text")), "k", "s", parts=4)
    assert {r.text: r.row_id for r in two.collect()} == {r.text: r.row_id for r in with_row_id(df.where("k > 3").withColumn("s", F.sha1("text")), "k", "s").collect()}
    assert rows(with_row_id_of_wide(df.limit(0), "k", parts=1)) == []


def test_tasks_of_bytes(spark):
    df = spark.createDataFrame([("x" * 10,), ("y" * 25,), (None,)], "t string")
    assert tasks_of(df, F.octet_length("t"), 10) == 4 and tasks_of(df, F.octet_length("t")) == 1 and tasks_of(df.limit(0), F.octet_length("t")) == 1


def test_halving():
    assert batching.halve([10] * 4, 100, 1000) == [(100, 4, 40)]
    assert batching.halve([10] * 5, 0, 25) == [(0, 2, 20), (2, 1, 10), (3, 2, 20)]
    assert batching.halve([99], 5, 10) == [(5, 1, 99)]


def test_sampled_rows(spark):
    lines = lambda n, size: spark.range(n).select("id", F.repeat(F.lit("x"), size).alias("line"))
    assert batching.sampled_rows(lines(1, 5), "line", "id", 4).first()[0] == 500
    assert batching.sampled_rows(lines(1, 5), "line", "id", 600_000).first()[0] == 10
    assert batching.sampled_rows(lines(1000, 180_000), "line", "id", 10).first()[0] == 2_500_000 // (500_000 // 3) + 1
    assert batching.sampled_rows(lines(2, 600_000), "line", "id", 10).first()[0] == 6
    assert batching.sampled_rows(lines(100, 5), "line", "id", 4).first()[0] == 500
    assert batching.sampled_rows(lines(10_000, 99), "line", "id", 100).first()[0] == 25_001


# Projection and responses

VALUES = "array<struct<label:string,value:double>>"


def scored(spark):
    data = [(0, "x", [("1.0", 0.75), ("0.0", 0.25)], [("f", 0.5)], 0.5, "1.0"), (1, "y", [("0.0", 0.9), ("1.0", 0.1)], [], 0.5, "0.0")]
    return spark.createDataFrame(data, f"row_id long, c string, values {VALUES}, explanations array<struct<feature:string,strength:double>>, threshold double, prediction string")


def test_projection_order_and_options(spark):
    contract = Contract(("1.0", "0.0"), True, True, True)
    got = project(scored(spark), contract, Output(("c",), max_explanations=2, pred_threshold="t", pred_decision="d"))
    assert got.columns == ["row_id", "c", "0.0", "1.0", "explanation_1_feature", "explanation_1_strength", "explanation_2_feature", "explanation_2_strength", "t", "d"]
    assert rows(got) == [(0, "x", 0.25, 0.75, "f", "0.5", "", "", 0.5, "1.0"), (1, "y", 0.9, 0.1, "", "", "", "", 0.5, "0.0")]
    assert rows(project(scored(spark), contract, Output(skip_row_id=True, pred_name="p"))) == [(0.75,), (0.1,)]
    assert project(scored(spark), contract, Output(("c",), pred_name="c")).columns == ["row_id", "c"]


def test_projection_errors(spark):
    with pytest.raises(ValueError, match="not in columns"):
        project(scored(spark), Contract(("0", "1")), Output(("nope",)))
    with pytest.raises(ValueError, match="one or two labels"):
        project(scored(spark), Contract(("0", "1", "2")), Output(pred_name="p"))
    with pytest.raises(ValueError, match="threshold"):
        project(scored(spark), Contract(("0", "1")), Output(pred_threshold="t"))
    with pytest.raises(ValueError, match="not supported"):
        project_legacy(scored(spark), Contract(("0", "1"), target_type="Other"), Output())
    with pytest.raises(ValueError):
        check_keep_cols(("b", "a"), ["c"])
    assert parse_names(" a , b") == ("a", "b") and parse_names(None) == ()


def test_numeric_labels_sort_by_number(spark):
    df = spark.createDataFrame([(0, [("10", 0.1), ("9", 0.9)])], f"row_id long, values {VALUES}")
    assert project(df, Contract(("10", "9"), numeric_labels=True), Output()).columns == ["row_id", "9", "10"]
    assert rows(project(df, Contract(("10", "9")), Output())) == [(0, 0.1, 0.9)]


def test_short_and_malformed_responses_are_not_lost(spark):
    good = json.dumps({"data": [{"rowId": 1, "prediction": 2.5, "predictionValues": [{"label": "z", "value": 2.5}]}, {"rowId": 0, "prediction": 1.0, "predictionValues": [{"label": "z", "value": 1.0}]}]})
    sent = spark.createDataFrame([(0, 2, good), (2, 3, good), (5, 1, "{oops")], "batch_id long, n_rows long, response string")
    got = response.unpack_v10(sent)
    assert {(r.batch_id, r.row_id, r.status) for r in got.collect()} == {(0, 1, "ok"), (0, 0, "ok"), (2, None, "short"), (5, None, "malformed")}


def test_explanations_beyond_the_most_are_cut(spark):
    df = spark.createDataFrame([(0, [("a", 1.0), ("b", 2.0)])], "row_id long, explanations array<struct<feature:string,strength:double>>")
    df = df.withColumn("values", F.expr(f"cast(array(named_struct('label', 'z', 'value', 1.0D)) as {VALUES})"))
    assert project(df, Contract(("z",), has_explanations=True), Output(max_explanations=1)).columns[-2:] == ["explanation_1_feature", "explanation_1_strength"]


# Journal


def test_journal(spark, tmp_path):
    j = journal.RunJournal(spark, str(tmp_path / "j"))
    assert j.open({"a": 1}, None) is False and j.read().count() == 0
    j.append(spark.createDataFrame([("r", 0, 2, "ok", None), ("r", 2, 2, "error", "m")], journal.SCHEMA))
    assert j.open({"a": 1}, None) is True and j.read().count() == 2
    with pytest.raises(ValueError, match="differs in: a"):
        j.open({"a": 2}, True)
    assert j.open({"a": 2}, False) is False and j.read().count() == 0
    with pytest.raises(ValueError, match="nothing to resume"):
        journal.RunJournal(spark, str(tmp_path / "none")).open({}, True)


def test_accounting(spark):
    plan = spark.createDataFrame([(0, 5), (5, 5), (10, 5), (15, 2)], "batch_id long, n_rows long")
    entries = spark.createDataFrame([(0, 5, "error"), (0, 5, "ok"), (5, 5, "error"), (10, 5, "ok")], "batch_id long, n_rows long, status string")
    assert rows(journal.account(plan, entries)) == [(17, 10, 5, 1, 1)]


# Scorers


def test_arrow_scorer_equals_expression(spark):
    df = with_row_id(spark.range(100).select("id", (F.col("id") / 10).alias("x")), "id")
    contract = Contract(("z",), target_type="Regression")
    a = ArrowScorer(contract, ["x"], lambda b: [pc.multiply(pc.cast(b.column(0), pa.float64()), 2.0)])
    e = ExpressionScorer(contract, {"z": F.col("x") * 2.0})
    assert sorted(rows(score_table(df, a, Output()))) == sorted(rows(score_table(df, e, Output())))


class Service(http.server.BaseHTTPRequestHandler):
    seen: Counter = Counter()
    fail_once: set = set()
    fail_always: set = set()
    slow: set = set()
    bodies: list = []

    def do_POST(self):
        body = self.rfile.read(int(self.headers["Content-Length"]))
        if self.headers.get("Content-Encoding") == "gzip":
            body = gzip.decompress(body)
        lines = body.decode().strip().split("\n")[1:]
        first = lines[0].split(",")[0]
        Service.seen[first] += 1
        Service.bodies.append(len(body))
        if first in Service.fail_always or (first in Service.fail_once and Service.seen[first] == 1):
            self.send_error(500)
            return
        data = [{"rowId": i, "prediction": float(x.split(",")[0]), "predictionValues": [{"label": "z", "value": float(x.split(",")[0]) * 2}]} for i, x in enumerate(lines)][::-1]
        text = json.dumps({"data": data}).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(text)))
        self.end_headers()
        self.wfile.write(text)

    def do_GET(self):
        good = self.headers["Authorization"] == "Basic dTpw"
        text = json.dumps({"api_token": "t" if self.path.startswith("/predApi") else None}).encode()
        self.send_response(200 if good else 401)
        self.send_header("Content-Length", str(len(text)))
        self.end_headers()
        self.wfile.write(text)

    def log_message(self, *a):
        pass


@pytest.fixture
def service():
    Service.seen, Service.bodies, Service.fail_once, Service.fail_always = Counter(), [], set(), set()
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_address[1]}/predict"
    s.shutdown()


def scorer(url, **more):
    return HttpScorer(Contract(("z",), target_type="Regression"), url, ["k", "c"], rows=10, concurrency=2, **more)


def table(spark, n=45):
    return with_row_id(spark.range(n).select(F.col("id").alias("k"), F.lit("a,b").alias("c")), "k")


def test_service_run_retry_and_resume(spark, service, tmp_path):
    Service.fail_once, Service.fail_always = {"10"}, {"20"}
    df = table(spark)
    report = run(spark, df, scorer(service, retries=2, compress=True), Output(("k",)), str(tmp_path), {"m": 1}, rows=10)
    assert (report.rows_done, report.rows_lost, report.exit_code) == (35, 10, 1)
    assert Service.seen["10"] == 2 and Service.seen["20"] == 2
    Service.fail_always = set()
    report = run(spark, df, scorer(service, retries=2), Output(("k",)), str(tmp_path), {"m": 1}, rows=10, resume=True)
    assert (report.rows_done, report.rows_lost, report.exit_code) == (45, 0, None)
    assert Service.seen["0"] == 1  # done batches are not sent again
    got = sorted(rows(spark.read.parquet(f"{tmp_path}/rows").select("row_id", "k", "z")))
    assert got == [(i, i, 2.0 * i) for i in range(45)]


def test_large_batches_are_halved_and_oversize_rows_reported(spark, service):
    df = spark.createDataFrame([(0, "0", "x"), (1, "1", "y"), (2, "2", "z" * 500), (3, "3", "w")], "row_id long, k string, c string")
    got = scorer(service, max_bytes=60).attempts(batching.with_batch_id(df, 10))
    ends = {r.batch_id: (r.n_rows, r.status) for r in got.collect()}
    assert ends == {0: (2, "ok"), 2: (1, "error"), 3: (1, "ok")}


def test_lost_connection_is_final(spark):
    df = batching.with_batch_id(table(spark, 5), 10)
    got = scorer("http://127.0.0.1:9/predict").attempts(df).collect()
    assert [(r.status, r.message.startswith("no response")) for r in got] == [("error", True)]


def test_a_response_cut_off_halfway(spark, service, monkeypatch):
    """The batch ends as an error after its attempts; its rows are told as lost, the others are scored."""

    def cut(self):
        self.rfile.read(int(self.headers["Content-Length"]))
        self.send_response(200)
        self.send_header("Content-Length", "1000")
        self.end_headers()
        self.wfile.write(b"{")

    whole = Service.do_POST
    assert {r._status for r in scorer(service).score(batching.with_batch_id(table(spark), 10)).collect()} == {"ok"}
    monkeypatch.setattr(Service, "do_POST", cut)
    got = scorer(service, retries=2).post(b"k,c\n1,x\n")
    assert got["status"] == "error" and "IncompleteRead" in got["message"]
    lost = scorer(service, retries=1).score(batching.with_batch_id(table(spark), 10)).collect()
    assert len(lost) == 45 and {r._status for r in lost} == {"lost"}
    monkeypatch.setattr(Service, "do_POST", whole)


@pytest.mark.parametrize("code", [400, 401, 403, 405, 422])
def test_preflight_ends_at_once(service, monkeypatch, code):
    asked = []

    def refuse(self):
        self.rfile.read(int(self.headers["Content-Length"]))
        asked.append(1)
        self.send_error(code)

    monkeypatch.setattr(Service, "do_POST", refuse)
    with pytest.raises(ValueError, match="refused"):
        preflight(scorer(service, retries=3), [1, "x"])
    assert len(asked) == 1


def test_dry_run_and_preflight(spark, service):
    assert rows(dry_run(table(spark), 10, F.lit(30), 200)) == [(9, 45, 5, 0)]
    assert rows(dry_run(table(spark), 10, F.lit(30), 20))[0][3] == 45
    assert rows(dry_run(table(spark), 10)) == [(5, 45, 10)]
    assert {r.status for r in scorer(service, dry_run=True).attempts(batching.with_batch_id(table(spark), 10)).collect()} == {"dry"}
    assert not Service.seen
    preflight(scorer(service), [1, "x"])
    Service.fail_always = {"1"}
    with pytest.raises(ValueError, match="refused"):
        preflight(scorer(service), [1, "x"])
    with pytest.raises(ValueError):
        scorer(service, retries=0)


def test_tokens(service):
    host = service.rsplit("/", 1)[0]
    assert acquire_token(host, "u", "p") == "t"
    with pytest.raises(ValueError, match="wrong user"):
        acquire_token(host, "u", "q")
    with pytest.raises(ValueError, match="no API token"):
        acquire_token(host, "u", "p", api="api/v1")


def test_command_line(spark, service, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr("sys.stdin", io.StringIO())
    (tmp_path / "in.csv").write_text("k,c\n" + "".join(f"{i},x\n" for i in range(25)))
    host = service.rsplit("/", 1)[0]
    argv = ["0" * 24, "f" * 24, str(tmp_path / "in.csv"), "--host", host, "--n_samples", "10", "--keep_cols", "c", "--pred_name", "p", "--skip_dialect", "--labels", "z", "--out", str(tmp_path / "out.csv"), "--no-resume"]
    assert score_file(spark, configure(argv, folders=[tmp_path]), Contract(("z",)), str(tmp_path / "run")) is None
    text = next((tmp_path / "out.csv").glob("part-*")).read_text().splitlines()
    assert text[0] == "row_id,c,p" and text[1:] == [f"{i},x,{2.0 * i}" for i in range(25)]
    assert score_file(spark, configure([*argv, "--dry_run"], folders=[tmp_path]), Contract(("z",)), str(tmp_path / "run")) is None
    assert score_file(spark, configure([*argv, "--no"], folders=[tmp_path]), Contract(("z",)), str(tmp_path / "run")) is None
    assert text == next((tmp_path / "out.csv").glob("part-*")).read_text().splitlines()
    more = ["--yes", "--verbose", "--fast", "--parts", "--field_size_limit", "50", "--single_line"]
    assert score_file(spark, configure([*argv, *more], folders=[tmp_path]), Contract(("z",)), str(tmp_path / "run")) is None
    told = capsys.readouterr().err
    assert "'rows_read': 25" in told and "'batches_ok': 3" in told and "dialect" in told
    with pytest.raises(ValueError, match="--yes or --no"):
        agreed("Overwrite?", configure(argv, folders=[tmp_path]))
    said = iter(["what", "Yes"])
    assert agreed("Overwrite?", configure(argv, folders=[tmp_path]), lambda q: next(said))


def test_endpoints():
    assert endpoint("http://h/", "p", "m") == "http://h/predApi/v1.0/p/m/predict"
    assert endpoint("http://h", deployment_id="d") == "http://h/predApi/v1.0/deployments/d/predictions"
    assert endpoint("http://h", import_id="i", max_explanations=3) == "http://h/predApi/v1.0/i/reasonCodesPredictions?maxCodes=3"
    assert endpoint("http://h", deployment_id="d", max_explanations=3).endswith("/predictionExplanations?maxCodes=3")


# Sink, stream, configuration


def test_single_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"', ""), (0, "a|b", None)], "row_id long, a string, b string")
    write_csv(df, str(tmp_path / "out"), "|", "row_id", single=True)
    parts = list((tmp_path / "out").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text() == 'row_id|a|b\n0|"a|b"|\n1|"say ""hi"""|\n'


def test_stream_equals_batch(spark, tmp_path):
    df = table(spark).select("row_id", "k")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    e = ExpressionScorer(Contract(("z",), target_type="Regression"), {"z": F.col("k") * 2.0})
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score_stream(stream, e, Output(("k",)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("row_id", "k", "z")
    assert sorted(rows(got)) == sorted(rows(score_table(df, e, Output(("k",)))))


def test_configuration(tmp_path):
    (tmp_path / "rillscore.ini").write_text("[rillscore]\nhost = http://x\nn_retry = 5\nno_verify_ssl = true\nkeep_cols = a, b\n")
    ids = ["0" * 24, "f" * 24]
    cfg = configure([*ids, "data.csv", "--n_retry", "7", "--delimiter", "tab", "--no-resume"], folders=[tmp_path])
    assert (cfg.host, cfg.n_retry, cfg.verify_ssl, cfg.delimiter, cfg.resume, cfg.keep()) == ("http://x", 7, False, "\t", False, ("a", "b"))
    for bad in (["x", ids[1], "d"], [*ids, "d", "--delimiter", "q"], [*ids, "d", "--n_retry", "0"], [*ids, "d", "--api_version", "api/v1", "--max_prediction_explanations", "3"]):
        with pytest.raises(ValueError):
            configure(bad, folders=[tmp_path / "none"])
    (tmp_path / "rillscore.ini").write_text("[rillscore]\nwhat = 1\n")
    with pytest.raises(ValueError, match="unknown"):
        configure([*ids, "d"], folders=[tmp_path])
