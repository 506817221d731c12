"""Scorers: a Spark expression, a vectorised Arrow function, or a remote prediction service.

All add the columns of a response to the rows: values array<struct<label, value>>, prediction, and threshold and
explanations where the contract has them.
"""

from __future__ import annotations

import base64
import csv
import gzip
import http.client
import io
import json
import ssl
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillscore.operators.batching import MAX_BATCH_BYTES
from rillscore.operators.journal import last_attempt
from rillscore.operators.project import Contract
from rillscore.operators.response import unpack_legacy, unpack_v10

ATTEMPT = "batch_id long, n_rows long, status string, message string, response string"


class Scorer(Protocol):
    contract: Contract

    def score(self, df: DataFrame) -> DataFrame: ...


def class_values(probabilities: dict[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("label"), v.cast("double").alias("value")) for k, v in probabilities.items()])


@dataclass
class ExpressionScorer:
    """Probabilities by label (or one regression value) as Spark expressions: no Python at run time."""

    contract: Contract
    values: dict[str, Column]
    prediction: Column | None = None
    threshold: float | None = None
    explanations: Column | None = None

    def score(self, df: DataFrame) -> DataFrame:
        # A column for each label, in order: the projection takes these, and nothing sorts an array whose labels are known.
        df = df.withColumns({f"_value_{i}": self.values[label].cast("double") for i, label in enumerate(self.contract.sorted_labels())})
        values = class_values(dict(zip(self.contract.sorted_labels(), (F.col(f"_value_{i}") for i in range(len(self.values))), strict=True)))
        best = F.array_max(F.transform(values, lambda v: F.struct(v["value"].alias("v"), v["label"].alias("l"))))["l"]
        df = df.withColumn("values", values).withColumn("prediction", best if self.prediction is None else self.prediction.cast("string"))
        if self.contract.has_threshold:
            df = df.withColumn("threshold", F.lit(self.threshold).cast("double"))
        if self.contract.has_explanations:
            df = df.withColumn("explanations", self.explanations)
        return df


@dataclass
class ArrowScorer:
    """fn takes a record batch of the feature columns and returns one float64 array per label, in the contract's order."""

    contract: Contract
    features: list[str]
    fn: Callable[[pa.RecordBatch], list[pa.Array]]

    def score(self, df: DataFrame) -> DataFrame:
        names = [f"_p{i}" for i in range(len(self.contract.labels))]
        schema = StructType([*df.schema.fields, *StructType.fromDDL(", ".join(f"{n} double" for n in names)).fields])
        fn, features = self.fn, self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([*b.columns, *fn(b.select(features))], schema.names)

        out = df.mapInArrow(run, schema)
        return ExpressionScorer(self.contract, dict(zip(self.contract.labels, map(F.col, names), strict=True))).score(out).drop(*names)


@dataclass
class HttpScorer:
    """Posts CSV batches to a prediction service. Every batch ends in exactly one status; a bad one never fails a task."""

    contract: Contract
    url: str
    features: list[str]
    headers: dict[str, str] = field(default_factory=dict)
    rows: int = 1000
    concurrency: int = 4
    retries: int = 3
    timeout: float | None = None
    compress: bool = False
    max_bytes: int = MAX_BATCH_BYTES
    verify_ssl: bool = True
    ca_bundle: str | None = None
    legacy: bool = False
    dry_run: bool = False

    def __post_init__(self):
        if self.retries < 1:
            raise ValueError("retries must be at least 1")

    def attempts(self, df: DataFrame) -> DataFrame:
        """(batch_id, n_rows, status, message, response) of all batches of df(row_id, batch_id, features).

        Batches are posted by `concurrency` tasks. A batch of max_bytes or more is halved; a row that is too large alone
        is an error. 200 is ok; a time-out or a lost connection is final; other statuses are tried again, `retries` times.
        """
        me = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def by_batch() -> Iterator[tuple[int, list[list]]]:
                at, rows = None, []
                for b in batches:
                    for i, *cells in zip(*(c.to_pylist() for c in b.columns), strict=True):
                        if i != at and rows:
                            yield at, rows
                            rows = []
                        at = i
                        rows.append(cells)
                if rows:
                    yield at, rows

            for start, rows in by_batch():
                for got in me.send(start, [r[0] for r in rows], [r[1:] for r in rows]):
                    yield pa.RecordBatch.from_pylist([got], pa.schema([("batch_id", pa.int64()), ("n_rows", pa.int64()), ("status", pa.string()), ("message", pa.string()), ("response", pa.string())]))

        cells = df.select("batch_id", "row_id", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in self.features])
        return cells.repartition(self.concurrency, "batch_id").sortWithinPartitions("batch_id", "row_id").mapInArrow(run, ATTEMPT)

    def payload(self, rows: list[list]) -> bytes:
        out = io.StringIO()
        w = csv.writer(out, lineterminator="\n")
        w.writerow(self.features)
        w.writerows(rows)
        return out.getvalue().encode()

    def send(self, start: int, ids: list[int], rows: list[list]) -> Iterator[dict]:
        todo = [(0, len(rows))]
        while todo:
            a, z = todo.pop()
            body = self.payload(rows[a:z])
            if len(body) >= self.max_bytes and z - a > 1:
                todo += [(a + (z - a) // 2, z), (a, a + (z - a) // 2)]
                continue
            out = {"batch_id": ids[a], "n_rows": z - a, "status": "error", "message": None, "response": None}
            if len(body) >= self.max_bytes:
                yield out | {"message": f"row {ids[a]} is larger than {self.max_bytes} bytes"}
            elif self.dry_run:
                yield out | {"status": "dry"}
            else:
                yield out | self.post(body)

    def post(self, body: bytes, final: tuple[int, ...] = ()) -> dict:
        """The end of one request: ok with the response, or error. Statuses in `final` are not tried again; nothing is raised."""
        headers = {"content-type": "text/csv; charset=utf8", **self.headers}
        if self.compress:
            body, headers["Content-Encoding"] = gzip.compress(body, 2), "gzip"
        said = ""
        for _ in range(self.retries):
            try:
                context = None
                if self.url.startswith("https"):
                    context = ssl.create_default_context(cafile=self.ca_bundle) if self.verify_ssl else ssl._create_unverified_context()
                with urllib.request.urlopen(urllib.request.Request(self.url, body, headers), timeout=self.timeout, context=context) as r:
                    text = r.read().decode()
                    json.loads(text)
                    return {"status": "ok", "response": text}
            except urllib.error.HTTPError as e:
                said = f"status {e.code}"
                if e.code in final:
                    return {"status": "error", "message": said}
            except (ValueError, http.client.HTTPException) as e:  # no JSON, or cut off halfway
                said = f"malformed response: {type(e).__name__} {e}"
            except OSError as e:
                return {"status": "error", "message": f"no response: {type(e).__name__}"}
        return {"status": "error", "message": f"{said}, exceeded retry limit"}

    def unpack(self, attempts: DataFrame) -> DataFrame:
        good = attempts.where("status = 'ok'")
        return unpack_legacy(good) if self.legacy else unpack_v10(good)

    def score(self, df: DataFrame) -> DataFrame:
        """All rows of df(row_id, ...) with their predictions and `_status`: rows of lost batches have nulls and `lost`."""
        got = self.unpack(last_attempt(self.attempts(df).withColumn("attempt", F.lit(1)))).where("status = 'ok'").drop("batch_id").withColumnRenamed("status", "_status")
        return df.join(got, "row_id", "left").withColumn("_status", F.coalesce("_status", F.lit("lost")))


#: Statuses of the validation call that end a run before it starts, and what they mean.
FATAL = {400: "bad request", 401: "not authorised", 403: "forbidden", 405: "method not allowed", 422: "the rows do not fit the model", 502: "the service is not there"}


def endpoint(host: str, project_id: str | None = None, model_id: str | None = None, deployment_id: str | None = None, import_id: str | None = None, max_explanations: int = 0, api: str = "predApi/v1.0") -> str:
    """The prediction URL for a model, a deployment or an imported model."""
    base = f"{host.rstrip('/')}/{api}"
    at = f"{base}/{import_id}" if import_id else f"{base}/deployments/{deployment_id}" if deployment_id else f"{base}/{project_id}/{model_id}"
    if max_explanations:
        return f"{at}/{'predictionExplanations' if deployment_id else 'reasonCodesPredictions'}?maxCodes={max_explanations}"
    return f"{at}/{'predictions' if deployment_id else 'predict'}"


def acquire_token(host: str, user: str, password: str, create: bool = False, api: str = "predApi/v1.0", timeout: float | None = None) -> str:
    """The user's API token from the service; it is neither printed nor logged. create asks for a new one."""
    auth = base64.b64encode(f"{user}:{password}".encode()).decode()
    request = urllib.request.Request(f"{host.rstrip('/')}/{api}/api_token", method="POST" if create else "GET", headers={"Authorization": f"Basic {auth}"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            token = json.loads(r.read()).get("api_token")
    except urllib.error.HTTPError as e:
        raise ValueError("wrong user or password" if e.code == 401 else f"no token: status {e.code}") from None
    if not token:
        raise ValueError("the user has no API token; ask for one to be created")
    return token


def preflight(scorer: HttpScorer, first_row: list) -> None:
    """Post one row before any job runs; raises with a clear text where the service will not answer."""
    got = scorer.post(scorer.payload([first_row]), tuple(FATAL))
    if got["status"] != "ok":
        code = next((c for c in FATAL if got["message"] and f"status {c}" in got["message"]), None)
        raise ValueError(f"the prediction service refused the first row: {FATAL.get(code, got['message'])}")
