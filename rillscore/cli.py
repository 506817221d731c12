"""Command line: score a delimited file against a prediction service."""

from __future__ import annotations

import base64
import logging
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillscore.functions.scalar import csv_line
from rillscore.operators.batching import sampled_rows
from rillscore.operators.project import Contract, Output, check_keep_cols, parse_names
from rillscore.operators.rowid import with_row_id
from rillscore.operators.scorers import HttpScorer, acquire_token, endpoint, preflight
from rillscore.operators.sink import write_csv
from rillscore.plans.config import ScoreConfig, configure
from rillscore.plans.run import dry_run, run
from rillscore.sources.delimited import DelimitedSource
from rillscore.sources.dialect import FIELD_LIMIT


log = logging.getLogger("rillscore")


def numbered(source: DelimitedSource, check: bool = False) -> DataFrame:
    """Rows of the file with ids in file order; check: fast rows must have as many cells as the header."""
    rows = source.check_cells(source.scan()) if check and source.fast else source.scan()
    return with_row_id(rows.withColumn("_at", F.monotonically_increasing_id()), "_at").drop("_at")


def agreed(question: str, cfg: ScoreConfig, ask: Callable[[str], str] | None = None) -> bool:
    """Yes or no by the options, else by asking on a terminal; where nobody can be asked, an error."""
    if cfg.yes or cfg.no:
        return cfg.yes
    if ask is None:
        if not sys.stdin.isatty():
            raise ValueError(f"{question} Decide with --yes or --no.")
        ask = input
    while (said := ask(f"{question} (yes/no) ").strip().lower()) not in ("y", "yes", "n", "no"):
        pass
    return said in ("y", "yes")


def set_up_logging(cfg: ScoreConfig) -> None:
    """Messages go to stderr, or to stdout if asked for; details with --verbose. Secrets are in none."""
    handler = logging.StreamHandler(sys.stdout if cfg.stdout else sys.stderr)
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    log.handlers[:] = [handler]
    log.setLevel(logging.DEBUG if cfg.verbose else logging.INFO)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def score_file(spark: SparkSession, cfg: ScoreConfig, contract: Contract, folder: str) -> int | None:
    set_up_logging(cfg)
    source = DelimitedSource(spark, cfg.dataset, cfg.delimiter, cfg.encoding, cfg.skip_dialect, cfg.fast, cfg.field_size_limit or FIELD_LIMIT, not cfg.single_line)
    log.debug("encoding %s, dialect %s, columns %s", source.encoding, source.dialect, source.columns)
    check_keep_cols(cfg.keep(), source.header)
    df = numbered(source, bool(cfg.keep()))
    line = csv_line([F.col(f"`{c}`") for c in source.columns])
    rows = cfg.n_samples
    if rows is None:
        measured = df.select("row_id", line.alias("line"))
        rows = sampled_rows(measured, "line", "row_id", len(",".join(source.header)) + 1).first()[0]
        log.info("%d rows a batch", rows)
    if cfg.dry_run:
        log.info("dry run: %s", dry_run(df, rows, F.octet_length(line) + 1).first().asDict())
        return None
    if _exists(spark, cfg.out) and cfg.resume is not True and not agreed(f"{cfg.out} exists. Overwrite it?", cfg):
        return None
    if cfg.resume is None and _exists(spark, f"{folder}/journal"):
        cfg.resume = agreed("There is a journal of an earlier run. Resume it?", cfg)
    headers = {"User-Agent": "rillscore"}
    if cfg.service_key:
        headers[cfg.key_header] = cfg.service_key
    if cfg.api_token is None and cfg.user and cfg.password:
        cfg.api_token = acquire_token(cfg.host or "", cfg.user, cfg.password, cfg.create_api_token, cfg.api_version, cfg.timeout)
    if cfg.api_token:
        headers["Authorization"] = "Basic " + base64.b64encode(f"{cfg.user}:{cfg.api_token}".encode()).decode()
    url = endpoint(cfg.host or "", cfg.project_id, cfg.model_id, cfg.deployment_id, cfg.import_id, cfg.max_prediction_explanations, cfg.api_version)
    scorer = HttpScorer(contract, url, source.columns, headers, rows, cfg.n_concurrent, cfg.n_retry, cfg.timeout, cfg.compress, verify_ssl=cfg.verify_ssl, ca_bundle=cfg.ca_bundle, legacy=cfg.api_version == "api/v1")
    first = df.orderBy("row_id").select(*[F.col(f"`{c}`") for c in source.columns]).first()
    preflight(scorer, list(first))
    out = Output(cfg.keep(), cfg.skip_row_id, cfg.pred_name, cfg.pred_threshold, cfg.pred_decision, cfg.max_prediction_explanations)
    report = run(spark, df, scorer, out, folder, cfg.manifest(), rows, cfg.resume)
    write_csv(spark.read.parquet(f"{folder}/rows").drop("part"), cfg.out, cfg.output_delimiter or source.dialect.delimiter, None if cfg.skip_row_id else "row_id", single=not cfg.parts, mode="overwrite")
    return report.exit_code


def main(argv: list[str] | None = None, ids: tuple[str, ...] = ("project_id", "model_id")) -> int | None:
    try:
        cfg = configure(sys.argv[1:] if argv is None else argv, ids)
        labels = parse_names(cfg.labels)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    spark = SparkSession.builder.appName("rillscore").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return score_file(spark, cfg, Contract(labels, has_threshold=bool(cfg.pred_threshold), has_explanations=bool(cfg.max_prediction_explanations)), f"{cfg.out}.run")


def main_deployment() -> int | None:
    return main(ids=("deployment_id",))


def main_imported() -> int | None:
    return main(ids=("import_id",))


if __name__ == "__main__":
    sys.exit(main())
