"""Run options: defaults, an ini file (working folder before home), and the command line over both."""

from __future__ import annotations

import argparse
import configparser
import re
from dataclasses import dataclass, fields
from pathlib import Path

from rillscore import __version__
from rillscore.functions.scalar import OBJECT_ID
from rillscore.operators.project import parse_names
from rillscore.sources.dialect import delimiter_of

INI, SECTION = "rillscore.ini", "rillscore"


@dataclass
class ScoreConfig:
    dataset: str = ""
    host: str | None = None
    out: str = "out.csv"
    project_id: str | None = None
    model_id: str | None = None
    deployment_id: str | None = None
    import_id: str | None = None
    api_version: str = "predApi/v1.0"
    user: str | None = None
    password: str | None = None
    api_token: str | None = None
    create_api_token: bool = False
    service_key: str | None = None
    key_header: str = "x-service-key"
    max_prediction_explanations: int = 0
    timeout: float | None = None
    n_samples: int | None = None
    n_concurrent: int = 4
    n_retry: int = 3
    resume: bool | None = None
    compress: bool = False
    ca_bundle: str | None = None
    verify_ssl: bool = True
    keep_cols: str | None = None
    delimiter: str | None = None
    pred_name: str | None = None
    pred_threshold: str | None = None
    pred_decision: str | None = None
    fast: bool = False
    auto_sample: bool = False
    encoding: str | None = None
    skip_dialect: bool = False
    skip_row_id: bool = False
    output_delimiter: str | None = None
    field_size_limit: int | None = None
    yes: bool = False
    no: bool = False
    dry_run: bool = False
    stdout: bool = False
    verbose: bool = False
    single_line: bool = False
    parts: bool = False
    labels: str = "0,1"

    def normalized(self) -> ScoreConfig:
        """Checked and with delimiters resolved; raises ValueError with the reason."""
        self.delimiter, self.output_delimiter = delimiter_of(self.delimiter), delimiter_of(self.output_delimiter)
        for name in ("project_id", "model_id", "deployment_id"):
            value = getattr(self, name)
            if value and not re.match(OBJECT_ID, value):
                raise ValueError(f"{name} {value!r} is no object id")
        if self.api_version not in ("predApi/v1.0", "api/v1"):
            raise ValueError(f"API version {self.api_version!r} is not known")
        if self.max_prediction_explanations and self.api_version == "api/v1":
            raise ValueError("the legacy API gives no explanations")
        if self.n_retry < 1 or self.n_concurrent < 1 or (self.n_samples is not None and self.n_samples < 1):
            raise ValueError("n_retry, n_concurrent and n_samples must be at least 1")
        if self.user:
            self.user = self.user.strip().lower()
        return self

    def keep(self) -> tuple[str, ...]:
        return parse_names(self.keep_cols)

    def manifest(self) -> dict:
        """What must be the same for a run to be resumed."""
        names = ("dataset", "project_id", "model_id", "deployment_id", "import_id", "n_samples", "keep_cols", "skip_row_id", "output_delimiter", "pred_name", "pred_threshold", "pred_decision", "delimiter", "encoding", "fast", "max_prediction_explanations")
        return {n: getattr(self, n) for n in names}


def _typed(name: str, text: str):
    kind = {f.name: str(f.type) for f in fields(ScoreConfig)}[name]
    if "bool" in kind:
        if text.lower() not in ("true", "false", "yes", "no", "1", "0", "on", "off"):
            raise ValueError(f"{name}: {text!r} is neither true nor false")
        return text.lower() in ("true", "yes", "1", "on")
    return float(text) if "float" in kind else int(text) if "int" in kind else text


def read_ini(folders: list[Path] | None = None) -> dict:
    """Options of the first ini file found; unknown names are an error. no_verify_ssl is honoured as verify_ssl's opposite."""
    for folder in folders or [Path.cwd(), Path.home()]:
        if (path := folder / INI).exists():
            parser = configparser.ConfigParser()
            parser.read(path)
            got = dict(parser[SECTION]) if parser.has_section(SECTION) else {}
            if "no_verify_ssl" in got:
                got["verify_ssl"] = "false" if _typed("dry_run", got.pop("no_verify_ssl")) else "true"
            known = {f.name for f in fields(ScoreConfig)}
            if unknown := sorted(set(got) - known):
                raise ValueError(f"{path}: unknown options {unknown}")
            return {k: _typed(k, v) for k, v in got.items()}
    return {}


def parser(ids: tuple[str, ...] = ("project_id", "model_id")) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Score a delimited file in batches and write a table of predictions.", argument_default=argparse.SUPPRESS)
    for name in (*ids, "dataset"):
        p.add_argument(name)
    for f in fields(ScoreConfig):
        if f.name in ("dataset", "project_id", "model_id", "deployment_id", "import_id", "resume", "verify_ssl"):
            continue
        kind = str(f.type)
        if "bool" in kind:
            p.add_argument(*(["-y"] if f.name == "yes" else ["-n"] if f.name == "no" else []), f"--{f.name}", action="store_true")
        else:
            p.add_argument(f"--{f.name}", type=float if "float" in kind else int if "int" in kind else str)
    p.add_argument("--version", action="version", version=__version__)
    p.add_argument("--resume", dest="resume", action="store_true")
    p.add_argument("--no-resume", dest="resume", action="store_false")
    p.add_argument("--no_verify_ssl", dest="verify_ssl", action="store_false")
    return p


def configure(argv: list[str], ids: tuple[str, ...] = ("project_id", "model_id"), folders: list[Path] | None = None) -> ScoreConfig:
    """Command line over ini file over defaults."""
    return ScoreConfig(**{**read_ini(folders), **vars(parser(ids).parse_args(argv))}).normalized()
