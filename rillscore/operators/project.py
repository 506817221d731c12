"""The output projection. Column order: row_id, kept columns, prediction values, explanations, threshold, decision."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillscore.functions.scalar import sort_labels


@dataclass(frozen=True)
class Contract:
    """What a scorer declares, so that the output schema is known when the plan is made."""

    labels: tuple[str, ...]
    numeric_labels: bool = False
    has_threshold: bool = False
    has_explanations: bool = False
    target_type: str = "Binary"

    def sorted_labels(self) -> list[str]:
        return sorted(self.labels, key=float if self.numeric_labels else str)


@dataclass(frozen=True)
class Output:
    """Options of the output table."""

    keep_cols: tuple[str, ...] = ()
    skip_row_id: bool = False
    pred_name: str | None = None
    pred_threshold: str | None = None
    pred_decision: str | None = None
    max_explanations: int = 0
    extra: dict = field(default_factory=dict)


def parse_names(text: str | None) -> tuple[str, ...]:
    """A comma-separated list of column names, stripped."""
    return tuple(x.strip() for x in text.split(",")) if text else ()


def check_keep_cols(keep: tuple[str, ...], columns: list[str]) -> None:
    if missing := sorted(set(keep) - {c.strip() for c in columns}):
        raise ValueError(f'keep_cols "{missing}" not in columns {columns}')


def value_columns(values: Column, contract: Contract, pred_name: str | None = None) -> list[Column]:
    """One column per label in sort order; with a name, the positive class of two labels or the value of the only one."""
    labels = contract.sorted_labels()
    by = sort_labels(values, contract.numeric_labels)
    if pred_name is not None and len(labels) > 2:
        raise ValueError(f"pred_name needs one or two labels, the scorer has {len(labels)}")
    if pred_name is not None:
        return [F.element_at(by, -1)["value"].alias(pred_name)]
    return [F.get(by, F.lit(i))["value"].alias(label) for i, label in enumerate(labels)]


def explanation_columns(explanations: Column, most: int) -> list[Column]:
    """feature and strength of the first `most` explanations in the service's order, padded with empty strings."""
    out = []
    for i in range(most):
        e = F.get(explanations, F.lit(i))
        out += [F.coalesce(e[f].cast("string"), F.lit("")).alias(f"explanation_{i + 1}_{f}") for f in ("feature", "strength")]
    return out


def project(df: DataFrame, contract: Contract, out: Output) -> DataFrame:
    """df has row_id, the source columns, and values / explanations / threshold / prediction as the contract says.

    Of equal names in the output the last one wins.
    """
    check_keep_cols(out.keep_cols, df.columns)
    if out.max_explanations and not contract.has_explanations:
        raise ValueError("the scorer gives no explanations")
    if out.pred_threshold and not contract.has_threshold:
        raise ValueError("the scorer gives no prediction threshold")
    cols = [] if out.skip_row_id else [("row_id", F.col("row_id"))]
    cols += [(c, F.col(c)) for c in out.keep_cols]
    direct = [f"_value_{i}" for i in range(len(contract.labels))]
    if set(direct) <= set(df.columns):
        if out.pred_name is not None and len(direct) > 2:
            raise ValueError(f"pred_name needs one or two labels, the scorer has {len(direct)}")
        named = [F.col(direct[-1])] if out.pred_name is not None else [F.col(c) for c in direct]
    else:
        named = value_columns(F.col("values"), contract, out.pred_name)
    cols += list(zip([out.pred_name] if out.pred_name is not None else contract.sorted_labels(), named, strict=True))
    if out.max_explanations:
        names = [f"explanation_{i + 1}_{f}" for i in range(out.max_explanations) for f in ("feature", "strength")]
        cols += list(zip(names, explanation_columns(F.col("explanations"), out.max_explanations), strict=True))
    if out.pred_threshold:
        cols.append((out.pred_threshold, F.col("threshold")))
    if out.pred_decision:
        cols.append((out.pred_decision, F.col("prediction")))
    return df.select(*[c.alias(n) for n, c in dict(cols).items()])


def project_legacy(df: DataFrame, contract: Contract, out: Output) -> DataFrame:
    """The legacy table: row_id, kept columns, then class probabilities by label (binary) or the prediction (regression).

    Explanations, threshold and decision are no part of it. A regression without a name has a blank header.
    """
    check_keep_cols(out.keep_cols, df.columns)
    cols = [] if out.skip_row_id else [F.col("row_id")]
    cols += [F.col(c) for c in out.keep_cols]
    if contract.target_type == "Binary":
        cols += value_columns(F.col("values"), Contract(contract.labels), out.pred_name)
    elif contract.target_type == "Regression":
        cols.append(F.col("prediction").cast("double").alias(out.pred_name or ""))
    else:
        raise ValueError(f'task "{contract.target_type}" not supported')
    return df.select(*cols)
