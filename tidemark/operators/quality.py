"""Named expectations: rows failing any rule are dropped and counted per rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _passed(rules: Mapping[str, str]) -> dict[str, Column]:
    return {n: F.coalesce(F.expr(rule), F.lit(False)) for n, rule in rules.items()}


def expectation_counts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: rows checked and rows that fail it."""
    failures = [F.count_if(~ok).alias(n) for n, ok in _passed(rules).items()]
    counted = df.agg(F.count(F.lit(1)).alias("rows_checked"), *failures)
    return counted.unpivot("rows_checked", list(rules), "rule", "failures")


def expect_all_or_drop(
    df: DataFrame, rules: Mapping[str, str], report: Observation | str | None = None
) -> DataFrame:
    """Keep rows for which every rule (a SQL predicate) is true; null counts as false.

    ``report`` collects ``rows`` and one failure count per rule in the same pass:
    an ``Observation`` in a batch, a metric name on a stream. A task that runs
    again after a lost executor may count its rows again.
    """
    passed = _passed(rules)
    if report is not None:
        failures = [F.count_if(~ok).alias(name) for name, ok in passed.items()]
        df = df.observe(report, F.count(F.lit(1)).alias("rows"), *failures)
    keep = F.lit(True)
    for ok in passed.values():
        keep = keep & ok
    return df.filter(keep)
