"""Constraint checks as one-row frames: check, severity, failures. A report is their union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateloom.functions.text import clean
from crateloom.operators.frames import union_all


def _row(df: DataFrame, name: str, severity: str) -> DataFrame:
    return df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures")


def duplicates(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Keys that stand in more than one row."""
    return _row(df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), name, "error")


def dangling(df: DataFrame, field: str, parents: DataFrame, parent_key: str, name: str, blank_ok: bool = True) -> DataFrame:
    """References without parent; a blank one counts only where ``blank_ok`` is false."""
    known = parents.select(clean(F.col(parent_key)).alias("_k")).where("_k <> ''").distinct()
    refs = df.withColumn("_k", clean(F.col(field)))
    refs = refs.where("_k <> ''") if blank_ok else refs
    return _row(refs.join(known, "_k", "left_anti"), name, "error")


def blanks(df: DataFrame, field: str, name: str) -> DataFrame:
    return _row(df.where(clean(F.col(field)) == ""), name, "warning")


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the number of rows and of filled cells, from one pass."""
    counts = df.agg(F.count("*").alias("n_rows"), *[F.count_if(clean(F.col(c).cast("string")) != "").alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_filled")) for c in columns])
    return counts.select("n_rows", F.explode(pairs).alias("x")).select("x.column_name", "n_rows", "x.n_filled")


def report(*checks: DataFrame) -> DataFrame:
    """All checks, with the verdict of each."""
    verdict = F.when(F.col("failures") == 0, "passed").when(F.col("severity") == "warning", "passed_with_warnings").otherwise("failed")
    return union_all(checks).withColumn("verdict", verdict)


def gate(df: DataFrame, failures: DataFrame, message: str) -> DataFrame:
    """``df``, which fails when it is computed if ``failures`` has a row."""
    bad = failures.limit(1).agg(F.count("*").alias("_bad"))
    stop = F.when(F.col("_bad") > 0, F.raise_error(F.lit(message))).otherwise(F.lit(True))
    return df.join(F.broadcast(bad.select(stop.alias("_ok")))).where("_ok").drop("_ok")
