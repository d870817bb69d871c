"""Sinks (S operators): every sink writes what it is given into a folder, in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from .commits import append_once


def dual(df: DataFrame, path: str, order: list[Column | str], sample: int = 10) -> None:
    """Parquet, JSON and CSV of a flat table, and the first rows of a total order."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").json(f"{path}/json")
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    df.orderBy(*order).limit(sample).write.mode("overwrite").json(f"{path}/sample")


def by_decision(df: DataFrame, path: str, column: str = "decision", batch: str | None = None) -> None:
    """A folder per decision.  With batch, an append that counts once (see commits)."""
    if batch is None:
        df.write.mode("overwrite").partitionBy(column).parquet(path)
    else:
        append_once(df, path, batch, partition_by=[column])


def audit_log(df: DataFrame, path: str, batch: str | None = None) -> None:
    """One JSON line per row.  With batch, an append that counts once."""
    if batch is None:
        df.write.mode("append").json(path)
    else:
        append_once(df, path, batch, "json")


def append(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Rows added; CSV headers are per file, so readers see one header.  With batch, an append that counts once."""
    if batch is None:
        df.write.mode("append").option("header", True).csv(path)
    else:
        append_once(df, path, batch, "csv", header=True)


def rewrite_distinct(df: DataFrame, path: str, key: list[str], order: list[Column], batch: str | None = None) -> None:
    """The first row of every key, into a new folder; with batch, as a version that counts once."""
    from ..operators.ordering import first_by

    first = first_by(df, key, order)
    if batch is None:
        first.write.mode("errorifexists").parquet(path)
    else:
        append_once(first, path, batch)
