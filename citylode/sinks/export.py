"""Snapshot exports of the marts and the row-count report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def snapshot_path(root: str, dataset: str, run_date: dt.date) -> str:
    return f"{root.rstrip('/')}/gold_export/{dataset}/run_date={run_date:%Y-%m-%d}"


def export_snapshot(
    df: DataFrame, root: str, dataset: str, run_date: dt.date, single_file: bool = False,
) -> str:
    """Write a dataset's snapshot of a run date as Parquet, replacing an earlier one.

    ``single_file`` is for consumers that insist on it; it makes one task write everything.
    """
    path = snapshot_path(root, dataset, run_date)
    (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(path)
    return path


def export_counted(df: DataFrame, path: str, date_column: str | None) -> tuple[int, dt.date | None]:
    """Write once and return (rows, greatest date), both observed during the write."""
    seen = Observation()
    last = F.max(date_column) if date_column else F.lit(None).cast("date")
    if date_column is None:
        df = df.observe(seen, F.count(F.lit(1)).alias("n"))
    else:
        df = df.observe(seen, F.count(F.lit(1)).alias("n"), last.alias("last"))
    df.write.mode("overwrite").parquet(path)
    return seen.get["n"], seen.get.get("last")


def report_line(counts: dict[str, int]) -> str:
    return " | ".join(f"{dataset}:{n}" for dataset, n in counts.items())
