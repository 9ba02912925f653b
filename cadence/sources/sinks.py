"""Sinks (A8-A10): partitioned parquet tables, model persistence and an
append-only run log. All paths are cluster-shared locations (a warehouse or
the session's checkpoint folder), never machine-local folders."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ROWS_PER_FILE = 5_000_000


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Parquet sink. With ``partition_by`` the folder is split by those
    columns, so readers prune partitions. Rows are rebalanced by the same columns:
    small values share a task, and a value that holds most rows is split over
    several tasks by its size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``);
    no file has more than ``rows_per_file`` rows."""
    w = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df.hint("rebalance")
    writer = w.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_model(model, path: str) -> None:
    """Any Spark ML model or pipeline model, overwriting."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    """``cls`` is the model class (``ALSModel``, ``PCAModel``, ...)."""
    return cls.load(path)


def log_run(spark: SparkSession, path: str, run: str, metrics: dict[str, float],
            params: dict[str, object] | None = None) -> DataFrame:
    """A10: append (run, ts, kind, name, value) rows to a parquet log table
    and return the rows written. One row per parameter and metric."""
    ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(run, ts, "param", k, None, str(v)) for k, v in sorted((params or {}).items())]
    rows += [(run, ts, "metric", k, float(v), None) for k, v in sorted(metrics.items())]
    df = spark.createDataFrame(
        rows, "run string, ts timestamp, kind string, name string, value double, text string")
    df.coalesce(1).write.mode("append").parquet(path)
    return df


def metrics_to_log(metrics: DataFrame, key: str = "k") -> dict[str, float]:
    """Flatten a small metric table (one row per ``key``, bounded: k in
    {5, 10, 20}) into log names like ``precision_at_k@10``."""
    out = {}
    for r in metrics.collect():
        d = r.asDict()
        kv = d.pop(key)
        for name, v in d.items():
            if isinstance(v, (int, float)):
                out[f"{name}@{kv}"] = float(v)
    return out
