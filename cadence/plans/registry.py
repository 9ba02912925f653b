"""Query registry and the shared building blocks of the query catalogue.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name] -> str`` (DuckDB
SQL over the base tables). Inputs are whole tables or views Spark derives
from whole tables; no query uses an id subset or a row cap, except where the
limit is the feature (a top-n report).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.config import VIBE_FEATURES
from cadence.operators import clean, features, knn
from cadence.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r9(c: str) -> F.Column:
    return F.round(F.col(c), 9).alias(c)


def r9_sql(c: str, src: str | None = None) -> str:
    e = f"{src}.{c}" if src else c
    return f"round({e}, 9) AS {c}"


# ---------------------------------------------------------------------------
# shared building blocks (Spark side)
# ---------------------------------------------------------------------------

_MEMO: dict = {}


def forget() -> None:
    """Drop the plans and models kept so far."""
    _MEMO.clear()


def _memo(name: str, spark: SparkSession, sf_dir: str, build):
    """Reuse a built plan (not its data) within one session: the one-row
    statistics baked into it are computed once."""
    key = (name, id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned catalogue: source 1 through F1, P4, P5, F2, P3, W1, P6."""
    return _memo("tracks", spark, sf_dir,
                 lambda: clean.build_tracks(fx.tracks_raw(spark, sf_dir)))


def vibe(spark: SparkSession, sf_dir: str, tr: DataFrame | None = None) -> DataFrame:
    if tr is not None:
        return features.vibe_matrix(tr)
    return _memo("vibe", spark, sf_dir, lambda: features.vibe_matrix(tracks(spark, sf_dir)))


def vibe_vectors(v: DataFrame, key: str = "track_idx") -> DataFrame:
    return knn.as_vector_frame(v, key, VIBE_FEATURES)


def sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    a = fx.tracks_raw(spark, sf_dir).withColumnRenamed("artist_raw", "artists")
    return [a, fx.tracks_raw_b(spark, sf_dir)]


def all_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All three sources of the catalogue."""
    return [*sources(spark, sf_dir), fx.tracks_raw_c(spark, sf_dir)]


def union_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.union_sources(sources(spark, sf_dir))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadence.operators import interactions as inter
    return inter.play_counts(fx.interactions_raw(spark, sf_dir))
