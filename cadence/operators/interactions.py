"""Listening interactions: play counts (G1), activity filter (F4, J3), the
long-form user x item matrix with dense codes (R7, J4, G3) and its shape
statistics (G4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.clean import classify_interaction_columns
from cadence.operators.index import distinct_index
from cadence.session import stored


def standardize_interactions(df: DataFrame) -> DataFrame:
    """Rename columns by substring rules; a missing count column is 1."""
    mapping = classify_interaction_columns(df.columns)
    out = df.select(*[F.col(f"`{src}`").alias(tgt) for src, tgt in mapping.items()])
    if "play_count" not in out.columns:
        out = out.withColumn("play_count", F.lit(1).cast("bigint"))
    return out


def play_counts(events: DataFrame) -> DataFrame:
    """Sum plays per (user, track); NULL keys are dropped and an all-NULL sum
    is 0. Partial aggregation runs map-side, so a hot user or track is
    pre-reduced before the shuffle."""
    return (events.where(F.col("user_id").isNotNull() & F.col("track_id").isNotNull())
            .groupBy("user_id", "track_id")
            .agg(F.coalesce(F.sum("play_count"), F.lit(0)).cast("bigint").alias("play_count")))


def active_users(counts: DataFrame, min_plays: int = 5) -> DataFrame:
    return (counts.groupBy("user_id").agg(F.sum("play_count").cast("bigint").alias("total_plays"))
            .where(F.col("total_plays") >= min_plays))


def interaction_matrix(counts: DataFrame, min_plays: int = 5) -> DataFrame:
    """Long-form matrix of active users: (user_idx, item_idx, user_id,
    track_id, value FLOAT); codes follow sorted id order."""
    counts = stored(counts)  # read for the active users and for their cells
    users = distinct_index(active_users(counts, min_plays), "user_id", "user_idx")
    cells = stored(counts.join(users, "user_id").groupBy("user_id", "user_idx", "track_id")
                   .agg(F.sum("play_count").alias("v")))  # read for the items and for the matrix
    items = distinct_index(cells, "track_id", "item_idx")
    return cells.join(items, "track_id").select(
        "user_idx", "item_idx", "user_id", "track_id", F.col("v").cast("float").alias("value"))


def interaction_density(matrix: DataFrame) -> DataFrame:
    return matrix.agg(
        F.countDistinct("user_idx").alias("n_users"), F.countDistinct("item_idx").alias("n_items"),
        F.count(F.lit(1)).alias("nnz")).select(
        "n_users", "n_items", "nnz",
        F.round(F.col("nnz") / (F.col("n_users") * F.col("n_items")), 9).alias("density"))
