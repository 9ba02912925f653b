"""Hybrid candidates (R12, P15): content neighbours of a request's seed, united with
the items of the largest inner product with the user's factors. Both scores are
filled in for every candidate, whichever side found it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.operators.collaborative import max_inner_products
from cadence.operators.knn import cosine_topk


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _doubles(name: str) -> Column:
    return F.transform(name, lambda x: x.cast("double"))


def _arrays(df: DataFrame, key: str) -> DataFrame:
    """(key, v): a frame of ``knn.as_vector_frame`` with its vector as an array."""
    names = [c for c in df.columns if c != key]
    v = F.col("v") if names == ["v"] else F.array(*[F.col(c) for c in names])
    return df.select(key, F.transform(v, lambda x: x.cast("double")).alias("v"))


def hybrid_candidates(requests: DataFrame, vectors: DataFrame, dim: int, user_factors: DataFrame,
                      item_factors: DataFrame, rank: int, n_content: int, n_cf: int,
                      heard: DataFrame | None = None) -> DataFrame:
    """(request_id, seed_idx, track_idx, content_score, cf_score) for ``requests``
    (request_id, seed_idx, user_id). ``vectors`` (track_idx, vector) is the content
    side; ``user_factors`` (user_id, v) and ``item_factors`` (track_idx, v) the
    collaborative one, of which items in ``heard`` (user_id, track_idx) do not count.
    The seed is no candidate; a missing factor or vector scores 0."""
    asked = requests.select("request_id", "seed_idx", "user_id")
    seeds = asked.select("request_id", "seed_idx").join(vectors.withColumnRenamed("track_idx", "seed_idx"), "seed_idx")
    content = cosine_topk(seeds, vectors, n_content, dim, query_key="request_id", item_key="track_idx", self_key="seed_idx")
    users = user_factors.join(asked.select("user_id").distinct(), "user_id", "left_semi")
    gone = None if heard is None else heard.select("user_id", "track_idx").join(
        asked.select("user_id").distinct(), "user_id", "left_semi")
    liked = max_inner_products(users, item_factors, n_cf, rank, query_key="user_id", item_key="track_idx", exclude=gone)
    none = F.lit(None).cast("double")
    found = content.select("request_id", "track_idx", F.col("similarity").alias("_content"), none.alias("_cf")).unionByName(
        asked.join(liked, "user_id").where(~F.col("track_idx").eqNullSafe(F.col("seed_idx"))).select(
            "request_id", "track_idx", none.alias("_content"), F.col("similarity").alias("_cf")))
    v = _arrays(vectors, "track_idx")
    norm = F.sqrt(_dot(F.col("v"), F.col("v")))
    sides = v.select("track_idx", F.col("v").alias("_c"), norm.alias("_cn"))
    # what a score is made of: a row a request, and a row a track
    sought = (
        asked.join(sides.select(F.col("track_idx").alias("seed_idx"), F.col("_c").alias("_s"), F.col("_cn").alias("_sn")), "seed_idx", "left")
        .join(user_factors.select("user_id", F.col("v").alias("_u")), "user_id", "left").drop("user_id"))
    held = sides.join(item_factors.select("track_idx", F.col("v").alias("_i")), "track_idx", "full")
    # pairs go to their requests, then with what their missing score needs to their tracks
    pairs = found.repartition("request_id").groupBy("request_id", "track_idx").agg(
        F.max("_content").alias("_content"), F.max("_cf").alias("_cf")).join(sought, "request_id")
    open_content, open_cf = F.col("_content").isNull(), F.col("_cf").isNull()
    pairs = pairs.select("request_id", "seed_idx", "track_idx", "_content", "_cf", F.when(open_content, F.col("_s")).alias("_s"),
                         F.when(open_content, F.col("_sn")).alias("_sn"), F.when(open_cf, F.col("_u")).alias("_u")).join(held, "track_idx", "left")
    size = F.col("_sn") * F.col("_cn")
    cosine = F.when(size == 0, F.lit(0.0)).otherwise(_dot(F.col("_s"), F.col("_c")) / size)
    product = _dot(_doubles("_u"), _doubles("_i"))
    # the searches give the same left-to-right sums
    return pairs.select("request_id", "seed_idx", "track_idx", F.coalesce("_content", cosine, F.lit(0.0)).alias("content_score"),
                        F.coalesce("_cf", product, F.lit(0.0)).alias("cf_score"))
