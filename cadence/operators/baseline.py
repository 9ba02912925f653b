"""Genre-popularity baseline.

For every seed: the most popular tracks of its genre; when the genre has
fewer than n other tracks, the pool is every other track (same and other
genres re-sorted together, as the reference does). ``padding="after"`` keeps
same-genre tracks first instead.

No seed is ever joined to the catalogue: the top n+1 tracks per genre and
overall are ranked once (a partial WindowGroupLimit per genre, so a genre
holding a third of the catalogue is cut down map-side), and seeds join to
those short lists; dropping the seed itself leaves at least n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, part: list[str], n: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(F.col("popularity").desc_nulls_last(), F.col("track_idx"))
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n + 1)


def genre_baseline(catalogue: DataFrame, seeds: DataFrame, n: int = 20,
                   padding: str = "as_written", seed_in_catalogue: bool = True) -> DataFrame:
    """seeds: (seed_idx, genre). catalogue: (track_idx, track_id, genre,
    popularity). Returns (seed_idx, rank, track_idx, track_id, popularity,
    baseline_score)."""
    if "popularity" not in catalogue.columns:
        catalogue = catalogue.withColumn("popularity", F.lit(50))
    if "genre" not in catalogue.columns:
        catalogue = catalogue.withColumn("genre", F.lit("unknown"))
    cat = catalogue.select("track_idx", "track_id", "genre", "popularity")
    counts = cat.where(F.col("genre").isNotNull()).groupBy("genre").agg(F.count(F.lit(1)).alias("_gn"))
    self_n = 1 if seed_in_catalogue else 0
    s = seeds.select("seed_idx", "genre").join(counts, "genre", "left")
    s = s.withColumn("_same", F.coalesce(F.col("_gn"), F.lit(0)) - self_n >= n)
    top_genre = _ranked(cat.where(F.col("genre").isNotNull()), ["genre"], n)
    same = s.where("_same").select("seed_idx", "genre").join(top_genre, "genre")
    same = same.select("seed_idx", "track_idx", "track_id", "popularity", F.lit(0).alias("_tier"))
    rest = s.where(~F.col("_same"))
    # A genre short of n tracks has at most n of them, so the top 2n+2
    # overall always hold n others after removing the seed and its genre:
    # 2n+2 rows, carried by every such seed as one literal array.
    best = cat.orderBy(F.col("popularity").desc_nulls_last(), F.col("track_idx")).limit(2 * n + 2).collect()
    kind = "array<struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in cat.schema) + ">>"

    def overall(size: int) -> DataFrame:
        rows = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in cat.columns]) for r in best[:size]]).cast(kind)
        return rest.select("seed_idx", F.col("genre").alias("_sg"), F.explode(rows).alias("t")).select(
            "seed_idx", "_sg", "t.*")

    if padding == "after":
        first = rest.where(F.col("genre").isNotNull()).select("seed_idx", "genre") \
            .join(top_genre, "genre") \
            .select("seed_idx", "track_idx", "track_id", "popularity", F.lit(0).alias("_tier"))
        second = overall(2 * n + 2) \
            .where(~F.coalesce(F.col("genre") == F.col("_sg"), F.lit(False))) \
            .select("seed_idx", "track_idx", "track_id", "popularity", F.lit(1).alias("_tier"))
        pool = same.unionByName(first).unionByName(second)
    else:
        pool = same.unionByName(overall(n + 1).select(
            "seed_idx", "track_idx", "track_id", "popularity", F.lit(0).alias("_tier")))
    pool = pool.where(F.col("seed_idx") != F.col("track_idx"))
    w = Window.partitionBy("seed_idx").orderBy(
        F.col("_tier"), F.col("popularity").desc_nulls_last(), F.col("track_idx"))
    out = pool.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return out.select("seed_idx", F.col("rank").cast("int").alias("rank"), "track_idx", "track_id",
                      "popularity", (F.col("popularity") / 100.0).alias("baseline_score"))
