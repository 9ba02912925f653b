"""Ranking metrics (E1-E8) over whole tables of ranked lists.

A ranked list is (query_id, rank, item) with 1-based ranks. Relevance comes
either as explicit pairs (query_id, item) or, for genre relevance, as a
predicate on the pair plus the relevant-set size per query: same-genre
truth sets are quadratic in genre size and are never materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def judged_from_pairs(recs: DataFrame, relevant: DataFrame, qid: str = "query_id",
                      item: str = "item") -> tuple[DataFrame, DataFrame]:
    """(query_id, rank, hit) and (query_id, n_relevant) from explicit sets."""
    rel = relevant.select(qid, item).distinct()
    judged = recs.join(rel.withColumn("_hit", F.lit(1)), [qid, item], "left").select(
        qid, "rank", F.coalesce(F.col("_hit"), F.lit(0)).alias("hit"))
    sizes = rel.groupBy(qid).agg(F.count(F.lit(1)).alias("n_relevant"))
    return judged, sizes


def judged_by_genre(recs: DataFrame, seeds: DataFrame, catalogue: DataFrame,
                    qid: str = "seed_idx", item: str = "track_idx",
                    seed_in_catalogue: bool = True) -> tuple[DataFrame, DataFrame]:
    """Relevant = catalogue tracks of the seed's genre other than the seed.
    hit = genre equality (NULL never equal); size = genre count - self."""
    seed_g = seeds.select(qid, F.col("genre").alias("_sg"))
    item_g = catalogue.select(F.col("track_idx").alias(item), F.col("genre").alias("_ig"))
    judged = recs.join(seed_g, qid).join(item_g, item, "left").select(
        qid, "rank", F.coalesce((F.col("_sg") == F.col("_ig")).cast("int"), F.lit(0)).alias("hit"))
    counts = catalogue.where(F.col("genre").isNotNull()).groupBy("genre").agg(
        F.count(F.lit(1)).alias("_gn"))
    minus = 1 if seed_in_catalogue else 0
    sizes = seeds.select(qid, "genre").join(counts, "genre").select(
        qid, (F.col("_gn") - minus).alias("n_relevant"))
    return judged, sizes


def ideal_dcg(n: F.Column) -> F.Column:
    """sum_{i=1..n} 1/log2(i+1), summed in rank order."""
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0.0),
                       lambda acc, i: acc + F.when(i <= n, 1.0 / F.log2(i + 1)).otherwise(F.lit(0.0)))


def per_query_metrics(queries: DataFrame, judged: DataFrame, sizes: DataFrame,
                      ks=(5, 10, 20), qid: str = "query_id") -> DataFrame:
    """(query_id, k, precision_at_k, recall_at_k, ndcg_at_k) for every query
    of ``queries``; a query without recommendations or relevant items
    scores 0, as in the reference."""
    karr = F.array(*[F.lit(int(k)) for k in ks])
    per = judged.withColumn("k", F.explode(karr)).where(F.col("rank") <= F.col("k")).groupBy(qid, "k").agg(
        F.sum("hit").alias("hits"),
        F.sum(F.when(F.col("hit") == 1, 1.0 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias("dcg"),
        F.count(F.lit(1)).alias("n_recs"))
    base = queries.select(qid).distinct().withColumn("k", F.explode(karr))
    m = base.join(per, [qid, "k"], "left").join(sizes, qid, "left")
    nrel = F.coalesce(F.col("n_relevant"), F.lit(0))
    hits = F.coalesce(F.col("hits"), F.lit(0))
    has = (nrel > 0) & (F.coalesce(F.col("n_recs"), F.lit(0)) > 0)
    idcg = ideal_dcg(F.least(nrel, F.col("k")))
    return m.select(
        qid, "k",
        F.when(has, hits / F.col("k")).otherwise(F.lit(0.0)).alias("precision_at_k"),
        F.when(has, hits / nrel).otherwise(F.lit(0.0)).alias("recall_at_k"),
        F.when(has & (idcg > 0), F.coalesce(F.col("dcg"), F.lit(0.0)) / idcg)
        .otherwise(F.lit(0.0)).alias("ndcg_at_k"))


def evaluate_model(per_query: DataFrame) -> DataFrame:
    """Mean metric per k."""
    return per_query.groupBy("k").agg(
        F.avg("precision_at_k").alias("precision_at_k"), F.avg("recall_at_k").alias("recall_at_k"),
        F.avg("ndcg_at_k").alias("ndcg_at_k"))


def compare_models(results: dict[str, DataFrame]) -> DataFrame:
    """Union of metric tables with a model label."""
    out = None
    for name, df in results.items():
        d = df.withColumn("model", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def coverage(recs: DataFrame, catalogue_size: DataFrame, item: str = "item") -> DataFrame:
    """Distinct recommended items / catalogue size (one row)."""
    d = recs.agg(F.countDistinct(item).alias("recommended")).withColumn("_one", F.lit(1))
    return d.join(F.broadcast(catalogue_size.withColumn("_one", F.lit(1))), "_one").select(  # one row each
        "recommended", "catalogue", (F.col("recommended") / F.col("catalogue")).alias("coverage"))


def diversity(lists: DataFrame, group: str, features: list[str], eps: float = 1e-8) -> DataFrame:
    """E5: mean pairwise cosine distance inside each list, in closed form:
    with normed rows u_i, sum_{i<j} u_i.u_j = (|sum u|^2 - sum |u|^2) / 2, so
    no pair is ever materialised. Lists of < 2 rows or < 2 features -> 0."""
    if len(features) < 2:
        return lists.select(group).distinct().withColumn("diversity", F.lit(0.0))
    nrm = F.sqrt(sum((F.col(c) * F.col(c) for c in features[1:]), F.col(features[0]) * F.col(features[0])))
    u = lists.select(group, *[(F.col(c) / (nrm + F.lit(eps))).alias(c) for c in features])
    sq = sum((F.col(c) * F.col(c) for c in features[1:]), F.col(features[0]) * F.col(features[0]))
    agg = u.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(sq).alias("self_dot"),
                               *[F.sum(c).alias(f"s_{c}") for c in features])
    tot = sum((F.col(f"s_{c}") * F.col(f"s_{c}") for c in features[1:]),
              F.col(f"s_{features[0]}") * F.col(f"s_{features[0]}"))
    pairs = F.col("n") * (F.col("n") - 1) / 2.0
    mean_sim = ((tot - F.col("self_dot")) / 2.0) / pairs
    return agg.select(group, F.col("n").alias("n_items"),
                      F.when(F.col("n") < 2, F.lit(0.0)).otherwise(1.0 - mean_sim).alias("diversity"))


def novelty(lists: DataFrame, group: str) -> DataFrame:
    """Mean -ln(clip(popularity / 100, 0.01, 1)); NULL popularity skipped."""
    p = F.least(F.greatest(F.col("popularity") / 100.0, F.lit(0.01)), F.lit(1.0))
    return lists.groupBy(group).agg(F.avg(-F.log(p)).alias("novelty"))
