"""Model queries: ALS item factors, recommendations and similar items, PCA
embeddings and variance, ranker features, the learned re-ranker and its
feature importances."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import CATEGORICAL_FEATURES, CONTINUOUS_FEATURES, DEFAULTS, RANKER_FEATURES, VIBE_FEATURES
from cadence.operators import collaborative as cf
from cadence.functions.vectors import cosine_sql, dot_sql
from cadence.operators import candidates, features, interactions as inter, pca, ranker
from cadence.plans.feature_queries import _knn_select, catalogue_knn, history_profile
from cadence.plans.interaction_queries import counts
from cadence.plans.registry import ORACLE, _memo, query, tracks, vibe, vibe_vectors
from cadence.plans.sql import with_ctes
from cadence.session import stored
from cadence.sources import fixtures as fx

ALS_RANK, ALS_ITERS = 16, 5
N_CAND = max(DEFAULTS.k_values)
# candidates that the fitted ranker selects its top baseline_n from
N_RANKED = 5 * DEFAULTS.baseline_n


def als_matrix(spark, sf):
    return _memo("als_matrix", spark, sf, lambda: stored(inter.interaction_matrix(
        counts(spark, sf), DEFAULTS.min_interactions)))


def als_model(spark, sf):
    return _memo("als_model", spark, sf, lambda: cf.fit_als(
        als_matrix(spark, sf), rank=ALS_RANK, iterations=ALS_ITERS))


query("als_item_factors")(lambda spark, sf: cf.item_factors(als_model(spark, sf), als_matrix(spark, sf)))

query("als_recommend")(lambda spark, sf: cf.recommend_for_users(
    als_model(spark, sf), als_matrix(spark, sf), n=DEFAULTS.baseline_n))

query("als_similar_items")(lambda spark, sf: cf.similar_items(
    als_model(spark, sf), als_matrix(spark, sf), n=DEFAULTS.n_neighbors))

# R5 ---------------------------------------------------------------------------------

query("pca_embeddings")(lambda spark, sf: pca.pca_embeddings(
    features.full_feature_matrix(tracks(spark, sf)), DEFAULTS.pca_components))

_LEVELS = {"key": list(range(12)), "mode": [0, 1], "time_signature": [3, 4, 5]}
_COLS = CONTINUOUS_FEATURES + [f"CAST({c} = {v} AS DOUBLE)" for c, vs in _LEVELS.items() for v in vs]
query("pca_variance", with_ctes(
    f"SELECT {len(_COLS)} AS n_features, round(CAST("
    + " + ".join(f"(CASE WHEN var_pop({c}) > 0 THEN 1 ELSE 0 END)" for c in _COLS)
    + " AS DOUBLE), 6) AS total_variance FROM tracks", "tracks"))(
    lambda spark, sf: pca.total_variance(features.full_feature_matrix(tracks(spark, sf))))
_SQUARES = " + ".join(f"CASE WHEN s.sd_{i} = 0 THEN 0e0 ELSE pow(({c} - s.mu_{i}) / s.sd_{i}, 2) END" for i, c in enumerate(_COLS))
_MOMENTS = ", ".join(f"avg({c}) AS mu_{i}, stddev_pop({c}) AS sd_{i}" for i, c in enumerate(_COLS))
query("pca_squared_norms", with_ctes(f"""
SELECT t.track_id, t.track_idx, round({_SQUARES}, 6) AS squared_norm
FROM tracks t, (SELECT {_MOMENTS} FROM tracks) s""", "tracks"))(
    lambda spark, sf: pca.squared_norms(features.full_feature_matrix(tracks(spark, sf))).withColumn(
        "squared_norm", F.round("squared_norm", 6)))

_VARIES = " + ".join(f"CASE WHEN var_pop({c}) > 0 THEN 1 ELSE 0 END" for c in _COLS)
_PAIRS = " + ".join(f"coalesce(pow(nullif(corr({a}, {b}), 'NaN'::DOUBLE), 2), 0e0)"
                    for i, a in enumerate(_COLS) for b in _COLS[:i])
query("pca_eigenvalue_sums", with_ctes(f"""
SELECT {len(_COLS)} AS n_components, round(CAST({_VARIES} AS DOUBLE), 6) AS total,
       round(({_VARIES}) + 2 * ({_PAIRS}), 6) AS squares FROM tracks""", "tracks"))(
    lambda spark, sf: pca.eigenvalue_sums(features.full_feature_matrix(tracks(spark, sf))))
del CATEGORICAL_FEATURES

# P15 / R11 / T6 -------------------------------------------------------------------------


def transitions(spark, sf):
    """Observed consecutive (src -> dst) track pairs of the playlists."""
    p = fx.playlist_items(spark, sf)
    ids = tracks(spark, sf).select("track_id", "track_idx")
    held = p.join(ids, "track_id").where(F.col("seq_id").isNotNull()).select("seq_id", "pos", "track_idx")
    # a track is the source at its place and the target at the place before, of which a sequence has one each
    ends = held.select("seq_id", F.explode(F.array(
        F.struct("pos", F.col("track_idx").alias("src"), F.lit(None).cast("bigint").alias("dst")),
        F.struct((F.col("pos") - 1).alias("pos"), F.lit(None).cast("bigint").alias("src"), F.col("track_idx").alias("dst")))).alias("_e"))
    return ends.groupBy("seq_id", "_e.pos").agg(F.max("_e.src").alias("src"), F.max("_e.dst").alias("dst")).where(
        F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst")


def labelled_features(spark, sf, n_cand=N_CAND):
    cands = catalogue_knn(spark, sf, n_cand).select(
        "seed_idx", "track_idx", F.col("similarity").alias("content_score"))
    cands = ranker.seen_transitions(cands, transitions(spark, sf))
    return ranker.graded_labels(ranker.ranker_features(cands, vibe(spark, sf), tracks(spark, sf)))


_RF = [f for f in RANKER_FEATURES]
_VIBE_R = ["danceability", "energy", "valence", "acousticness", "instrumentalness", "tempo"]
query("ranker_features", with_ctes(f"""
SELECT r.seed_idx, r.track_idx, round(r.similarity, 9) AS content_score, 0e0 AS cf_score,
       {", ".join(f"round(cv.{c}, 9) AS {c}" for c in _VIBE_R)},
       t.popularity / 100e0 AS popularity,
       coalesce(CAST(t.genre = s.genre AS INTEGER), 0) AS genre_match,
       {", ".join(f"round(abs(cv.{c} - sv.{c}), 9) AS {c}_delta" for c in ["energy", "valence", "tempo"])},
       CASE WHEN EXISTS (SELECT 1 FROM playlist_items p JOIN playlist_items q
                           ON q.seq_id = p.seq_id AND q.pos = p.pos + 1
                         WHERE p.track_id = s.track_id AND q.track_id = t.track_id) THEN 2e0
            WHEN t.genre = s.genre THEN 1e0 ELSE 0e0 END AS label
FROM ({_knn_select(N_CAND, 0.0)}) r
JOIN vibe cv ON cv.track_idx = r.track_idx JOIN vibe sv ON sv.track_idx = r.seed_idx
JOIN tracks t ON t.track_idx = r.track_idx JOIN tracks s ON s.track_idx = r.seed_idx""",
    "vibe", "tracks", "playlist_items"))(
    lambda spark, sf: (lambda d: d.select(*[
        F.round(c, 9).alias(c) if t == "double" and c not in ("popularity", "cf_score", "label") else F.col(c)
        for c, t in d.dtypes]))(labelled_features(spark, sf)))


# NDCG of the candidates in content order: the measure itself, checked in SQL
_NDCG_SQL = ORACLE["ranker_features"]
query("ranker_ndcg", f"""
SELECT k, round(avg(CASE WHEN ideal > 0 THEN dcg / ideal ELSE 0e0 END), 9) AS ndcg FROM (
  SELECT k, seed_idx, sum(CASE WHEN r <= k THEN g / log2(r + 1) ELSE 0e0 END) AS dcg,
         sum(CASE WHEN i <= k THEN g / log2(i + 1) ELSE 0e0 END) AS ideal
  FROM (SELECT seed_idx, pow(2e0, label) - 1 AS g,
               row_number() OVER (PARTITION BY seed_idx ORDER BY content_score DESC, track_idx) AS r,
               row_number() OVER (PARTITION BY seed_idx ORDER BY label DESC) AS i FROM ({_NDCG_SQL}) f) p,
       (SELECT unnest([{", ".join(map(str, DEFAULTS.k_values))}]) AS k) ks
  GROUP BY k, seed_idx) q GROUP BY k""")(
    lambda spark, sf: ranker.ndcg(
        labelled_features(spark, sf).withColumn("content_score", F.round("content_score", 9)), ["seed_idx"], "content_score")
    .groupBy("k").agg(F.round(F.avg("ndcg"), 9).alias("ndcg")))


# R2 united with R9 per listener --------------------------------------------------------

def listener_requests(spark, sf):
    """(request_id, user_id, seed_idx): every listener with the most played track of the catalogue.
    Each of its readers reads it several times, so the plays are counted once, as they are for ``heard``."""
    ids = tracks(spark, sf).select("track_id", "track_idx")
    return _memo("listener_requests", spark, sf, lambda: stored(counts(spark, sf).join(ids, "track_id").groupBy("user_id").agg(
        F.min_by("track_idx", F.struct((-F.col("play_count")).alias("p"), F.col("track_id"))).alias("seed_idx")).select(
        F.col("user_id").alias("request_id"), "user_id", "seed_idx")))


def heard(spark, sf):
    return _memo("heard", spark, sf, lambda: stored(fx.interactions_raw(spark, sf).select("user_id", "track_id").distinct().join(
        tracks(spark, sf).select("track_id", "track_idx"), "track_id").select("user_id", "track_idx")))


def als_candidates(spark, sf, requests, n):
    """Hybrid candidates with the factors of the fitted ALS."""
    model, matrix = als_model(spark, sf), als_matrix(spark, sf)
    items = cf.item_factors(model, matrix).select("track_id", F.col("factors").alias("v")).join(
        tracks(spark, sf).select("track_id", "track_idx"), "track_id").select("track_idx", "v")
    return candidates.hybrid_candidates(
        requests, vibe_vectors(vibe(spark, sf)), len(VIBE_FEATURES), cf.user_factors(model, matrix), items, model.rank,
        n, n, heard(spark, sf))


def request_features(spark, sf, requests, n=N_RANKED):
    cands = ranker.seen_transitions(als_candidates(spark, sf, requests, n), transitions(spark, sf))
    return ranker.graded_labels(ranker.ranker_features(cands, vibe(spark, sf), tracks(spark, sf)))


_SAME = [f"s.{c}" for c in VIBE_FEATURES], [f"i.{c}" for c in VIBE_FEATURES]
_LIKE = dot_sql([f"u.{c}" for c in VIBE_FEATURES], [f"i.{c}" for c in VIBE_FEATURES])


@query("hybrid_candidates", with_ctes(f"""
SELECT f.request_id, f.seed_idx, f.track_idx, round({cosine_sql(*_SAME)}, 9) AS content_score,
       round({_LIKE}, 9) AS cf_score
FROM (
  SELECT r.user_id AS request_id, r.seed_idx, k.track_idx FROM req r JOIN ({_knn_select(DEFAULTS.knn_n, 0.0)}) k
    ON k.seed_idx = r.seed_idx
  UNION
  SELECT m.user_id AS request_id, m.seed_idx, m.track_idx FROM (
    SELECT u.user_id, r.seed_idx, i.track_idx,
           row_number() OVER (PARTITION BY u.user_id ORDER BY {_LIKE} DESC, i.track_idx) AS rn
    FROM req r JOIN profile u ON u.user_id = r.user_id JOIN vibe i ON true
    LEFT JOIN hist h ON h.user_id = u.user_id AND h.track_idx = i.track_idx WHERE h.user_id IS NULL) m
  WHERE rn <= {DEFAULTS.knn_n} AND m.track_idx <> m.seed_idx) f
JOIN vibe s ON s.track_idx = f.seed_idx JOIN vibe i ON i.track_idx = f.track_idx
JOIN profile u ON u.user_id = f.request_id""", "req", "profile", "hist", "vibe"))
def q_hybrid_candidates(spark, sf, n=DEFAULTS.knn_n):
    """The fusion with factors that SQL can follow: a listener's mean vibe
    vector as the user's factors, the tracks' vibe vectors as the items'."""
    v = vibe(spark, sf)
    items = v.select("track_idx", F.array(*VIBE_FEATURES).alias("v"))
    plays = heard(spark, sf).join(v, "track_idx")
    users = stored(history_profile(spark, sf, plays).select("user_id", F.array(*VIBE_FEATURES).alias("v")))
    found = candidates.hybrid_candidates(
        listener_requests(spark, sf), vibe_vectors(v), len(VIBE_FEATURES), users, items, len(VIBE_FEATURES), n, n,
        heard(spark, sf))
    return found.select("request_id", "seed_idx", "track_idx", F.round("content_score", 9).alias("content_score"),
                        F.round("cf_score", 9).alias("cf_score"))


def listener_features(spark, sf):
    """``request_features`` of all listeners, which the fit and the ranking read."""
    return _memo("listener_features", spark, sf, lambda: stored(
        request_features(spark, sf, listener_requests(spark, sf))))


def fitted_ranker(spark, sf):
    """(model, rounds), fitted on the candidate lists it ranks, of the requests
    that a hash of the seed does not hold out."""
    return _memo("ranker", spark, sf, lambda: ranker.fit_ranker(
        listener_features(spark, sf)))


def ranker_model(spark, sf):
    return fitted_ranker(spark, sf)[0]


query("hybrid_rank")(lambda spark, sf: ranker.rank(
    ranker_model(spark, sf), listener_features(spark, sf), n=DEFAULTS.baseline_n))

query("ranker_rounds")(lambda spark, sf: fitted_ranker(spark, sf)[1])

query("feature_importance")(lambda spark, sf: ranker.feature_importance(ranker_model(spark, sf)))
del _RF
