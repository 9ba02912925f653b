"""Feature-matrix and similarity queries: vibe / z-score / one-hot / full
matrices, history profiles, exact cosine top-k over tracks, embeddings and
history profiles, exclusion lists and the display join."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import CONTINUOUS_FEATURES, DEFAULTS, VIBE_FEATURES
from cadence.functions.vectors import cosine_sql
from cadence.operators import features, knn
from cadence.plans.registry import query, r9, r9_sql, tracks, vibe, vibe_vectors
from cadence.plans.sql import with_ctes
from cadence.session import stored
from cadence.sources import fixtures as fx
from cadence.sources.tables import read_table

EMBED_DIM = 64

# P7-P10 ---------------------------------------------------------------------------

query("vibe_matrix", with_ctes(
    "SELECT track_id, track_idx, " + ", ".join(r9_sql(c) for c in VIBE_FEATURES) + " FROM vibe",
    "vibe"))(
    lambda spark, sf: vibe(spark, sf).select("track_id", "track_idx", *[r9(c) for c in VIBE_FEATURES]))

_Z = ", ".join(
    f"CASE WHEN s.sd_{c} = 0 THEN 0e0 ELSE round((t.{c} - s.mu_{c}) / s.sd_{c}, 9) END AS {c}"
    for c in CONTINUOUS_FEATURES)
_ZSTATS = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in CONTINUOUS_FEATURES)
_LEVELS = {"key": list(range(12)), "mode": [0, 1], "time_signature": [3, 4, 5]}
_ONEHOT = ", ".join(f"CAST(t.{c} = {v} AS INTEGER) AS {c}_{v}" for c, vs in _LEVELS.items() for v in vs)

query("zscore_features", with_ctes(
    f"SELECT t.track_id, t.track_idx, {_Z} FROM tracks t, (SELECT {_ZSTATS} FROM tracks) s",
    "tracks"))(
    lambda spark, sf: features.zscore_features(tracks(spark, sf)).select(
        "track_id", "track_idx", *[r9(c) for c in CONTINUOUS_FEATURES]))

query("one_hot_features", with_ctes(
    f"SELECT t.track_id, t.track_idx, {_ONEHOT} FROM tracks t", "tracks"))(
    lambda spark, sf: features.one_hot_features(tracks(spark, sf)))


@query("full_feature_matrix", with_ctes(
    f"SELECT t.track_id, t.track_idx, {_Z}, {_ONEHOT} FROM tracks t, (SELECT {_ZSTATS} FROM tracks) s",
    "tracks"))
def q_full_feature_matrix(spark, sf):
    m = features.full_feature_matrix(tracks(spark, sf))
    return m.select(*[r9(c) if c in CONTINUOUS_FEATURES else F.col(c) for c in m.columns])


# History profile ------------------------------------------------------------------

def history(spark, sf):
    """A user's distinct played tracks joined to their vibe vectors."""
    v = vibe(spark, sf)
    plays = fx.interactions_raw(spark, sf).select("user_id", "track_id").distinct()
    return plays.join(v, "track_id")


def history_profile(spark, sf, h=None):
    """``h``: the history, if it is at hand."""
    h = history(spark, sf) if h is None else h
    return h.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"),
                                    *[F.avg(c).alias(c) for c in VIBE_FEATURES])


query("history_profile", with_ctes(
    "SELECT user_id, n_items, " + ", ".join(r9_sql(c) for c in VIBE_FEATURES) + " FROM profile",
    "profile"))(
    lambda spark, sf: history_profile(spark, sf).select(
        "user_id", "n_items", *[r9(c) for c in VIBE_FEATURES]))


# Exact cosine top-k over the whole catalogue -------------------------------

def _knn_sql(k: int, eps: float, out_col: str = "similarity", exclude_top: int = 0) -> str:
    return with_ctes(_knn_select(k, eps, out_col, exclude_top), "vibe")


def _knn_select(k: int, eps: float, out_col: str = "similarity", exclude_top: int = 0) -> str:
    a = [f"q.{c}" for c in VIBE_FEATURES]
    b = [f"i.{c}" for c in VIBE_FEATURES]
    sim = cosine_sql(a, b, eps)
    inner = f"""
SELECT q.track_idx AS seed_idx, i.track_idx, i.track_id, {sim} AS sim,
       row_number() OVER (PARTITION BY q.track_idx ORDER BY {sim} DESC, i.track_idx) AS rn
FROM vibe q JOIN vibe i ON q.track_idx <> i.track_idx"""
    if exclude_top:
        return f"""
SELECT seed_idx, CAST(row_number() OVER (PARTITION BY seed_idx ORDER BY sim DESC, track_idx)
       AS INTEGER) AS rank, track_idx, track_id, round(sim, 9) AS {out_col}
FROM ({inner}) p WHERE rn > {exclude_top} AND rn <= {exclude_top + k}"""
    return f"""
SELECT seed_idx, CAST(rn AS INTEGER) AS rank, track_idx, track_id, round(sim, 9) AS {out_col}
FROM ({inner}) p WHERE rn <= {k}"""


def catalogue_knn(spark, sf, k, eps=0.0, exclude=None):
    vf = vibe_vectors(vibe(spark, sf))
    q = vf.withColumnRenamed("track_idx", "seed_idx")
    return knn.cosine_topk(q, vf, k, len(VIBE_FEATURES), query_key="seed_idx",
                           item_key="track_idx", self_key="seed_idx", eps=eps,
                           exclude=exclude)


def _with_ids(spark, sf, res, out_col="similarity"):
    ids = vibe(spark, sf).select("track_idx", "track_id")
    return res.join(ids, "track_idx").select(
        "seed_idx", "rank", "track_idx", "track_id", F.round("similarity", 9).alias(out_col))


def content_knn_all(spark, sf, k=DEFAULTS.knn_n):
    """R2: top-k content neighbours of every track, seed excluded."""
    return _with_ids(spark, sf, catalogue_knn(spark, sf, k))


def flagship(spark, sf):
    return content_knn_all(spark, sf)


query("content_knn", _knn_sql(DEFAULTS.knn_n, 0.0))(content_knn_all)

query("song_similarity", _knn_sql(DEFAULTS.n_neighbors, 1e-8))(
    lambda spark, sf: _with_ids(spark, sf, catalogue_knn(spark, sf, DEFAULTS.n_neighbors, eps=1e-8)))


@query("knn_exclude", _knn_sql(DEFAULTS.knn_n, 0.0, exclude_top=5))
def q_knn_exclude(spark, sf, already=5):
    """neighbours after removing an exclusion list (here each seed's
    own top-5, i.e. tracks already in its playlist) before ranking."""
    ex = catalogue_knn(spark, sf, already).select("seed_idx", "track_idx")
    return _with_ids(spark, sf, catalogue_knn(spark, sf, DEFAULTS.knn_n, exclude=ex))


# R1 over the embeddings table -------------------------------------------------------------

def _emb_sql(k: int) -> str:
    a = [f"CAST(q.embedding[{i + 1}] AS DOUBLE)" for i in range(EMBED_DIM)]
    b = [f"CAST(i.embedding[{i + 1}] AS DOUBLE)" for i in range(EMBED_DIM)]
    sim = cosine_sql(a, b, 1e-8)
    return f"""
SELECT query_vec_id, CAST(rn AS INTEGER) AS rank, vec_id, label, round(sim, 9) AS similarity
FROM (SELECT q.vec_id AS query_vec_id, i.vec_id, i.label, {sim} AS sim,
             row_number() OVER (PARTITION BY q.vec_id ORDER BY {sim} DESC, i.vec_id) AS rn
      FROM embeddings q JOIN embeddings i ON q.vec_id <> i.vec_id) p
WHERE rn <= {k}"""


@query("embedding_similarity", _emb_sql(DEFAULTS.n_neighbors))
def q_embedding_similarity(spark, sf, k=DEFAULTS.n_neighbors):
    emb = read_table(spark, sf, "embeddings")
    vf = knn.as_array_frame(emb, "vec_id", "embedding")
    q = vf.withColumnRenamed("vec_id", "query_vec_id")
    res = knn.cosine_topk(q, vf, k, EMBED_DIM, query_key="query_vec_id", item_key="vec_id",
                          self_key="query_vec_id", eps=1e-8)
    return res.join(emb.select("vec_id", "label"), "vec_id").select(
        "query_vec_id", "rank", "vec_id", "label", F.round("similarity", 9).alias("similarity"))


# History KNN ("autoplay") -------------------------------------------------------------

def _history_knn_sql(k: int) -> str:
    a = [f"p.{c}" for c in VIBE_FEATURES]
    b = [f"v.{c}" for c in VIBE_FEATURES]
    sim = cosine_sql(a, b, 0.0)
    return with_ctes(f"""
SELECT user_id, CAST(rn AS INTEGER) AS rank, track_idx, track_id, round(sim, 9) AS similarity
FROM (SELECT p.user_id, v.track_idx, v.track_id, {sim} AS sim,
             row_number() OVER (PARTITION BY p.user_id ORDER BY {sim} DESC, v.track_idx) AS rn
      FROM profile p JOIN vibe v ON true
      LEFT JOIN hist h ON h.user_id = p.user_id AND h.track_idx = v.track_idx
      WHERE h.user_id IS NULL) r
WHERE rn <= {k}""", "profile", "hist", "vibe")


@query("history_knn", _history_knn_sql(DEFAULTS.history_n))
def q_history_knn(spark, sf, k=DEFAULTS.history_n):
    # the plays are joined and their repeats dropped once, and so are the profiles, which the search reads several times
    excl = stored(history(spark, sf).select("user_id", "track_idx"))
    plays = excl.join(vibe(spark, sf), "track_idx")
    prof = stored(knn.as_vector_frame(history_profile(spark, sf, plays), "user_id", VIBE_FEATURES))
    items = vibe_vectors(vibe(spark, sf))
    res = knn.cosine_topk(prof, items, k, len(VIBE_FEATURES), query_key="user_id",
                          item_key="track_idx", exclude=excl)
    return _with_ids_user(spark, sf, res)


def _with_ids_user(spark, sf, res):
    ids = vibe(spark, sf).select("track_idx", "track_id")
    return res.join(ids, "track_idx").select(
        "user_id", "rank", "track_idx", "track_id", F.round("similarity", 9).alias("similarity"))


# Recommendation result joined to display metadata ----------------------------------

@query("playlist_metadata", with_ctes(f"""
SELECT r.seed_idx, r.rank, r.track_idx, r.similarity, t.track_name, t.artist, t.genre
FROM ({_knn_select(DEFAULTS.knn_n, 0.0)}) r LEFT JOIN tracks t ON t.track_idx = r.track_idx""",
                                      "vibe", "tracks"))
def q_playlist_metadata(spark, sf):
    res = content_knn_all(spark, sf)
    meta = tracks(spark, sf).select("track_idx", "track_name", "artist", "genre")
    return res.join(meta, "track_idx", "left").select(
        "seed_idx", "rank", "track_idx", "similarity", "track_name", "artist", "genre")
