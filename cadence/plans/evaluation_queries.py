"""Evaluation queries: genre baseline, per-query P/R/NDCG, batch evaluation,
model comparison, coverage, diversity, novelty, genre ground truth, the
seeded evaluation sample and the end-to-end offline evaluation."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.config import DEFAULTS, VIBE_FEATURES
from cadence.functions.vectors import cosine_sql
from cadence.operators import baseline, clean, features, knn, metrics
from cadence.plans.feature_queries import _knn_select, catalogue_knn
from cadence.plans.registry import query, tracks, vibe
from cadence.plans.sql import baseline_sql, metrics_sql, with_ctes
from cadence.session import cut_lineage, ensure_checkpoint_dir
from cadence.sources import fixtures as fx
from cadence.sources import sinks

N_EVAL = max(DEFAULTS.k_values)
KS = DEFAULTS.k_values
_METRIC_COLS = ["precision_at_k", "recall_at_k", "ndcg_at_k"]


def _r9(cols):
    return [F.round(c, 9).alias(c) for c in cols]


def _r9s(cols, prefix=""):
    return ", ".join(f"round({prefix}{c}, 9) AS {c}" for c in cols)


# Genre baseline for every track -------------------------------------------------

def baseline_lists(spark, sf, n=DEFAULTS.baseline_n):
    tr = tracks(spark, sf)
    return baseline.genre_baseline(tr, tr.select(F.col("track_idx").alias("seed_idx"), "genre"), n)


query("genre_baseline", with_ctes(baseline_sql(DEFAULTS.baseline_n), "tracks"))(baseline_lists)


# E1-E3 per query: content lists of length 20 judged by genre --------------------------

def content_metrics(spark, sf):
    tr = tracks(spark, sf)
    recs = catalogue_knn(spark, sf, N_EVAL)
    seeds = tr.select(F.col("track_idx").alias("seed_idx"), "genre")
    judged, sizes = metrics.judged_by_genre(recs, seeds, tr)
    return metrics.per_query_metrics(seeds, judged, sizes, KS, qid="seed_idx")


def baseline_metrics(spark, sf):
    tr = tracks(spark, sf)
    recs = baseline_lists(spark, sf, N_EVAL)
    seeds = tr.select(F.col("track_idx").alias("seed_idx"), "genre")
    judged, sizes = metrics.judged_by_genre(recs, seeds, tr)
    return metrics.per_query_metrics(seeds, judged, sizes, KS, qid="seed_idx")


_CONTENT_RECS = _knn_select(N_EVAL, 0.0)
_CONTENT_METRICS = metrics_sql(_CONTENT_RECS, KS)
_BASE_METRICS = metrics_sql(baseline_sql(N_EVAL), KS)

for _m in _METRIC_COLS:
    query(_m, with_ctes(f"SELECT seed_idx, k, round({_m}, 9) AS {_m} FROM ({_CONTENT_METRICS}) m",
                        "vibe", "tracks", "genre_sizes"))(
        (lambda col: lambda spark, sf: content_metrics(spark, sf).select(
            "seed_idx", "k", F.round(col, 9).alias(col)))(_m))

query("evaluate_model", with_ctes(
    f"SELECT k, {_r9s(_METRIC_COLS, 'avg_')} FROM (SELECT k, "
    + ", ".join(f"avg({c}) AS avg_{c}" for c in _METRIC_COLS)
    + f" FROM ({_CONTENT_METRICS}) m GROUP BY k) a", "vibe", "tracks", "genre_sizes"))(
    lambda spark, sf: metrics.evaluate_model(content_metrics(spark, sf)).select(
        "k", *_r9(_METRIC_COLS)))


@query("compare_models", with_ctes(
    " UNION ALL ".join(
        f"SELECT '{name}' AS model, k, {_r9s(_METRIC_COLS, 'avg_')} FROM (SELECT k, "
        + ", ".join(f"avg({c}) AS avg_{c}" for c in _METRIC_COLS)
        + f" FROM ({sql}) m GROUP BY k) a"
        for name, sql in [("content", _CONTENT_METRICS), ("genre_baseline", _BASE_METRICS)]),
    "vibe", "tracks", "genre_sizes"))
def q_compare_models(spark, sf):
    res = metrics.compare_models({
        "content": metrics.evaluate_model(content_metrics(spark, sf)),
        "genre_baseline": metrics.evaluate_model(baseline_metrics(spark, sf))})
    return res.select("model", "k", *_r9(_METRIC_COLS))


# E4-E6 -------------------------------------------------------------------------------

@query("coverage", with_ctes(f"""
SELECT count(DISTINCT r.track_idx) AS recommended, (SELECT count(*) FROM tracks) AS catalogue,
       count(DISTINCT r.track_idx) / (SELECT count(*) FROM tracks) AS coverage
FROM ({_CONTENT_RECS}) r""", "vibe", "tracks"))
def q_coverage(spark, sf):
    recs = catalogue_knn(spark, sf, N_EVAL)
    size = tracks(spark, sf).agg(F.count(F.lit(1)).alias("catalogue"))
    return metrics.coverage(recs, size, item="track_idx")


_DIV_NORM = "sqrt(" + " + ".join(f"v.{c} * v.{c}" for c in VIBE_FEATURES) + ")"
_DIV_U = ", ".join(f"v.{c} / ({_DIV_NORM} + 1e-8) AS {c}" for c in VIBE_FEATURES)
_DIV_DOT = " + ".join(f"a.{c} * b.{c}" for c in VIBE_FEATURES)


@query("diversity", with_ctes(f"""
WITH u AS (SELECT p.seq_id, p.pos, {_DIV_U} FROM playlist_items p JOIN vibe v ON v.track_id = p.track_id),
     n AS (SELECT seq_id, count(*) AS n_items FROM u GROUP BY seq_id)
SELECT n.seq_id, n.n_items,
       CASE WHEN n.n_items < 2 THEN 0e0 ELSE round(coalesce(d.dist, 0e0) / (n.n_items * (n.n_items - 1) / 2e0), 9) END
       AS diversity
FROM n LEFT JOIN (SELECT a.seq_id, sum(1e0 - ({_DIV_DOT})) AS dist
                  FROM u a JOIN u b ON a.seq_id = b.seq_id AND a.pos < b.pos GROUP BY a.seq_id) d
  ON d.seq_id = n.seq_id""".replace("WITH u AS", "SELECT * FROM (WITH u AS", 1) + ") z",
                               "playlist_items", "vibe"))
def q_diversity(spark, sf):
    """E5 per playlist, on normalised vibe vectors, in closed form."""
    lists = fx.playlist_items(spark, sf).join(vibe(spark, sf), "track_id")
    d = metrics.diversity(lists, "seq_id", VIBE_FEATURES)
    return d.select("seq_id", "n_items", F.round("diversity", 9).alias("diversity"))


@query("novelty", with_ctes("""
SELECT p.seq_id, round(avg(-ln(least(greatest(t.popularity / 100e0, 0.01e0), 1e0))), 9) AS novelty
FROM playlist_items p JOIN tracks t ON t.track_id = p.track_id GROUP BY p.seq_id""",
                            "playlist_items", "tracks"))
def q_novelty(spark, sf):
    lists = fx.playlist_items(spark, sf).join(tracks(spark, sf), "track_id")
    return metrics.novelty(lists, "seq_id").select("seq_id", F.round("novelty", 9).alias("novelty"))


# Genre ground truth (sizes, never the pairs) --------------------------------------

@query("genre_ground_truth", with_ctes("SELECT seed_idx, genre, n_relevant FROM genre_sizes",
                                       "genre_sizes"))
def q_genre_ground_truth(spark, sf):
    tr = tracks(spark, sf)
    seeds = tr.select(F.col("track_idx").alias("seed_idx"), "genre")
    _, sizes = metrics.judged_by_genre(tr.limit(0).select(
        F.col("track_idx").alias("seed_idx"), F.lit(0).alias("rank"), "track_idx"), seeds, tr)
    return sizes.join(seeds, "seed_idx").select("seed_idx", "genre", "n_relevant")


# Offline evaluation -------------------------------------------------------------

SAMPLE_KEY = "(track_idx * 2654435761 + {seed}) % 4294967296"


def eval_sample(test, n=DEFAULTS.eval_sample, seed=DEFAULTS.eval_seed):
    """Up to n rows in a seeded hash order that no partitioning changes."""
    key = (F.col("track_idx") * F.lit(2654435761) + F.lit(seed)) % F.lit(4294967296)
    return test.withColumn("_h", key).orderBy("_h", "track_idx").limit(n).drop("_h")


query("eval_sample", with_ctes(f"""
SELECT track_idx, track_id, genre, year FROM tracks WHERE year IN (2022)
ORDER BY {SAMPLE_KEY.format(seed=DEFAULTS.eval_seed)}, track_idx LIMIT {DEFAULTS.eval_sample}""",
                               "tracks"))(
    lambda spark, sf: eval_sample(clean.temporal_split(tracks(spark, sf)).where(F.col("split") == "test"))
    .select("track_idx", "track_id", "genre", "year"))

_TRAIN = "(SELECT * FROM tracks WHERE year NOT IN (2021, 2022) OR year IS NULL)"
_VIBE_TRAIN_STATS = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in VIBE_FEATURES)


def _scaled(alias):
    return ", ".join(
        f"CASE WHEN s.mx_{c} = s.mn_{c} THEN 0e0 ELSE ({alias}.{c} - s.mn_{c}) / (s.mx_{c} - s.mn_{c}) END AS {c}"
        for c in VIBE_FEATURES)


_OFFLINE_SQL = f"""
SELECT model, CAST(k AS INTEGER) AS k, {_r9s(_METRIC_COLS, 'avg_')} FROM (
SELECT model, k, avg(p) AS avg_precision_at_k, avg(r) AS avg_recall_at_k, avg(nd) AS avg_ndcg_at_k FROM (
  SELECT l.model, q.track_idx, kk.k,
         CASE WHEN coalesce(z.n_rel, 0) > 0 AND coalesce(h.n_recs, 0) > 0 THEN coalesce(h.hits, 0) / kk.k ELSE 0e0 END AS p,
         CASE WHEN coalesce(z.n_rel, 0) > 0 AND coalesce(h.n_recs, 0) > 0 THEN coalesce(h.hits, 0) / z.n_rel ELSE 0e0 END AS r,
         CASE WHEN coalesce(z.n_rel, 0) > 0 AND coalesce(h.n_recs, 0) > 0 THEN coalesce(h.dcg, 0e0) /
              list_sum(list_transform(range(1, least(z.n_rel, kk.k) + 1), lambda i: 1e0 / log2(i + 1))) ELSE 0e0 END AS nd
  FROM sample q CROSS JOIN (SELECT unnest([5, 10, 20]) AS k) kk
  CROSS JOIN (SELECT unnest(['content', 'genre_baseline']) AS model) l
  LEFT JOIN (SELECT g.genre, count(*) AS n_rel FROM train g WHERE g.genre IS NOT NULL GROUP BY g.genre) z
    ON z.genre = q.genre
  LEFT JOIN (SELECT x.model, x.seed_idx, k2.k, sum(x.hit) AS hits, count(*) AS n_recs,
                    sum(CASE WHEN x.hit = 1 THEN 1e0 / log2(x.rank + 1) ELSE 0e0 END) AS dcg
             FROM recs x JOIN (SELECT unnest([5, 10, 20]) AS k) k2 ON x.rank <= k2.k
             GROUP BY x.model, x.seed_idx, k2.k) h
    ON h.model = l.model AND h.seed_idx = q.track_idx AND h.k = kk.k) m
GROUP BY model, k) a"""

_OFFLINE_CTES = f"""
WITH sample AS (SELECT * FROM tracks WHERE year IN (2022)
                ORDER BY {SAMPLE_KEY.format(seed=DEFAULTS.eval_seed)}, track_idx LIMIT {DEFAULTS.eval_sample}),
train AS {_TRAIN},
st AS (SELECT {_VIBE_TRAIN_STATS} FROM train),
tv AS (SELECT t.track_idx, t.genre, {_scaled('t')} FROM train t, st s),
qv AS (SELECT q.track_idx, q.genre, {_scaled('q')} FROM sample q, st s),
content AS (
  SELECT seed_idx, rn AS rank, track_idx, hit FROM (
    SELECT q.track_idx AS seed_idx, i.track_idx, CASE WHEN q.genre = i.genre THEN 1 ELSE 0 END AS hit,
           row_number() OVER (PARTITION BY q.track_idx ORDER BY
             {cosine_sql([f"q.{c}" for c in VIBE_FEATURES], [f"i.{c}" for c in VIBE_FEATURES])} DESC,
             i.track_idx) AS rn
    FROM qv q JOIN tv i ON true) c WHERE rn <= {N_EVAL}),
gb AS (
  SELECT seed_idx, rn AS rank, track_idx, hit FROM (
    SELECT s.track_idx AS seed_idx, t.track_idx, CASE WHEN s.genre = t.genre THEN 1 ELSE 0 END AS hit,
           row_number() OVER (PARTITION BY s.track_idx ORDER BY t.popularity DESC NULLS LAST, t.track_idx) AS rn
    FROM sample s
    LEFT JOIN (SELECT genre, count(*) AS n FROM train WHERE genre IS NOT NULL GROUP BY genre) g ON g.genre = s.genre
    JOIN train t ON (CASE WHEN coalesce(g.n, 0) >= {N_EVAL} THEN t.genre = s.genre ELSE true END)) b
  WHERE rn <= {N_EVAL}),
recs AS (SELECT 'content' AS model, * FROM content UNION ALL SELECT 'genre_baseline' AS model, * FROM gb)
"""


@query("offline_eval", with_ctes(
    "SELECT * FROM (" + _OFFLINE_CTES + _OFFLINE_SQL + ") o", "tracks"))
def q_offline_eval(spark, sf):
    """Sampled test tracks as queries (their own vectors, scaled like the
    train catalogue), the train split as catalogue, relevance = same genre in
    train; content KNN against the genre baseline."""
    split = clean.temporal_split(tracks(spark, sf))
    train = split.where(F.col("split") == "train").drop("split")
    sample = eval_sample(split.where(F.col("split") == "test").drop("split"))
    st = train.agg(*[F.min(c).alias(f"mn_{c}") for c in VIBE_FEATURES],
                   *[F.max(c).alias(f"mx_{c}") for c in VIBE_FEATURES]).first()

    def scaled(df):
        cols = []
        for c in VIBE_FEATURES:
            mn, mx = st[f"mn_{c}"], st[f"mx_{c}"]
            cols.append(F.lit(0.0).alias(c) if mx == mn else
                        ((F.col(c) - F.lit(mn)) / F.lit(mx - mn)).alias(c))
        return df.select("track_idx", *cols)

    items = knn.as_vector_frame(scaled(train), "track_idx", VIBE_FEATURES)
    queries = knn.as_vector_frame(scaled(sample).withColumnRenamed("track_idx", "seed_idx"),
                                  "seed_idx", VIBE_FEATURES)
    content = knn.cosine_topk(queries, items, N_EVAL, len(VIBE_FEATURES), query_key="seed_idx",
                              item_key="track_idx")
    seeds = sample.select(F.col("track_idx").alias("seed_idx"), "genre")
    base = baseline.genre_baseline(train, seeds, N_EVAL, seed_in_catalogue=False)
    out = {}
    for name, recs in [("content", content), ("genre_baseline", base)]:
        judged, sizes = metrics.judged_by_genre(recs, seeds, train, seed_in_catalogue=False)
        out[name] = metrics.evaluate_model(
            metrics.per_query_metrics(seeds, judged, sizes, KS, qid="seed_idx"))
    return metrics.compare_models(out).select("model", "k", *_r9(_METRIC_COLS))



@query("evaluation_log", with_ctes(
    "SELECT 'offline ' || model AS run, 'metric' AS kind, u.name, u.value FROM ("
    + _OFFLINE_CTES + _OFFLINE_SQL + ") o, LATERAL (SELECT unnest(["
    + ", ".join(f"'{c}@' || o.k" for c in _METRIC_COLS) + "]) AS name, unnest(["
    + ", ".join(f"o.{c}" for c in _METRIC_COLS) + "]) AS value) u "
    "UNION ALL SELECT 'offline ' || m, 'param', p, NULL FROM (SELECT unnest(['content', 'genre_baseline']) AS m), "
    "(SELECT unnest(['k_values', 'sample']) AS p)", "tracks"))
def q_evaluation_log(spark, sf):
    """A10 on E9: the offline evaluation's metrics and parameters, appended to the
    run log and read back from it."""
    path = f"{ensure_checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    found = cut_lineage(q_offline_eval(spark, sf))
    params = {"k_values": ",".join(map(str, KS)), "sample": DEFAULTS.eval_sample}
    for model in ("content", "genre_baseline"):
        sinks.log_run(spark, path, f"offline {model}", sinks.metrics_to_log(found.where(F.col("model") == model).drop("model")), params)
    return spark.read.parquet(path).select("run", "kind", "name", "value")


del Window, features
