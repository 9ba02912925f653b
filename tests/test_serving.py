"""Whole histories and candidate counts of the serving and re-ranking queries."""

from pyspark.sql import functions as F

from cadence.config import DEFAULTS
from cadence.operators import serve
from cadence.plans import ml_queries, serving_queries
from cadence.plans.registry import QUERIES, tracks, vibe


def test_autoplay_uses_the_whole_history(spark, sf):
    heard = serving_queries.history(spark, sf)
    most = heard.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").limit(3)
    assert most.agg(F.min("count")).first()[0] > 20
    req = serving_queries.requests(spark, sf).join(most.select("user_id"), "user_id").withColumn("mode", F.lit("autoplay"))
    out = serve.recommend_batch(req, tracks(spark, sf), vibe(spark, sf), history=heard)
    found = out.select("user_id", F.explode("tracks.track_id").alias("track_id"))
    assert found.count() == 3 * serving_queries.N_REQ
    assert found.join(heard, ["user_id", "track_id"]).count() == 0


def test_hybrid_rank_selects_among_more_candidates(spark, sf, monkeypatch):
    monkeypatch.setattr(ml_queries, "ranker_model", lambda spark, sf: None)
    monkeypatch.setattr(ml_queries.ranker, "rank", lambda model, feats, n: feats.groupBy("seed_idx").count())
    assert QUERIES["hybrid_rank"](spark, sf).agg(F.min("count")).first()[0] > DEFAULTS.baseline_n


def test_autoplay_by_the_next_item_model(spark, sf):
    from cadence.operators import sequences as sq
    tr, v = tracks(spark, sf), vibe(spark, sf)
    ids = [r.track_id for r in tr.orderBy("track_idx").limit(40).collect()]
    model = spark.createDataFrame([(0, 5, .6), (0, 6, .4), (1, 6, .5), (1, 0, .5), (2, 9, 1.0)], "ctx_item long, next_item long, prob double")
    asked = spark.createDataFrame([("a", [ids[1], ids[0]], 3), ("b", [ids[2], "unknown"], 1), ("c", [ids[30]], 2), ("d", None, 2)],
                                  "request_id string, history array<string>, n int").withColumns(
        {"mode": F.lit("autoplay"), "seed_track_id": F.lit(ids[20]), "user_id": F.lit("u")})
    out = serve.recommend_batch(asked, tr, v, sequence_model=model)
    got = {r.request_id: [(t.track_id, round(t.score, 9)) for t in r.tracks] for r in out.collect()}
    w = [1 / 1.8, 0.8 / 1.8]  # of the last item and the one before
    assert got["a"] == [(ids[6], round(w[0] * .4 + w[1] * .5, 9)), (ids[5], round(w[0] * .6, 9))]
    assert got["b"] == [(ids[9], 1.0)]
    plain = serve.recommend_batch(asked.withColumn("mode", F.lit("content")), tr, v)
    content = {r.request_id: [t.track_id for t in r.tracks] for r in plain.collect()}
    assert all([t for t, _ in got[k]] == content[k] for k in "cd")
