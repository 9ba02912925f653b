"""PCA, re-ranker, sequence embeddings, sinks and responses against plain Python."""

import collections
import glob
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.operators import baseline, pca, ranker, serve
from cadence.operators import sequences as sq
from cadence.plans import serving_queries
from cadence.plans.registry import QUERIES, tracks, vibe
from cadence.sources import sinks


def test_pca_equals_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5))
    df = spark.createDataFrame([(i, *map(float, r), 2.0) for i, r in enumerate(x)], "track_idx long, a double, b double, "
                               "c double, d double, e double, same double").repartition(6)
    z = np.c_[(x - x.mean(0)) / x.std(0), np.zeros(400)]
    values, vectors = np.linalg.eigh(z.T @ z / 400)
    order = np.argsort(-values)
    vectors = vectors[:, order] * np.sign(vectors[np.abs(vectors).argmax(0), range(6)])[order]
    got = pca.pca_embeddings(df, 3).orderBy("track_idx").collect()
    assert np.allclose([r.embedding for r in got], z @ vectors[:, :3], atol=1e-8)
    ratios = [r.explained_variance_ratio for r in pca.explained_variance(df, 3).orderBy("component").collect()]
    assert np.allclose(ratios, values[order][:3] / 5)


def test_skipgram_pairs_of_cut_sequences(spark):
    rnd = random.Random(3)
    seqs = {s: [f"i{rnd.randint(0, 30)}" for _ in range(n)] for s, n in enumerate([1, 2, 9, 10, 11, 20, 137])}
    df = spark.createDataFrame([(s, p, i) for s, items in seqs.items() for p, i in enumerate(items)],
                               "seq_id int, pos long, track_id string").repartition(4)
    want = collections.Counter((items[q], items[p]) for items in seqs.values() for p in range(len(items))
                               for q in range(max(0, p - 4), p))
    for chunk in (5, 10, 1000):
        assert {(r.a, r.b): r.n for r in sq.skipgram_pairs(df, 4, chunk).collect()} == dict(want)


def test_items_of_one_playlist_are_near(spark):
    rnd = random.Random(4)
    rows = [(s, p, f"{'ab'[s % 2]}{rnd.randint(0, 19)}") for s in range(120) for p in range(12)]
    _, vectors = sq.item_embeddings(spark.createDataFrame(rows, "seq_id int, pos long, track_id string"), dim=4, window=3)
    v = {r.track_id: np.array(r.embedding) / np.linalg.norm(r.embedding) for r in vectors.collect()}
    assert len(v) == 40
    for item, x in v.items():
        near = sorted((o for o in v if o != item), key=lambda o: -float(v[o] @ x))[:10]
        assert sum(o[0] == item[0] for o in near) >= 8


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(9)
    rows = []
    for seed in range(80):
        for t in range(15):
            content, popular = rnd.random(), rnd.random()
            rows.append((f"r{seed}", seed, t, content, None if t == 3 else popular, float(2 if content > .8 else content > .5)))
    return spark.createDataFrame(rows, "request_id string, seed_idx long, track_idx long, content_score double, "
                                       "popularity double, label double")


def test_ranker_rounds_and_storage(spark, labelled, tmp_path):
    model, rounds = ranker.fit_ranker(labelled, ["popularity", "content_score"], max_iter=6, step=0.3, patience=2)
    found = {(r["round"], r["k"]): r["ndcg"] for r in rounds.collect()}
    assert set(found) == {(n, k) for n in range(1, 7) for k in (5, 10, 20)}
    (chosen,) = {r["round"] for r in rounds.where("chosen").collect()}
    assert len(model.stages[-1].trees) == chosen
    held = labelled.where(ranker._held_out(0.2, 42))
    assert 0 < held.select("seed_idx").distinct().count() < 40
    last = ranker.round_ndcg(model, held).where(F.col("round") == chosen).orderBy("k").collect()
    scored = model.transform(held)
    direct = ranker.ndcg(scored, ["request_id"], "prediction").groupBy("k").agg(F.avg("ndcg").alias("ndcg"))
    assert [r["ndcg"] for r in last] == pytest.approx([r["ndcg"] for r in direct.orderBy("k").collect()], abs=1e-12)
    sinks.save_model(model, str(tmp_path / "ranker"))
    from pyspark.ml import PipelineModel
    back = sinks.load_model(PipelineModel, str(tmp_path / "ranker"))
    assert ranker.fitted_features(back) == ["popularity", "content_score"]
    assert ranker.rank(back, labelled, 5).collect() == ranker.rank(model, labelled, 5).collect()
    assert [r.feature for r in ranker.feature_importance(back).collect()][0] == "content_score"


def test_ndcg_by_hand(spark):
    rows = [("q", 1, 0.9, 0.0), ("q", 2, 0.8, 2.0), ("q", 3, 0.7, 1.0), ("none", 1, 0.5, 0.0)]
    df = spark.createDataFrame(rows, "request_id string, track_idx int, score double, label double")
    got = {(r.request_id, r.k): r.ndcg for r in ranker.ndcg(df, ["request_id"], "score", (1, 5)).collect()}
    dcg, ideal = 3 / np.log2(3) + 1 / 2, 3 + 1 / np.log2(3)
    assert got == {("q", 1): 0.0, ("q", 5): pytest.approx(dcg / ideal), ("none", 1): 0.0, ("none", 5): 0.0}


def test_hot_split_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(120_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(
        F.col("id") % 100 < 97, F.lit("train")).when(F.col("id") % 100 < 99, F.lit("val")).otherwise(F.lit("test")).alias("split"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.write_table(df, str(tmp_path / "t"), partition_by=["split"], rows_per_file=50_000)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = {s: glob.glob(f"{tmp_path}/t/split={s}/*.parquet") for s in ("train", "val", "test")}
    tasks = {os.path.basename(f).split("-")[1] for f in files["train"]}
    assert len(tasks) > 3 and len(files["val"]) <= 2 and len(files["test"]) <= 2
    assert max(spark.read.parquet(f).count() for f in files["train"]) <= 50_000
    assert spark.read.parquet(str(tmp_path / "t")).count() == 120_000


def test_all_request_errors_occur(spark, sf):
    errors = {r.error for r in QUERIES["request_errors"](spark, sf).select("error").distinct().collect()}
    assert len(errors) == 6 and None in errors


def test_response_fields(spark, sf):
    req = serving_queries.requests(spark, sf).withColumn("mode", F.lit("content")).limit(3)
    bare = tracks(spark, sf).drop("artist").withColumn("popularity", F.lit(float("nan")))
    rows = serve.recommend_batch(req, bare, vibe(spark, sf)).select(F.explode("tracks").alias("t")).select("t.*").collect()
    assert list(serve.RESPONSE_FIELDS) == [c for c in rows[0].asDict() if c not in ("rank", "score")]
    for r in rows:
        assert r.artist is None and r.popularity is None and r.track_name is not None
        assert r.similarity == r.score and r.hybrid_score is None and r.transition_score is None


def test_baseline_fills_missing_columns(spark):
    cat = spark.createDataFrame([(i, f"T{i}") for i in range(6)], "track_idx long, track_id string")
    seeds = spark.createDataFrame([(0, "unknown"), (9, "other")], "seed_idx long, genre string")
    got = baseline.genre_baseline(cat, seeds, 3).orderBy("seed_idx", "rank").collect()
    assert [(r.seed_idx, r.track_idx, r.popularity, r.baseline_score) for r in got] == [
        (0, 1, 50, 0.5), (0, 2, 50, 0.5), (0, 3, 50, 0.5), (9, 0, 50, 0.5), (9, 1, 50, 0.5), (9, 2, 50, 0.5)]
