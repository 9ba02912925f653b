"""What the driver and a task hold grows with measured rows, not with a plan's guess."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cadence.operators import candidates, ranker, serve
from cadence.operators import collaborative as cf
from cadence.plans import ml_queries
from cadence.session import measured_broadcasts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_side_of_a_join_is_broadcast_by_the_size_of_its_file(spark, sf, tmp_path):
    measured_broadcasts(spark, False)
    spark.range(100_000).write.parquet(f"{tmp_path}/a")
    few = spark.read.parquet(f"{tmp_path}/a").select("id", F.explode(F.sequence(F.lit(0), F.lit(200))).alias("x"))
    joined = spark.range(1000, numPartitions=4).join(few, "id")
    assert "Broadcast" in _plan(joined)  # 20 million rows: what the estimate makes of them
    try:
        E.queries()["hybrid_candidates"](spark, sf)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
        assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "10485760b"
        assert "Broadcast" not in _plan(spark.range(1000, numPartitions=4).join(few, "id"))
    finally:
        measured_broadcasts(spark, False)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    assert "Broadcast" in _plan(spark.range(1000, numPartitions=4).join(few, "id"))


def test_plays_are_joined_once(spark, sf):
    for frame in (ml_queries.heard(spark, sf), ml_queries.listener_requests(spark, sf)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
    found = E.queries()["hybrid_candidates"](spark, sf)
    measured_broadcasts(spark, False)
    assert "lineitem" not in _plan(found)


def test_blocks_of_als_grow_with_the_ratings(spark, monkeypatch):
    assert [cf.als_blocks(n) for n in (0, 1, 80_000_000, 216_000_000, 1 << 40)] == [10, 10, 10, 26, cf.MAX_BLOCKS]
    rnd = random.Random(5)
    cells = {(u, rnd.randrange(60)): float(1 + rnd.randrange(9)) for u in range(200) for _ in range(12)}
    matrix = spark.createDataFrame([(u, i, v) for (u, i), v in cells.items()], "user_idx long, item_idx long, value float")
    assert cf.fit_als(matrix, rank=4, iterations=1)._java_obj.itemFactors().rdd().getNumPartitions() <= 10
    monkeypatch.setattr(cf, "RATINGS_A_BLOCK", 100)
    monkeypatch.setattr(cf, "MAX_BLOCKS", 17)
    seen, als = [], cf.ALS
    monkeypatch.setattr(cf, "ALS", lambda **k: seen.append(als(**k)) or seen[-1])
    model = cf.fit_als(matrix, rank=4, iterations=1)
    assert (seen[0].getNumUserBlocks(), seen[0].getNumItemBlocks()) == (17, 17)
    assert model.itemFactors.count() == 60 and model.userFactors.count() == 200


def test_hybrid_candidates_equal_plain_python(spark):
    rnd = random.Random(8)
    v = {t: [rnd.random() for _ in range(3)] for t in range(60)}
    v[7] = [0.0] * 3
    items = {t: [rnd.uniform(-1, 1) for _ in range(2)] for t in range(5, 60)}  # five tracks without factors
    users = {f"u{i}": [rnd.uniform(-1, 1) for _ in range(2)] for i in range(12)}
    asked = [(f"r{i}", 7 if i == 3 else rnd.randrange(60), f"u{i}") for i in range(14)]  # two users without factors
    heard = [(u, rnd.randrange(5, 60)) for u in users for _ in range(20)]

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    def cosine(a, b):
        size = dot(a, a) ** 0.5 * dot(b, b) ** 0.5
        return dot(a, b) / size if size else 0.0

    want = {}
    for r, seed, u in asked:
        near = sorted((t for t in v if t != seed), key=lambda t: (-cosine(v[seed], v[t]), t))[:4]
        gone = {t for w, t in heard if w == u}
        liked = sorted((t for t in items if t not in gone), key=lambda t: (-dot(users[u], items[t]), t))[:4] if u in users else []
        for t in {*near, *liked} - {seed}:
            want[r, seed, t] = (cosine(v[seed], v[t]), dot(users[u], items[t]) if u in users and t in items else 0.0)
    vectors = spark.createDataFrame([(t, *x) for t, x in v.items()], "track_idx long, v0 double, v1 double, v2 double")
    found = candidates.hybrid_candidates(
        spark.createDataFrame(asked, "request_id string, seed_idx long, user_id string"), vectors, 3,
        spark.createDataFrame(list(users.items()), "user_id string, v array<double>"),
        spark.createDataFrame(list(items.items()), "track_idx long, v array<double>"), 2, 4, 4,
        spark.createDataFrame(heard, "user_id string, track_idx long"))
    got = {(r.request_id, r.seed_idx, r.track_idx): (r.content_score, r.cf_score) for r in found.collect()}
    assert got.keys() == want.keys()
    for k, scores in want.items():
        assert got[k] == pytest.approx(scores, abs=1e-12), k


def test_candidates_are_sent_once_to_each_side(spark, tmp_path):
    """Labels and features of candidates: one shuffle for the pairs seen, one a side."""
    spark.createDataFrame([(i, (i * 7) % 50, 0.5) for i in range(50)], "seed_idx long, track_idx long, content_score double").write.parquet(f"{tmp_path}/c")
    spark.createDataFrame([(i, *[(i * k) % 11 / 10 for k in range(1, 7)]) for i in range(50)], "track_idx long, " + ", ".join(
        f"{c} double" for c in ranker.VIBE_IN_RANKER)).write.parquet(f"{tmp_path}/v")
    spark.createDataFrame([(i, f"g{i % 3}" if i % 5 else None, i) for i in range(50)], "track_idx long, genre string, popularity int").write.parquet(f"{tmp_path}/m")
    spark.createDataFrame([(i, (i * 7) % 50) for i in range(0, 50, 4)] * 2, "src long, dst long").write.parquet(f"{tmp_path}/t")
    c, v, m, t = (spark.read.parquet(f"{tmp_path}/{x}") for x in "cvmt")
    measured_broadcasts(spark)
    try:
        out = ranker.graded_labels(ranker.ranker_features(ranker.seen_transitions(c, t), v, m))
        lines = [x for x in _plan(out).splitlines() if "Exchange" in x and "content_score" in x]
        assert _plan(out).count("SortMergeJoin") == 5 and len(lines) <= 3
        got = {(r.seed_idx, r.track_idx): r for r in out.collect()}
    finally:
        measured_broadcasts(spark, False)
    assert len(got) == 50
    for (s, x), r in got.items():
        same = s % 5 and x % 5 and s % 3 == x % 3
        assert r.label == (2.0 if s % 4 == 0 else 1.0 if same else 0.0) and r.popularity == x / 100
        assert r.energy_delta == pytest.approx(abs(s * 2 % 11 - x * 2 % 11) / 10) and r.cf_score == 0


def test_requests_are_checked_once(spark, sf):
    tr, v = ml_queries.tracks(spark, sf), ml_queries.vibe(spark, sf)
    asked = ml_queries.listener_requests(spark, sf).join(tr.select(F.col("track_idx").alias("seed_idx"), F.col("track_id").alias("seed_track_id")), "seed_idx")
    out = serve.recommend_batch(asked.select("request_id", F.lit("content").alias("mode"), "seed_track_id", "user_id", F.lit(3).alias("n")), tr, v)
    assert "seed_track_id" in out.columns
    assert _plan(out.select("request_id", "mode", "error")).count("Join") <= 1


def test_search_with_few_angles_at_once_equals_all_pairs(spark, monkeypatch):
    from cadence.operators import knn
    assert knn.ITEM_BLOCK <= 1024  # blocks of the search, which lie closer together than those of products
    rnd = random.Random(11)
    v = {i: [rnd.random() for _ in range(3)] for i in range(150)} | {150: [0.0] * 3}
    df = spark.createDataFrame([(i, *x) for i, x in v.items()], "track_idx long, v0 double, v1 double, v2 double")
    monkeypatch.setattr(knn, "ITEM_BLOCK", 16)
    monkeypatch.setattr(knn, "_ANGLES", 30)  # three vectors at a time
    got = {}
    for r in knn.cosine_topk(df.withColumnRenamed("track_idx", "q"), df, 4, 3, query_key="q", self_key="q").orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.track_idx)

    def cosine(a, b):
        size = sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5
        return sum(x * y for x, y in zip(a, b)) / size if size else 0.0

    assert got == {q: sorted((i for i in v if i != q), key=lambda i: (-cosine(v[q], v[i]), i))[:4] for q in v}


def test_successor_lists_are_kept_in_columns(spark):
    from cadence.operators.successors import successor_lists
    model = spark.createDataFrame([(c, i, 1.0 / (i + 2)) for c in range(3) for i in range(100)], "ctx_item long, next_item long, prob double")
    _, lists, _ = successor_lists(model)
    assert "parquet" in _plan(lists)
    got = sorted((r.ctx_item, r.chunk, len(r.codes)) for r in lists.collect())
    assert got == [(c, k, n) for c in range(3) for k, n in ((0, 64), (1, 36))]
