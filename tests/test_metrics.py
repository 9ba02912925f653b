"""Ranking metrics: perfect, zero and empty lists; ranges."""

import math

from cadence.operators import metrics as M


def _run(spark, recs, rel, queries):
    r = spark.createDataFrame(recs, "query_id long, rank int, item long")
    t = spark.createDataFrame(rel, "query_id long, item long")
    q = spark.createDataFrame([(x,) for x in queries], "query_id long")
    judged, sizes = M.judged_from_pairs(r, t)
    out = M.per_query_metrics(q, judged, sizes, ks=(2, 5))
    return {(x["query_id"], x["k"]): x for x in out.collect()}


def test_perfect_zero_empty(spark):
    recs = [(1, 1, 10), (1, 2, 11), (2, 1, 20), (2, 2, 21)]
    rel = [(1, 10), (1, 11), (2, 99), (3, 5)]
    m = _run(spark, recs, rel, [1, 2, 3])
    assert m[(1, 2)]["precision_at_k"] == 1.0
    assert m[(1, 2)]["recall_at_k"] == 1.0
    assert math.isclose(m[(1, 2)]["ndcg_at_k"], 1.0)
    assert m[(1, 5)]["precision_at_k"] == 2 / 5
    assert m[(2, 2)]["precision_at_k"] == 0.0 and m[(2, 2)]["ndcg_at_k"] == 0.0
    # a query without recommendations scores 0
    assert m[(3, 2)]["recall_at_k"] == 0.0 and m[(3, 5)]["ndcg_at_k"] == 0.0


def test_ndcg_partial(spark):
    recs = [(1, 1, 7), (1, 2, 10)]
    m = _run(spark, recs, [(1, 10)], [1])
    assert math.isclose(m[(1, 2)]["ndcg_at_k"], (1 / math.log2(3)) / 1.0)
    assert m[(1, 2)]["recall_at_k"] == 1.0


def test_ranges(spark):
    import random
    rnd = random.Random(1)
    recs = [(q, r, rnd.randint(0, 30)) for q in range(20) for r in range(1, 11)]
    recs = list({(q, r): (q, r, i) for q, r, i in recs}.values())
    rel = list({(q, rnd.randint(0, 30)) for q in range(20) for _ in range(8)})
    m = _run(spark, recs, rel, list(range(20)))
    for row in m.values():
        for c in ("precision_at_k", "recall_at_k", "ndcg_at_k"):
            assert 0.0 <= row[c] <= 1.0 + 1e-12
