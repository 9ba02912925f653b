"""Exact cosine top-k against all pairs, scored as left-to-right sums: own item,
exclusion lists, ties, NULL, NaN and zero vectors, many blocks."""

import math
import random

import pytest

from pyspark.sql import functions as F

from cadence.operators import knn, topk


def _score(a, b, eps):
    def dot(x, y):
        total = x[0] * y[0]
        for p, q in zip(x[1:], y[1:]):
            total = total + p * q
        return total
    den = math.sqrt(dot(a, a)) * math.sqrt(dot(b, b))
    return dot(a, b) / (den + eps) if eps else 0.0 if den == 0 else dot(a, b) / den


def _brute(queries, items, k, eps=0.0, own=None, gone=frozenset()):
    def usable(v):
        return all(x is not None and x == x for x in v)
    out = {}
    for q, v in queries.items():
        if usable(v):
            found = sorted((-_score(v, w, eps), i) for i, w in items.items()
                           if usable(w) and (own or {}).get(q) != i and (q, i) not in gone)[:k]
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return {q: r for q, r in out.items() if r}


def _frame(spark, key, vectors, dim, kind="long", own=None):
    schema = f"{key} {kind}, " + (", ".join(f"v{d} double" for d in range(dim)) if dim <= knn.WIDE else "v array<double>")
    rows = [(i, *(v if dim <= knn.WIDE else [list(v)])) for i, v in vectors.items()]
    if own is None:
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame([(*r, own.get(r[0])) for r in rows], f"{schema}, own {kind}")


def _got(res, query_key="query_id", item_key="track_idx"):
    out = {}
    for r in res.orderBy(query_key, "rank").collect():
        out.setdefault(r[query_key], []).append((r["rank"], r[item_key], r["similarity"]))
    return out


def _vectors(n, dim, seed, signed=False):
    rnd = random.Random(seed)
    out = {i: tuple(rnd.random() - (0.5 if signed else 0) for _ in range(dim)) for i in range(n)}
    for i in range(0, n, 9):
        out[i] = out[1]  # equal vectors
    for i in range(3, n, 31):
        out[i] = (0.0,) * dim
    for i in range(5, n, 25):  # 8 of 200
        out[i] = (None, *out[i][1:])
    out[7] = (float("nan"), *out[7][1:])
    out[11] = tuple(2 * x for x in out[12])
    return out


@pytest.fixture(params=[False, True], ids=["one block", "many blocks"])
def blocks(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(knn, "ITEM_BLOCK", 16)
        monkeypatch.setattr(topk, "QUERY_BLOCK", 24)
        monkeypatch.setattr(topk, "RUN_BITS", 1)


@pytest.mark.parametrize("dim, eps, signed", [(6, 0.0, False), (4, 1e-8, True), (3, 0.0, True), (12, 1e-8, False)])
def test_catalogue_against_itself(spark, blocks, dim, eps, signed):
    v = _vectors(200, dim, dim, signed)
    it, own = _frame(spark, "track_idx", v, dim), {i: i for i in v}
    q = it.withColumnRenamed("track_idx", "query_id")
    for k in (5, 10):
        res = knn.cosine_topk(q, it, k, dim, self_key="query_id", eps=eps)
        assert _got(res) == _brute(v, v, k, eps, own)


def test_exclusions_strings_and_partial_self(spark, blocks):
    dim, k = 5, 6
    items = {f"t{i:03}": v for i, v in _vectors(150, dim, 1).items()}
    queries = {f"q{i}": v for i, v in _vectors(40, dim, 2).items()}
    own = {f"q{i}": f"t{i:03}" if i % 3 else None for i in range(40)} | {"q4": "not an item"}
    gone = {(q, i) for n, q in enumerate(queries) for i in list(items)[:: n % 5 + 2]}
    gone |= {("q2", i) for i in list(items)[:148]}  # almost all
    ex = spark.createDataFrame(sorted(gone) * 2, "query_id string, track_idx string")
    res = knn.cosine_topk(_frame(spark, "query_id", queries, dim, "string", own), _frame(spark, "track_idx", items, dim, "string"),
                          k, dim, self_key="own", exclude=ex)
    assert _got(res) == _brute(queries, items, k, 0.0, own, gone)


def test_far_blocks_are_skipped(spark, monkeypatch):
    """Clusters far apart: the second round meets only a part of all units."""
    monkeypatch.setattr(knn, "ITEM_BLOCK", 64)
    rnd = random.Random(4)
    centres = [tuple(rnd.gauss(0, 1) for _ in range(6)) for _ in range(12)]
    v = {i: tuple(x + rnd.gauss(0, .02) for x in centres[i % 12]) for i in range(1500)}
    met, whole, score = [], set(), topk._score

    def counted(units, queries, items, *rest):
        met.append(units.count())
        whole.add(queries.blocks.count() * items.blocks.count())
        return score(units, queries, items, *rest)

    monkeypatch.setattr(topk, "_score", counted)
    it = _frame(spark, "track_idx", v, 6)
    res = knn.cosine_topk(it.withColumnRenamed("track_idx", "query_id"), it, 5, 6, self_key="query_id")
    some = {i: v[i] for i in range(0, 1500, 50)}
    got = _got(res)
    assert {i: got[i] for i in some} == _brute(some, v, 5, 0.0, {i: i for i in v})
    (units,) = whole
    assert sum(met) < units / 3


def test_a_cell_gets_each_block_once(spark, monkeypatch):
    """If every block meets every block, blocks are copied once a cell, not once a unit."""
    monkeypatch.setattr(topk, "RUN_BITS", 3)
    v = {i: (1.0 + i, 2.0) for i in range(16 * 24 * 16)}
    rows = _frame(spark, "key", v, 2).selectExpr("key", "key AS self", "array(v0, v1) AS v", "key % 5 AS grp", "double(key) AS at")
    items, queries = topk.pack(rows, 24), topk.pack(rows, 16)
    units = queries.blocks.selectExpr("block AS qb").crossJoin(items.blocks.selectExpr("block AS ib"))
    cells = topk._cells(units, queries, items, None, None, 2)
    met = cells.selectExpr("q_run", "i_run", "block", "meets IS NULL AS item", "coalesce(size(meets), 0) AS n").collect()
    assert sum(r["n"] for r in met) == units.count()
    assert len({(r["q_run"], r["i_run"], r["block"], r["item"]) for r in met}) == len(met) < units.count() / 3


def test_item_blocks_are_not_sent_more_often_as_queries_grow(spark):
    """A run of query blocks has no bound, so an item block's copies depend on the cores alone."""
    v = {i: (1.0 + i, 2.0) for i in range(16 * 24 * 16)}
    rows = _frame(spark, "key", v, 2).selectExpr("key", "key AS self", "array(v0, v1) AS v", "0L AS grp", "double(key) AS at")
    items, queries = topk.pack(rows, 24), topk.pack(rows, 4)
    units = queries.blocks.selectExpr("block AS qb").crossJoin(items.blocks.selectExpr("block AS ib"))
    cells = topk._cells(units, queries, items, None, None, 2)
    copies = cells.where("meets IS NULL").groupBy("block").count().agg({"count": "max"}).first()[0]
    assert copies <= topk.CELLS_A_CORE * spark.sparkContext.defaultParallelism < 1536 / 16


def test_no_items_no_queries(spark):
    it = _frame(spark, "track_idx", {1: (1.0, 2.0), 2: (None, 1.0)}, 2)
    q = it.withColumnRenamed("track_idx", "query_id")
    assert knn.cosine_topk(q, it.limit(0), 3, 2).count() == 0
    assert knn.cosine_topk(q.limit(0), it, 3, 2).count() == 0
    zeros = _frame(spark, "track_idx", {i: (0.0, 0.0) for i in range(9)}, 2)
    assert _got(knn.cosine_topk(zeros.withColumnRenamed("track_idx", "query_id"), zeros, 3, 2, self_key="query_id")) == \
        _brute({i: (0.0, 0.0) for i in range(9)}, {i: (0.0, 0.0) for i in range(9)}, 3, 0.0, {i: i for i in range(9)})


def test_neither_side_is_sent_to_all_cells(spark):
    """Where all items would fit into one run, queries and items are still cut into about as many runs."""
    v = {i: (1.0 + i, 2.0) for i in range(16 * 24 * 16)}
    rows = _frame(spark, "key", v, 2).selectExpr("key", "key AS self", "array(v0, v1) AS v", "0L AS grp", "double(key) AS at")
    items, queries = topk.pack(rows, 24), topk.pack(rows, 16)
    units = queries.blocks.selectExpr("block AS qb").crossJoin(items.blocks.selectExpr("block AS ib"))
    sent = topk._cells(units, queries, items, None, None, 2).groupBy("block", F.col("meets").isNull().alias("item")).count().collect()
    cells = topk.CELLS_A_CORE * spark.sparkContext.defaultParallelism
    runs = math.isqrt(cells)
    assert {r["count"] for r in sent if r["item"]} == {-(-cells // runs)}
    assert {r["count"] for r in sent if not r["item"]} == {runs}


def test_blocks_hold_every_vector_once(spark):
    """Blocks are of one group, of bounded size, neighbours by ``at``, and counted in order."""
    rows = _frame(spark, "key", {i: (float(i), 2.0) for i in range(5000)}, 2).selectExpr(
        "key", "key AS self", "array(v0, v1) AS v", "key % 3 - 1 AS grp", "double(key % 100) AS at")
    packed = topk.pack(rows, 64)
    blocks = packed.blocks.orderBy("place").collect()
    assert [b["place"] for b in blocks] == list(range(len(blocks))) and packed.n_blocks == len(blocks)
    assert sorted(k for b in blocks for k in b["keys"]) == list(range(5000)) and packed.n_rows == 5000
    last = (-2, 0.0)
    for b in blocks:
        assert 0 < len(b["keys"]) <= 64 and b["keys"] == sorted(b["keys"]) == b["selfs"]
        assert {k % 3 - 1 for k in b["keys"]} == {b["grp"]}
        assert (min(k % 100 for k in b["keys"]), max(k % 100 for k in b["keys"])) == (b["lo"], b["hi"])
        assert b["vecs"] == [x for k in b["keys"] for x in (float(k), 2.0)]
        assert (b["grp"], b["lo"]) >= last
        last = b["grp"], b["hi"]
    assert {(r["num"], r["block"], r["key"]) for r in packed.rows.collect()} == {
        (b["block"] * 64 + i, b["block"], k) for b in blocks for i, k in enumerate(b["keys"])}


def test_excluded_pairs_are_one_number_each(spark):
    """Repeated pairs are sent as one small number, which a task takes apart again."""
    rows = [(i, i % 7, [1.0, float(i)], 0, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "key long, self long, v array<double>, grp long, at double")
    queries, items = topk.pack(df, 16), topk.pack(df, 8)
    pairs = [(q, i) for q in range(0, 40, 3) for i in range(0, 40, 5)]
    gone = topk._excluded(spark.createDataFrame(pairs * 3 + [(None, 1), (1, None), (99, 0)], "q long, i long"), queries, items, "q", "i")
    assert gone.schema["gone"].dataType.simpleString() == "array<int>"
    q_num = {r["num"]: r["key"] for r in queries.rows.collect()}
    i_num = {r["num"]: r["key"] for r in items.rows.collect()}
    got = sorted((q_num[r["qb"] * 16 + code // 8], i_num[r["ib"] * 8 + code % 8]) for r in gone.collect() for code in r["gone"])
    assert got == pairs


def test_history_is_read_once(spark, sf, monkeypatch):
    """The plays are joined to the catalogue once, though profiles and exclusions both need them."""
    from cadence.plans import feature_queries
    reads, read = [], feature_queries.fx.interactions_raw
    monkeypatch.setattr(feature_queries.fx, "interactions_raw", lambda *a: reads.append(a) or read(*a))
    plan = feature_queries.q_history_knn(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert len(reads) == 1 and "lineitem" not in plan


def test_tasks_multiply_with_one_thread(spark):
    """Each core has a task, so more threads in one of them wait for the others'."""
    df = spark.createDataFrame([(i, None, [1.0, float(i)], 0, float(i)) for i in range(40)],
                               "key long, self long, v array<double>, grp long, at double")
    topk.pack(df, 16)

    def threads(batches):
        import os

        import pyarrow as pa
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.environ.get("OPENBLAS_NUM_THREADS", "all")])], names=["n"])

    assert {r["n"] for r in df.mapInArrow(threads, "n string").collect()} == {"1"}


def test_nearly_parallel_vectors_are_not_all_verified(spark):
    """Cosines that differ by less than the margins are told apart by slices, before
    pairs are verified one by one; of equal ones the first stay."""
    import sys

    import numpy as np
    import pyarrow as pa
    dim, n, k = 16, 1500, 5
    rnd = np.random.default_rng(3)
    v = 1.0 + 1e-7 * rnd.normal(size=(n, dim))
    v[1:n:3] = 1.0  # equal vectors
    none, nothing = pa.array([None], pa.list_(pa.int64())), pa.array([None], pa.list_(pa.float64()))
    meets = pa.list_(pa.struct([("ib", pa.int64()), ("gone", pa.list_(pa.int32()))]))

    def block(number, rows, units):
        keys = pa.array([list(range(number * 500, number * 500 + 500))], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([0]), pa.array([0]), pa.array([number]), none if units else keys, keys if units else none, pa.array([rows.ravel()]),
             pa.array([units], meets), none, nothing],
            names=["q_run", "i_run", "block", "i_keys", "q_selfs", "vecs", "meets", "tau_nums", "taus"])

    blocks = [block(b, v[b * 500:b * 500 + 500], None) for b in range(3)]
    blocks.append(block(0, v[:500], [{"ib": b, "gone": None} for b in range(3)]))
    verified = []
    sys.setprofile(lambda frame, event, _: event == "call" and frame.f_code.co_name == "exact" and verified.append(len(frame.f_locals["a"])))
    try:
        found, = topk._scorer(k, dim, True, 0.0, pa.int64(), False, (500, 500))(iter(blocks))
    finally:
        sys.setprofile(None)
    def total(a, b):  # left to right
        out = a[:, :1] * b[:, 0]
        for j in range(1, dim):
            out = out + a[:, j:j + 1] * b[:, j]
        return out

    norm = np.sqrt((total(v, v)).diagonal())
    cosine = total(v[:500], v) / (norm[:500, None] * norm[None, :])
    cosine[np.arange(500), np.arange(500)] = -1
    want = np.argsort(-cosine, axis=1, kind="stable")[:, :k]
    assert (np.array(found["items"][0].values).reshape(500, k) == want).all()
    assert sum(verified) < 4 * 500 * 3 * k  # 3 blocks
