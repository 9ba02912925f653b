"""Exact top-k cosine neighbours for a whole table of queries (J6, T1, R1,
R2, R4, R10).

Items are ordered by their nearest pivot (a few items drawn by hash) and by the
angle to it, and cut into blocks. Angles obey the triangle inequality: an item whose
angle to a pivot differs by more than ``phi`` from the query's is further than
``phi`` from the query. Once a query knows k items within ``phi``, only blocks whose
range of angles meets ``[angle - phi, angle + phi]`` are left, and all other pairs
of blocks are skipped (``topk`` does the rest). There is one path for every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.operators.topk import Packed, block_topk, complete, pack, query_block
from cadence.session import one_thread_a_task

#: Vectors with more components are held as an array column.
WIDE = 8
MAX_PIVOTS = 4096
#: Items of a block: the fewer, the closer they lie together, and the fewer pairs are scored.
ITEM_BLOCK = 1024
#: Item blocks that a query block meets first.
SEEDS = 4
_SLACK = 1e-6  # angles of nearly equal vectors are exact to about 1e-8
_ZERO_GROUP = -1
_ANGLES = 1 << 21  # angles to pivots that a task holds at once


def vector_columns(dim: int, prefix: str = "v") -> list[str]:
    return [f"{prefix}{i}" for i in range(dim)] if dim <= WIDE else [prefix]


def as_vector_frame(df: DataFrame, key: str, vec: list[Column] | list[str],
                    extra: list[str] | None = None) -> DataFrame:
    """Project ``df`` to (key, extra..., vector) with DOUBLE components: plain
    columns v0..v{d-1} for narrow vectors, one ARRAY column ``v`` for wide."""
    cols = [F.col(c) if isinstance(c, str) else c for c in vec]
    head = [F.col(key), *[F.col(e) for e in (extra or [])]]
    if len(cols) <= WIDE:
        return df.select(*head, *[c.cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    return df.select(*head, F.array(*[c.cast("double") for c in cols]).alias("v"))


def as_array_frame(df: DataFrame, key: str, array_col: str,
                   extra: list[str] | None = None) -> DataFrame:
    """Project an ARRAY column of a wide vector to (key, extra..., v)."""
    return df.select(F.col(key), *[F.col(e) for e in (extra or [])],
                     F.transform(F.col(array_col), lambda x: x.cast("double")).alias("v"))


def _vectors(df: DataFrame, key: str, dim: int, self_key: str | None = None) -> DataFrame:
    """(key, self, v): the complete vectors of ``df``."""
    v = F.col("v") if dim > WIDE else F.array(*[F.col(c) for c in vector_columns(dim)])
    own = F.col(self_key) if self_key else F.lit(None).cast(df.schema[key].dataType)
    rows = df.select(F.col(key).alias("key"), own.alias("self"), v.cast("array<double>").alias("v"))
    return rows.where(F.col("key").isNotNull() & complete(F.col("v")) & (F.size("v") == dim))


def _zero() -> Column:
    return ~F.exists("v", lambda x: x != 0)


def _pivots(items: DataFrame, n: int, dim: int):
    """Unit vectors of at most MAX_PIVOTS items drawn by hash, on the driver."""
    import numpy as np
    size = min(MAX_PIVOTS, max(1, -(-n // ITEM_BLOCK)))
    drawn = items.where(~_zero()).orderBy(F.xxhash64("key"), "key").limit(size).select("v").collect()
    v = np.array([r["v"] for r in drawn], dtype=np.float64).reshape(len(drawn), dim)
    v = v / np.abs(v).max(axis=1, keepdims=True) if len(drawn) else v
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _angles(pivots):
    """Function to the angles of vectors (rows) to all pivots."""
    def angles(v):
        import numpy as np
        v = v / np.maximum(np.abs(v).max(axis=1, keepdims=True), 1e-300)
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        return np.arccos(np.clip(v / np.where(norm == 0, 1, norm) @ pivots.T, -1, 1))
    return angles


def _grouped(df: DataFrame, pivots, dim: int) -> DataFrame:
    """``df`` with grp, the nearest pivot (zero vectors: a group of their own),
    and at, the angle to it."""
    angles, zero_group, step = _angles(pivots), _ZERO_GROUP, max(1, _ANGLES // max(1, len(pivots)))

    def assign(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            v = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, dim)
            grp, at = np.full(len(v), zero_group), np.zeros(len(v))
            for i in range(0, len(v) if len(pivots) else 0, step):
                part = slice(i, i + step)
                found = angles(v[part])
                live = (v[part] != 0).any(axis=1)
                grp[part] = np.where(live, found.argmin(axis=1), zero_group)
                at[part] = np.where(live, found.min(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(grp, pa.int64()), pa.array(at)],
                                             names=[*batch.schema.names, "grp", "at"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(assign, f"{kinds}, grp bigint, at double")


def _reach(queries: Packed, pivots, dim: int, eps: float, taus: DataFrame | None) -> DataFrame:
    """(qb, grp, low, high): the angles to each pivot at which items can still
    enter the top k of a query of the block; without ``taus`` the block's own
    range at its SEEDS nearest pivots."""
    angles, nearest, slack, zero_group = _angles(pivots), SEEDS, _SLACK, _ZERO_GROUP
    step = max(1, _ANGLES // max(1, len(pivots)))

    def windows(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                qb = batch.column(0)[i].as_py()
                nums = batch.column(1)[i].values.to_numpy()
                v = batch.column(2)[i].values.to_numpy().reshape(len(nums), dim)
                live = (v != 0).any(axis=1)
                first = batch.num_columns == 3

                def spread(phi):
                    """Least and largest angle to each pivot, ``phi`` around each vector."""
                    low, high = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
                    for j in range(0, len(v) if len(pivots) else 0, step):
                        part = slice(j, j + step)
                        found = np.where(live[part, None], angles(v[part]), 0.0)
                        low = np.minimum(low, (found - phi[part, None]).min(axis=0))
                        high = np.maximum(high, (found + phi[part, None]).max(axis=0))
                    return low, high

                if first:
                    low, high = spread(np.zeros(len(v)))
                    grp = np.argsort(low, kind="stable")[:nearest]
                    low, high = low[grp], high[grp]
                    zero = not len(pivots) or not live.all()
                else:
                    tau = np.full(len(nums), -np.inf)
                    if batch.column(3)[i].is_valid:
                        order = np.argsort(nums)
                        at = order[np.searchsorted(nums, batch.column(3)[i].values.to_numpy(), sorter=order)]
                        tau[at] = batch.column(4)[i].values.to_numpy()
                    phi = np.arccos(np.clip(tau, -1, 1)) + slack
                    # an eps pulls negative scores up, so it says nothing about the angle; all scores of a zero query are 0
                    phi = np.where(~live | (np.isneginf(tau)) | ((tau <= 0) & (eps > 0)), np.pi + slack, phi)
                    low, high = spread(phi)
                    grp = np.arange(len(pivots))
                    zero = bool((tau <= 0).any())
                if zero:
                    grp, low, high = np.append(grp, zero_group), np.append(low, 0.0), np.append(high, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([qb] * len(grp), pa.int64()), pa.array(grp, pa.int64()), pa.array(low), pa.array(high)],
                    names=["qb", "grp", "low", "high"])

    blocks = queries.blocks.select(F.col("block").alias("qb"), "nums", "vecs")
    if taus is not None:
        blocks = blocks.join(taus, "qb", "left").select("qb", "nums", "vecs", "tau_nums", "taus")
    return blocks.mapInArrow(windows, "qb bigint, grp bigint, low double, high double")


def cosine_topk(queries: DataFrame, items: DataFrame, k: int, dim: int, *,
                query_key: str = "query_id", item_key: str = "track_idx",
                self_key: str | None = None, exclude: DataFrame | None = None,
                eps: float = 0.0) -> DataFrame:
    """Exact top-``k`` items per query by cosine similarity.

    ``queries``: (query_key, [self_key], vector); ``items``: (item_key, vector), as
    ``as_vector_frame`` gives them. ``self_key`` names the query's own item, which
    is never returned; ``exclude`` holds (query_key, item_key) pairs that do
    not count. Similarity is ``dot / (|a||b| + eps)``; with ``eps = 0`` a zero
    vector scores 0. Order: similarity desc, item_key asc. Queries with NULL or NaN
    components have no rows, such items are no neighbours.
    Returns (query_key, rank, item_key, similarity).
    """
    one_thread_a_task(items.sparkSession)
    it = _vectors(items, item_key, dim)
    q = _vectors(queries, query_key, dim, self_key)
    n, n_queries = it.count(), q.count()
    pivots = _pivots(it, n, dim)
    packed_items = pack(_grouped(it, pivots, dim), ITEM_BLOCK, n)
    packed_queries = pack(_grouped(q, pivots, dim), query_block(n_queries, q), n_queries)
    held = packed_items.blocks.select("grp", F.col("block").alias("ib"), "lo", "hi")
    gap = F.greatest(F.col("lo") - F.col("high"), F.col("low") - F.col("hi"), F.lit(0.0))
    seeds = (
        _reach(packed_queries, pivots, dim, eps, None).join(held, "grp").groupBy("qb", "grp")
        .agg(F.min_by("ib", F.struct(gap, F.col("ib"))).alias("ib")))

    def windows(taus: DataFrame) -> DataFrame:
        meets = (F.col("lo") <= F.col("high")) & (F.col("hi") >= F.col("low"))
        return _reach(packed_queries, pivots, dim, eps, taus).join(held, "grp").where(meets)

    return block_topk(packed_queries, packed_items, seeds, windows, k, dim, cosine=True, eps=eps, exclude=exclude,
                      query_key=query_key, item_key=item_key)
