"""Exact top-k of queries against items in blocks, pruned by bounds.

Vectors are packed into blocks of bounded size that lie close together (``pack``).
A work unit is a pair of block numbers. Units run in two rounds:

1. *Seeds*: each query block meets a few item blocks that its best items are
   likely to be in. Of this round only every query's k-th score is kept.
2. *All*: the item blocks that can hold a score as good as that, by the caller's
   bound (``windows``), are met, the seeds again.

Units are dealt to tasks by cells: a run of query blocks that meets a run of item
blocks. A cell gets each block it needs once, not once a unit, so the vectors shuffled
are the queries times the runs of items plus the items times the runs of queries, of
which there are about as many. A task holds the items of one cell and reads its query
blocks one by one: it scores a unit as matrix products of slices, keeps a running top k
of each query, and computes the kept scores anew as left-to-right sums, the doubles
that the SQL oracles give. What a query block found in a cell is one row, and the rows
of a query block are merged one by one.

Order: score descending, item key ascending. A query or item with a NULL or NaN
component, or a NULL key, takes no part: such a query has no rows, and such an item is
nobody's neighbour. Zero vectors take part. Keys must be unique on each side.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from cadence.session import cut_lineage, one_thread_a_task, stored

ITEM_BLOCK = 4096
QUERY_BLOCK = 2048
#: Full item blocks of a cell, as a power of two (fewer if their vectors are wide, more if they are small).
RUN_BITS = 7
#: Cells for each core: the fewer, the less often a block is sent.
CELLS_A_CORE = 2
_PART_BITS = 20  # of a block's number, for its place in its partition
_CELL_NUMBERS = 1 << 22  # components of a cell's items
_SLICE_CELLS = 1 << 18  # cells of a product's slice in a task, which stay in its cache
_WAITING = 1 << 18  # found pairs of a query block that wait to be merged into its running top k
_CROWD = 4  # finds a query in a slice, as a multiple of k, beyond which the slice is scored again
_SLACK = 1e-6  # angles of nearly equal vectors are exact to about 1e-8
_TIE = 1e-9  # a matrix product's score may differ by this from the left-to-right sum


@dataclass
class Packed:
    """``blocks``: (block, place, grp, lo, hi, keys, nums, selfs, vecs), each of at most
    ``size`` vectors, with its range of ``at``; ``place`` counts them in order."""

    blocks: DataFrame
    size: int
    n_blocks: int
    n_rows: int

    @property
    def rows(self) -> DataFrame:
        """(num, block, key) of every vector."""
        pairs = self.blocks.select("block", F.explode(F.arrays_zip("keys", "nums")).alias("r"))
        return pairs.select(F.col("r.nums").alias("num"), "block", F.col("r.keys").alias("key"))


def complete(v: Column) -> Column:
    """Whether an array has neither NULL nor NaN components."""
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x))


def _cutter(size: int):
    """The task's function from rows (key, self, v, grp, at), sorted by grp and at, to blocks."""
    bits = _PART_BITS

    def cut(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        part, made, held, waiting, now = TaskContext.get().partitionId(), 0, [], 0, None

        def one(values):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        def block():
            rows = pa.Table.from_batches(held)
            rows = rows.take(pc.sort_indices(rows, [("key", "ascending"), ("at", "ascending")])).combine_chunks()
            key, own, v, _, at = (c.combine_chunks() for c in rows.columns)
            number = part << bits | made
            nums = pa.array(range(number * size, number * size + len(key)), pa.int64())
            low, high = pc.min_max(at).values()
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([now]), pa.array([low.as_py()]), pa.array([high.as_py()]), one(key), one(nums), one(own),
                 one(v.flatten())], names=["block", "grp", "lo", "hi", "keys", "nums", "selfs", "vecs"])

        for batch in batches:
            grp, i = batch.column(3).to_pylist(), 0
            while i < len(grp):
                if waiting and (grp[i] != now or waiting == size):
                    yield block()
                    made, held, waiting = made + 1, [], 0
                now, j = grp[i], i
                while j < len(grp) and grp[j] == now and waiting + j - i < size:
                    j += 1
                held.append(batch.slice(i, j - i))
                waiting, i = waiting + j - i, j
        if waiting:
            yield block()

    return cut


def pack(df: DataFrame, size: int, n: int | None = None) -> Packed:
    """Blocks of ``df`` (key, self, v, grp, at; ``n`` rows), of at most ``size`` vectors of
    one ``grp`` that follow one another by ``at``. They are cut inside the partitions of a
    range partitioning, so a vector is sent once, and stored once."""
    one_thread_a_task(df.sparkSession)
    n = df.count() if n is None else n
    parts = max(1, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), n // (4 * size)))
    kinds = {f.name: f.dataType for f in df.schema}
    schema = StructType([
        StructField("block", LongType()), StructField("grp", LongType()), StructField("lo", DoubleType()), StructField("hi", DoubleType()),
        StructField("keys", ArrayType(kinds["key"])), StructField("nums", ArrayType(LongType())),
        StructField("selfs", ArrayType(kinds["self"])), StructField("vecs", ArrayType(DoubleType()))])
    placed = df.select("key", "self", "v", "grp", "at").repartitionByRange(parts, "grp", "at", "key")
    blocks = stored(placed.sortWithinPartitions("grp", "at", "key").mapInArrow(_cutter(size), schema))
    part = F.shiftright("block", _PART_BITS)
    held = {r["p"]: r for r in blocks.groupBy(part.alias("p")).agg(  # a row a partition
        F.count(F.lit(1)).alias("n"), F.sum(F.size("keys")).alias("rows")).collect()}
    before, total = [], 0
    for p in range(parts):
        before.append(total)
        total += held[p]["n"] if p in held else 0
    place = F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), part.cast("int")) + F.col("block").bitwiseAND((1 << _PART_BITS) - 1)
    return Packed(blocks.withColumn("place", place), size, total, sum(r["rows"] for r in held.values()))


def query_block(n: int, df: DataFrame) -> int:
    """Queries a block: at most QUERY_BLOCK, and enough blocks for all tasks."""
    return min(QUERY_BLOCK, max(128, -(-n // (2 * df.sparkSession.sparkContext.defaultParallelism))))


def _scorer(k: int, dim: int, cosine: bool, eps: float, item_type, kth: bool, sizes: tuple[int, int]):
    """The task's function over the blocks of cells, sorted by cell, items first; ``sizes``
    of query and item blocks. It gives a row a query block and cell: the k-th scores, or the top k.
    Everything it uses is local to it, so that workers need no package."""
    tie, slack, slice_cells, most_waiting = _TIE, _SLACK, _SLICE_CELLS, _WAITING
    q_size, i_size = sizes  # a vector's num is its block's times this, and its place in the block
    crowd = _CROWD * k
    single_tie = 2e-7 * (dim + 8)  # a product of unit vectors in single precision differs by less

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def one(values):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        def exact(a, b):
            total = a[:, 0] * b[:, 0]
            for j in range(1, dim):
                total = total + a[:, j] * b[:, j]
            return total

        def outer(a, b):
            total = a[:, :1] * b[:, 0]
            for j in range(1, dim):
                total += a[:, j:j + 1] * b[:, j]
            return total

        def over(dots, den):
            if not cosine:
                return dots
            if eps:
                return dots / (den + eps)
            return np.where(den == 0, 0.0, dots / np.where(den == 0, 1.0, den))

        def unit(v, norm):
            """Unit vectors in single precision; None if a norm is so large or small
            that products of norms may not be."""
            if not cosine or not ((norm == 0) | ((norm > 1e-100) & (norm < 1e100))).all():
                return None
            return v / np.where(norm == 0, 1, norm)[:, None]

        def single(u):
            return None if u is None else u.astype(np.float32)

        def angle(a, b):
            return np.arccos(np.clip(a @ b, -1, 1))

        def natural(column):
            found = column.to_numpy(zero_copy_only=False)
            return np.array(column.to_pylist(), dtype=str) if found.dtype == object else found

        class Queries:
            def __init__(self, block, row):
                self.v = row["vecs"].to_numpy().reshape(-1, dim)
                self.nums = block * q_size + np.arange(len(self.v))
                self.norm = np.sqrt(exact(self.v, self.v))
                self.exact_unit = unit(self.v, self.norm)
                self.unit = single(self.exact_unit)
                self.selfs = None if row["q_selfs"].null_count == len(self.nums) else row["q_selfs"]
                self.least = np.full(len(self.nums), -np.inf)
                if row["tau_nums"] is not None:
                    self.least[row["tau_nums"].to_numpy() - self.nums[0]] = row["taus"].to_numpy()
                self.rows = np.empty(0, np.int64)
                self.items, self.scores = None, np.empty(0)
                self.waiting, self.found = 0, []

            def add(self, rows, items, scores):
                self.found.append((rows, items, scores))
                self.waiting += len(rows)
                if self.waiting > most_waiting:
                    self.merge()

            def merge(self):
                """Sorts what was found into the running top k, which raises ``least``."""
                if not self.waiting:
                    return
                held = [] if self.items is None else [(self.rows, self.items, self.scores)]
                rows, items, scores = (np.concatenate(parts) for parts in zip(*held, *self.found))
                self.waiting, self.found = 0, []
                order = np.lexsort((items, -scores, rows))
                rows = rows[order]
                place = np.arange(len(rows)) - np.searchsorted(rows, rows)
                order = order[place < k]
                last = rows[place == k - 1]
                self.rows, self.items, self.scores = rows[place < k], items[order], scores[order]
                self.least[last] = np.maximum(self.least[last], self.scores[np.searchsorted(self.rows, last) + k - 1])

            def batch(self, block):
                self.merge()
                if self.items is None or not len(self.rows):
                    return None
                if kth:
                    last = np.flatnonzero(np.bincount(self.rows, minlength=len(self.nums)) == k)
                    if not len(last):
                        return None
                    return pa.RecordBatch.from_arrays([
                        pa.array([block]), one(pa.array(self.nums[last])),
                        one(pa.array(self.scores[np.searchsorted(self.rows, last, "right") - 1]))], names=["qb", "tau_nums", "taus"])
                return pa.RecordBatch.from_arrays([
                    pa.array([block]), one(pa.array(self.rows.astype(np.int32))), one(pa.array(self.items, item_type)),
                    one(pa.array(self.scores))], names=["qb", "rows", "items", "scores"])

        class Items:
            def __init__(self, row):
                self.keys = natural(row["i_keys"])
                self.v = np.array(row["vecs"].to_numpy()).reshape(len(self.keys), dim)
                self.norm = np.sqrt(exact(self.v, self.v))
                units = unit(self.v, self.norm)
                self.unit = single(units)
                # the items lie within ``radius`` of ``centre``
                total = None if units is None else units.sum(axis=0)
                size = 0.0 if total is None else np.sqrt((total * total).sum())
                self.centre = total / size if size > 1e-6 else None
                self.radius = angle(units, self.centre).max() if size > 1e-6 else np.pi

            def reached(self, q):
                """The rows of ``q`` that may have an item here, by the triangle inequality."""
                if self.centre is None or q.exact_unit is None:
                    return np.arange(len(q.nums))
                # beyond 0 a score is at most the cosine, whatever the eps
                known = q.least > 2 * single_tie
                far = np.where(known, np.arccos(np.clip(q.least - tie, -1, 1)) + self.radius + slack, np.inf)
                return np.flatnonzero(angle(q.exact_unit, self.centre) <= far)

        def meet(q, block, gone):
            items, v, norm = block.keys, block.v, block.norm
            own = np.full(len(q.nums), -1)
            if q.selfs is not None:
                known = np.flatnonzero(q.selfs.is_valid().to_numpy(zero_copy_only=False))
                named = natural(q.selfs.take(pa.array(known)))
                place = np.minimum(np.searchsorted(items, named), len(items) - 1)
                own[known] = np.where(items[place] == named, place, -1)
            gone_rows = gone_items = np.empty(0, np.int64)
            if gone is not None:
                gone_rows, gone_items = np.divmod(gone.to_numpy(), i_size)
            rows = block.reached(q)
            place = np.full(len(q.nums), -1)
            place[rows] = np.arange(len(rows))
            gone_at = place[gone_rows]
            gone_at, gone_items = gone_at[gone_at >= 0], gone_items[gone_at >= 0]
            step = max(1, slice_cells // len(items))
            for a in range(0, len(rows), step):
                part = rows[a:a + step]
                here, sharp = (gone_at >= a) & (gone_at < a + step), False
                while True:
                    least, margin, lowest = q.least[part].copy(), tie, -np.finfo(np.float64).max
                    # beyond 0 a score is at most the cosine, whatever the eps
                    coarse = not sharp and q.unit is not None and block.unit is not None and least.min() > 2 * single_tie
                    if coarse:
                        scores, margin, lowest = q.unit[part] @ block.unit.T, single_tie, np.float32(0)
                        least = least.astype(np.float32)
                    else:
                        dots = outer(q.v[part], v) if sharp else q.v[part] @ v.T
                        scores = over(dots, q.norm[part][:, None] * norm[None, :])
                        margin = 0.0 if sharp else tie
                    mine = np.flatnonzero(own[part] >= 0)
                    scores[mine, own[part][mine]] = -np.inf
                    scores[gone_at[here] - a, gone_items[here]] = -np.inf
                    open_rows = np.arange(len(part)) if sharp else np.flatnonzero(~np.isfinite(least))
                    if len(open_rows) and len(items) > k:
                        own_kth = np.partition(scores[open_rows], len(items) - k, axis=1)[:, len(items) - k]
                        least[open_rows] = np.maximum(least[open_rows], own_kth)
                    r, c = np.divmod(np.flatnonzero(scores >= np.maximum(least - margin, lowest)[:, None]), len(items))
                    # where vectors are nearly parallel, the margin lets most pairs through: again as left-to-right sums
                    if sharp or len(r) <= crowd * len(part):
                        break
                    sharp = True
                if sharp:
                    # of equal k-th scores the first k, as the items of a block are sorted
                    found, last = scores[r, c], least[r]
                    level = np.cumsum(found == last)
                    before = np.append(0, level)[np.searchsorted(r, np.arange(len(part)))]
                    kept = (found > last) | (level - before[r] <= k)
                    q.add(part[r[kept]], items[c[kept]], found[kept])
                    continue
                if len(r):
                    r = part[r]
                    q.add(r, items[c], over(exact(q.v[r], v[c]), q.norm[r] * norm[c]))

        now, held = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                cells = {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}
                row = {n: getattr(c, "values", None) for n, c in cells.items()}
                cell, number = (cells["q_run"].as_py(), cells["i_run"].as_py()), cells["block"].as_py()
                if cell != now:
                    now, held = cell, {}
                if row["meets"] is None:
                    held[number] = Items(row)
                    continue
                queries = Queries(number, row)
                for pair in row["meets"]:
                    meet(queries, held[pair["ib"].as_py()], pair["gone"].values)
                    if queries.waiting > len(queries.rows) // 2:
                        queries.merge()  # a query is in one slice of a unit, so not before its end
                if (out := queries.batch(number)) is not None:
                    yield out

    return run


def _cells(units: DataFrame, queries: Packed, items: Packed, taus: DataFrame | None, excluded: DataFrame | None,
           dim: int, few: bool = False) -> DataFrame:
    """The blocks of each cell (q_run, i_run), dealt to tasks, items first; a query
    block names the item blocks it meets there, with the excluded pairs. ``few``: a
    query block has few units."""
    spark = units.sparkSession
    cores = spark.sparkContext.defaultParallelism
    # a task holds a run of items and reads the queries one block at a time, so only the items' run is bounded
    most = max(items.size, min(ITEM_BLOCK << RUN_BITS, _CELL_NUMBERS // dim))
    cells = CELLS_A_CORE * cores
    if few:
        # a run of queries needs few of the items, which make one run
        i_runs, q_runs = 1, max(cells, -(-units.count() * items.size // most))
    else:
        # as many runs of queries as of items, so that neither is sent often
        i_runs = max(-(-items.n_rows // most), min(math.isqrt(cells), items.n_blocks), 1)
        q_runs = -(-cells // i_runs)
    q_runs = max(1, min(q_runs, queries.n_blocks))

    none = F.lit(None).cast("array<bigint>")
    if excluded is not None:
        units = units.join(excluded, ["qb", "ib"], "left")
    else:
        units = units.withColumn("gone", F.lit(None).cast("array<int>"))
    units = (
        units.join(queries.blocks.select(F.col("block").alias("qb"), F.floor(F.col("place") * q_runs / queries.n_blocks).alias("q_run")), "qb")
        # neighbouring item blocks are met by the same queries, so they go to different cells
        .join(items.blocks.select(F.col("block").alias("ib"), (F.col("place") % i_runs).alias("i_run")), "ib"))
    asked = units.groupBy("q_run", "i_run", F.col("qb").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("ib", "gone"))).alias("meets"))  # at most a run of item blocks
    needed = units.select("q_run", "i_run", F.col("ib").alias("block")).distinct()
    q = queries.blocks.select("block", F.col("selfs").alias("q_selfs"), "vecs")
    if taus is not None:
        q = q.join(taus.withColumnRenamed("qb", "block"), "block", "left")
    else:
        q = q.withColumns({"tau_nums": none, "taus": F.lit(None).cast("array<double>")})
    it = items.blocks.select("block", F.col("keys").alias("i_keys"), "vecs")
    # a fixed number of partitions: the blocks are small in bytes, and AQE would merge them into few tasks
    tasks = 2 * max(cores, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return (
        needed.join(it, "block").unionByName(asked.join(q, "block"), allowMissingColumns=True)
        .repartition(tasks, "q_run", "i_run")
        .sortWithinPartitions("q_run", "i_run", F.col("meets").isNotNull(), "block"))


def _score(units: DataFrame, queries: Packed, items: Packed, taus: DataFrame | None, excluded: DataFrame | None,
           k: int, dim: int, cosine: bool, eps: float, kth: bool = False) -> DataFrame:
    """(qb, rows, items, scores): the top k of each query of the block in its units
    (qb, ib), a row a cell; ``kth``: (qb, tau_nums, taus), the k-th scores alone."""
    import pyarrow as pa  # noqa: F401
    from pyspark.sql.pandas.types import to_arrow_type

    item_type = items.blocks.schema["keys"].dataType.elementType
    schema = StructType([StructField("qb", LongType())] + (
        [StructField("tau_nums", ArrayType(LongType())), StructField("taus", ArrayType(DoubleType()))] if kth else
        [StructField("rows", ArrayType(IntegerType())), StructField("items", ArrayType(item_type)),
         StructField("scores", ArrayType(DoubleType()))]))
    return _cells(units, queries, items, taus, excluded, dim, kth).mapInArrow(
        _scorer(k, dim, cosine, eps, to_arrow_type(item_type), kth, (queries.size, items.size)), schema)


def _merger(k: int, item_type, names: list[str]):
    """The task's function over the rows of query blocks, sorted by block: first the
    block's keys, then what it found in each cell."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def natural(column):
            found = column.to_numpy(zero_copy_only=False)
            return np.array(column.to_pylist(), dtype=str) if found.dtype == object else found

        def out():
            if top is None:
                return
            rows, items, scores = top
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(rows)), pa.array(rank.astype(np.int32)), pa.array(items, item_type), pa.array(scores)], names=names)

        keys = top = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: getattr(batch.column(j)[i], "values", None) for j, n in enumerate(batch.schema.names)}
                if row["keys"] is not None:
                    yield from out()
                    keys, top = row["keys"], None
                    continue
                found = row["rows"].to_numpy(), natural(row["items"]), row["scores"].to_numpy()
                if top is not None:
                    found = tuple(np.concatenate(both) for both in zip(top, found))
                rows, items, scores = found
                order = np.lexsort((items, -scores, rows))
                rows = rows[order]
                order = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]
                top = found[0][order], items[order], scores[order]
        yield from out()

    return run


def _excluded(exclude: DataFrame, queries: Packed, items: Packed, query_key: str, item_key: str) -> DataFrame:
    """(qb, ib, gone): excluded pairs by unit, at most a block's square. A pair is one
    number, the query's place in its block times the size of an item block plus the
    item's place; pairs that repeat are dropped here, with no shuffle of their own."""
    pairs = exclude.select(F.col(query_key).alias("_q"), F.col(item_key).alias("_i"))
    q = queries.rows.select(F.col("key").alias("_q"), F.col("num").alias("q_num"))
    it = items.rows.select(F.col("key").alias("_i"), F.col("num").alias("i_num"))
    code = (F.col("q_num") % queries.size * items.size + F.col("i_num") % items.size).cast("int")
    placed = pairs.join(it, "_i").join(q, "_q").select(
        F.expr(f"q_num div {queries.size}").alias("qb"), F.expr(f"i_num div {items.size}").alias("ib"), code.alias("code"))
    return stored(placed.groupBy("qb", "ib").agg(F.collect_set("code").alias("gone")))


def block_topk(queries: Packed, items: Packed, seeds: DataFrame, windows, k: int, dim: int, *, cosine: bool,
               eps: float = 0.0, exclude: DataFrame | None = None, query_key: str, item_key: str) -> DataFrame:
    """(query_key, rank, item_key, similarity). ``seeds``: units (qb, ib) of the
    first round; ``windows(taus)``: units of the second, ``taus`` being (qb,
    tau_nums, taus), the k-th scores known so far."""
    from pyspark.sql.pandas.types import to_arrow_type

    excluded = None if exclude is None else _excluded(exclude, queries, items, query_key, item_key)
    rest = (excluded, k, dim, cosine, eps)
    seeds = cut_lineage(seeds.select("qb", "ib").distinct())
    # in this round a query block is in one cell, so its row is all that it found
    taus = cut_lineage(_score(seeds, queries, items, None, *rest, True))
    units = windows(taus).select("qb", "ib").unionByName(seeds).distinct()
    found = _score(units, queries, items, taus, *rest)
    kinds = [p.blocks.schema["keys"].dataType.elementType for p in (queries, items)]
    schema = StructType([StructField(query_key, kinds[0]), StructField("rank", IntegerType()), StructField(item_key, kinds[1]),
                         StructField("similarity", DoubleType())])
    tasks = max(queries.blocks.sparkSession.sparkContext.defaultParallelism,
                int(queries.blocks.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    asked = queries.blocks.select(F.col("block").alias("qb"), "keys")
    return (
        found.unionByName(asked, allowMissingColumns=True).repartition(tasks, "qb")
        .sortWithinPartitions("qb", F.col("keys").isNull())
        .mapInArrow(_merger(k, to_arrow_type(kinds[1]), schema.names), schema))
