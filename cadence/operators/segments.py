"""Scans over ordered groups (row numbers, previous rows, running sums) without a
window over a whole group.

Rows are range-partitioned and sorted by group and order, so a group of any size
spreads over many tasks. Each task numbers the rows of its own part of every group;
a table of the runs at the partitions' edges (two rows a partition at most) gives
what the parts before hold, and is broadcast back: it is bounded by the number of
partitions, whatever the groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators.index import _partitions
from cadence.session import stored


def _numbered(group: list[str], previous: dict[str, str], running: dict[str, str]):
    """The task's function: place in the run, the previous row's values and the
    sums of the rows before in the run."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        before, length, head, row, sums = None, 0, True, 0, dict.fromkeys(running, 0.0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            table = pa.Table.from_batches([batch] if before is None else [before, batch]).combine_chunks()
            lead = table.num_rows - n  # 1 if there is a row before
            new = np.zeros(n, bool)
            new[0] = not lead
            for name in group:
                column = table.column(name).combine_chunks()
                a, b = column.slice(1), column.slice(0, len(column) - 1)
                unequal = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(pc.is_null(a), pc.is_null(b)))
                new[1 - lead:] |= unequal.to_numpy(zero_copy_only=False)
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -length))
            heads = head & (np.cumsum(new) == (0 if row else 1))
            out = {name: batch.column(name) for name in batch.schema.names}
            for target, source in previous.items():
                column = table.column(source).combine_chunks()
                past = column if lead else pa.concat_arrays([pa.nulls(1, column.type), column])
                out[target] = pc.if_else(pa.array(new), pa.nulls(n, column.type), past.slice(0, n))
            for target, source in running.items():
                x = pc.fill_null(batch.column(source).cast(pa.float64()), 0.0).to_numpy()
                total = np.empty(n)
                for a, b in zip([0, *np.flatnonzero(new)], [*np.flatnonzero(new), n]):
                    sums[target] = sums[target] if a == 0 and not new[0] else 0.0
                    steps = np.cumsum(np.append(sums[target], x[a:b]))
                    total[a:b] = steps[:-1]
                    sums[target] = steps[-1]
                out[target] = pa.array(total)
            out |= {"_local": pa.array(at - start, pa.int64()), "_head": pa.array(heads),
                    "_pid": pa.array(np.full(n, pid, np.int64)), "_row": pa.array(row + at, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
            before, length, row = batch.slice(n - 1), int(n - start[-1]), row + n
            head = bool(heads[-1])
    return run


def ordered(df: DataFrame, group: list[str], order: list[str], position: str = "pos",
            previous: dict[str, str] | None = None, running: dict[str, str] | None = None,
            num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``position``, the 0-based place of a row in its group by
    ``order`` (ascending, NULLs first; a total order for reproducible results), and,
    for ``previous`` {new: source}, the values of the row before in the group, for
    ``running`` {new: source} the sum of the rows before (NULLs count nothing)."""
    previous, running = previous or {}, running or {}
    sources = list(dict.fromkeys(previous.values()))
    keys = [*group, *order]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    kinds += [f"`{t}` {df.schema[s].dataType.simpleString()}" for t, s in previous.items()]
    kinds += [f"`{t}` double" for t in running]
    ddl = ", ".join(kinds) + ", _local bigint, _head boolean, _pid bigint, _row bigint"
    placed = stored(
        df.repartitionByRange(_partitions(df, num_partitions), *keys).sortWithinPartitions(*keys)
        .mapInArrow(_numbered(group, previous, running), ddl))
    carried_names = [f"_sum{i}" for i in range(len(running))]
    held = list(dict.fromkeys([*group, *sources]))
    value = [F.coalesce(F.col(f"`{x}`").cast("double"), F.lit(0.0)) for x in running.values()]
    # each partition's last row with what its run holds so far, and the first run where another follows it
    last = F.struct(*[F.col(f"`{c}`") for c in held], (F.col("_local") + 1).alias("_len"), F.col("_head"),
                    *[(F.col(f"`{t}`") + v).alias(c) for t, v, c in zip(running, value, carried_names)])
    tails = placed.groupBy("_pid").agg(F.max_by(last, "_row").alias("_t")).select("_pid", "_t.*")
    heads = placed.where("_head").groupBy("_pid", *group).agg(
        F.count(F.lit(1)).alias("_len"), *[F.sum(v).alias(c) for v, c in zip(value, carried_names)])
    ended = heads.join(tails.where(~F.col("_head")).select("_pid"), "_pid", "left_semi").withColumns(
        {"_head": F.lit(True)} | {s: F.lit(None).cast(df.schema[s].dataType) for s in sources if s not in group})
    edges = tails.unionByName(ended)
    past = Window.partitionBy(*group).orderBy("_pid")
    behind = past.rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        "_pid", "_head", F.sum("_len").over(behind).alias("_carry"),
        *[F.sum(c).over(behind).alias(c) for c in carried_names],
        *[F.lag(s).over(past).alias(f"_past{i}") for i, s in enumerate(sources)]).where(
        F.col("_head") & F.col("_carry").isNotNull()).drop("_head")
    joined = placed.join(F.broadcast(carried), "_pid", "left")

    def gained(own: str, carry: str):
        return F.col(f"`{own}`") + F.when(F.col("_head"), F.coalesce(carry, F.lit(0))).otherwise(F.lit(0))

    edge = F.col("_head") & (F.col("_local") == 0)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns], gained("_local", "_carry").cast("bigint").alias(position),
        *[F.when(edge, F.col(f"_past{sources.index(s)}")).otherwise(F.col(f"`{t}`")).alias(t) for t, s in previous.items()],
        *[gained(t, c).alias(t) for t, c in zip(running, carried_names)])
