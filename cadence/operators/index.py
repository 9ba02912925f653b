"""Dense 0-based index in a total order (W1, G3, P21) without an
unpartitioned window.

The rows are range-partitioned on the ordering key and sorted inside each
partition; ``monotonically_increasing_id`` then carries (partition id, local
position). A tiny per-partition count table gives every partition its offset.
Only that table — one row per partition — is ever windowed without keys, and
it is broadcast back: its size is bounded by the partition count.

The tagged rows are written once to the checkpoint folder, in compressed
columns, before they are read twice (counts, positions): range bounds come from sampling the input,
and an input produced by a shuffle arrives in a different order on every
read, so without the checkpoint the two reads could disagree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.session import stored

_LOCAL_BITS = 33


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def dense_index(df: DataFrame, order_cols: list[str | Column], name: str = "idx",
                num_partitions: int | None = None, start: int = 0) -> DataFrame:
    """Add ``name`` = position of the row in ``order_cols`` order (which must be
    a total order for a reproducible result), starting at ``start``."""
    cols = list(df.columns)
    n = _partitions(df, num_partitions)
    tagged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .drop("_mid")
    )
    tagged = stored(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return tagged.join(F.broadcast(offsets), "_pid").select(
        *cols, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("bigint").alias(name))


def distinct_index(df: DataFrame, key: str, name: str, start: int = 0,
                   num_partitions: int | None = None) -> DataFrame:
    """Distinct values of ``key`` with dense codes in sorted order (NULL dropped)."""
    return dense_index(df.select(key).where(F.col(key).isNotNull()).distinct(), [key], name,
                       num_partitions=num_partitions, start=start)
