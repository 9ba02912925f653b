"""A Bloom filter over 64-bit row hashes, built by Spark and broadcast.

The filter has ``bits_per_row`` bits a row, but ``max_bits`` at most, so the
broadcast bitmap has a proven bound (32 MiB) whatever the input. A fuller filter
only lets more rows through to the exact step behind it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm.common import slices

SEGMENTS = 64
LEAST_BITS = 1 << 16
TASK_POSITIONS = 1 << 21
SLICE_ITEMS = 1 << 17
HASHES = 4
MAX_BITS = 1 << 28


def filter_bits(n_rows: int, bits_per_row: int = 16, max_bits: int = MAX_BITS) -> int:
    """Size of the filter: a power of two."""
    wanted = max(LEAST_BITS, n_rows * bits_per_row)
    return min(max_bits, 1 << (wanted - 1).bit_length())


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, HASHES) filter positions; each hash owns one part of the filter,
    so the positions of one row are distinct."""
    part = np.uint64(bits // HASHES)
    out = np.empty((len(hashes), HASHES), np.int64)
    h = hashes.astype(np.uint64)
    for j in range(HASHES):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        out[:, j] = ((h >> np.uint64(17)) % part + np.uint64(j) * part).astype(np.int64)
    return out


def position_bitmap(hashes: DataFrame, bits: int, least: int = 1) -> np.ndarray:
    """The positions that at least ``least`` (1 or 2) rows of ``hashes`` (one
    column of 64-bit hashes) set, as packed bytes.

    Each task sends, for each of 64 segments, the positions it saw once and more
    than once; a second stage merges them segment by segment. The driver
    receives ``bits / 8`` bytes at most."""
    size = bits // SEGMENTS
    part_schema = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("repeated", pa.binary())])

    def summary(parts: list[np.ndarray]) -> pa.RecordBatch:
        at, n = np.unique(np.concatenate(parts), return_counts=True)
        segment = at // size
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        cut = np.append(first, len(at))
        low = (at % size).astype("<u4")
        once, more = [], []
        for a, b in zip(cut[:-1], cut[1:]):
            many = n[a:b] > 1
            once.append(low[a:b][~many].tobytes())
            more.append(low[a:b][many].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(segment[first], pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
            schema=part_schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts.append(positions(batch.column(0).to_numpy(zero_copy_only=False), bits).ravel())
            held += len(parts[-1])
            if held >= TASK_POSITIONS:
                yield summary(parts)
                parts, held = [], 0
        if parts:
            yield summary(parts)

    merged_schema = pa.schema([("segment", pa.int32()), ("bitmap", pa.binary())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count = None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([np.packbits(count >= least).tobytes()], pa.binary())],
                schema=merged_schema)

        for batch in batches:
            for i, segment in enumerate(batch.column(0).to_pylist()):
                once, more = batch.column(1)[i].as_buffer(), batch.column(2)[i].as_buffer()  # views, no copies
                if segment != now:
                    if now is not None:
                        yield done()
                    now, count = segment, np.zeros(size, np.uint8)
                at = np.frombuffer(once, "<u4")
                count[at] = np.minimum(count[at] + 1, 2)
                count[np.frombuffer(more, "<u4")] = 2
        if now is not None:
            yield done()

    segments = (
        hashes.mapInArrow(partial, "segment int, once binary, repeated binary")
        .repartition("segment").sortWithinPartitions("segment")
        .mapInArrow(merge, "segment int, bitmap binary"))
    bitmap = np.zeros((SEGMENTS, size // 8), np.uint8)
    for row in segments.toLocalIterator():
        bitmap[row.segment] = np.frombuffer(row.bitmap, np.uint8)
    return bitmap.ravel()


def is_set(bitmap: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Whether all positions of each 64-bit hash are set."""
    pos = positions(hashes, bits)
    return (bitmap[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8) & 1).astype(bool).all(axis=1)


def membership(spark: SparkSession, bitmap: np.ndarray, bits: int):
    """Column function over a 64-bit hash: whether all its positions are set."""
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def test(row_hash: pd.Series) -> pd.Series:
        return pd.Series(is_set(shared.value, bits, row_hash.to_numpy()))

    return test


def shared_items(sets: DataFrame) -> DataFrame:
    """(vid, common): for each set (vid, items array<long>, stored) an upper
    bound, nearly always exact, of how many of its items another set holds."""
    spark = sets.sparkSession
    total = sets.agg(F.sum(F.size("items"))).first()[0] or 0
    bits = filter_bits(total)
    shared = spark.sparkContext.broadcast(
        position_bitmap(sets.select(F.explode("items").alias("item")), bits, least=2))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, SLICE_ITEMS)):
            lists = batch.column(1)
            pos = positions(lists.flatten().to_numpy(zero_copy_only=False), bits)
            hit = (shared.value[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8) & 1).all(axis=1)
            before = np.append(0, np.cumsum(hit))
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(before[at[1:]] - before[at[:-1]], pa.int64())],
                                             names=["vid", "common"])

    return sets.select("vid", "items").mapInArrow(count, "vid long, common long")


def maybe_in(keys: DataFrame):
    """Column function: whether a 64-bit hash may be among ``keys`` (one column,
    stored). Never false for one that is."""
    bits = filter_bits(keys.count())
    return membership(keys.sparkSession, position_bitmap(keys, bits), bits)
