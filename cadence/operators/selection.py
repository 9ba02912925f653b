"""Exact order statistics of many columns at once, without sorting them.

A double's bits, with the sign folded in, order like its value. Each pass fixes the
next eleven bits of the wanted values: tasks count, per column and prefix found so
far, how often each next eleven bits occur (one array a column and prefix), the
counts are summed by Spark, and the driver reads at most 2048 counts a column and
prefix to see into which the rank falls. Six passes fix all 64 bits, however many
rows or equal values there are.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.session import cut_lineage

_BITS = 11


def _width(shift: int) -> int:
    return _BITS if shift else 64 % _BITS


def _value(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else ~key & (1 << 64) - 1
    return struct.unpack("<d", struct.pack("<Q", bits))[0]


def _counter(shift: int, prefixes: list[list[int]]):
    """Counts of the bits above ``shift`` below each column's prefixes."""
    width = _width(shift)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        counts = [[np.zeros(1 << width, np.int64) for _ in own] for own in prefixes]
        for batch in batches:
            for column, own, found in zip(batch.columns, prefixes, counts):
                x = column.drop_null().to_numpy(zero_copy_only=False)
                bits = (x[~np.isnan(x)] + 0.0).view(np.uint64)
                keys = np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))
                above = keys >> np.uint64(shift + width) if shift + width < 64 else np.zeros(len(keys), np.uint64)
                digit = ((keys >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
                for prefix, total in zip(own, found):
                    total += np.bincount(digit[above == np.uint64(prefix)], minlength=1 << width)
        rows = [(i, prefix, int(d), int(total[d])) for i, (own, found) in enumerate(zip(prefixes, counts))
                for prefix, total in zip(own, found) for d in np.flatnonzero(total)]
        if rows:
            i, prefix, d, n = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array([f"{p:016x}" for p in prefix]), pa.array(d, pa.int32()), pa.array(n, pa.int64())],
                names=["column", "prefix", "digit", "n"])
    return run


def middle_values(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float] | None]:
    """Per column its two middle values (equal for an odd count), NULL and NaN
    ignored; None for a column without values."""
    if not cols:
        return {}
    values = cut_lineage(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]))
    targets: list[list[tuple[int, int]]] | None = None  # (prefix, rank below it)
    for shift in [*range(64 - _BITS, 0, -_BITS), 0]:
        width = _width(shift)
        prefixes = [sorted({p for p, _ in t}) for t in targets] if targets else [[0]] * len(cols)
        found = values.mapInArrow(_counter(shift, prefixes), "column int, prefix string, digit int, n bigint")
        counts: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in found.groupBy("column", "prefix", "digit").agg(F.sum("n").alias("n")).collect():
            counts.setdefault((r["column"], int(r["prefix"], 16)), []).append((r["digit"], r["n"]))
        if targets is None:
            sizes = [sum(n for _, n in counts.get((i, 0), [])) for i in range(len(cols))]
            targets = [[(0, (n - 1) // 2), (0, n // 2)] if n else [] for n in sizes]
        for i, own in enumerate(targets):
            for at, (prefix, rank) in enumerate(own):
                for digit, n in sorted(counts[i, prefix]):
                    if rank < n:
                        own[at] = (prefix << width | digit, rank)
                        break
                    rank -= n
    return {c: (_value(t[0][0]), _value(t[1][0])) if t else None for c, t in zip(cols, targets)}
