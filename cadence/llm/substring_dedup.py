"""Exact removal of repeated byte strings by suffix sorting (operator 2).

Every byte covered by a string of ``length`` bytes that also starts somewhere
else, in any document or the same, is removed; overlaps count, and strings are
judged on the input.

Sorting every suffix is not needed to find repeats of ``length`` bytes. Each
window of that length is owned by an anchor: the start of its smallest hashed
gram (of ``GRAM`` bytes, the leftmost on ties), a function of the window alone.
Equal windows have equal anchors at equal offsets, so only anchors are sorted,
one for about 170 positions, and the windows an anchor owns are a range.

1. ``anchors`` lists each document's anchors with the hash of their gram and of
   their context (all bytes of the windows they own).
2. Anchors whose gram occurs once own no repeated window. Anchors with equal
   context are one class; a class of two or more is repeated as a whole. This is
   two aggregations, so a text copied a million times is one class.
3. Classes that share a gram but differ in context may share part of their
   windows. Their contexts are fetched from the texts and brought together by
   gram; the strings before and after the anchors are deep-shallow sorted and
   the sort orders give every repeated window (``suffix_sort``).
4. A gram with more than ``group_limit`` different contexts is not one task's
   work: its windows are hashed (128 bits) and counted by an aggregation.
5. The ranges found are gathered per document and cut out of its bytes.

Defined cases: a NULL text counts as empty; texts shorter than ``length`` lose
nothing; NULL doc_ids are matched with each other when results are joined back;
rows sharing a doc_id are told apart by their texts; repeated rows repeat each
other, so both lose what is covered; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import keyed_texts, scratch_table, ship_package, shuffle_partitions
from cadence.llm.shingles import mix, numbered
from cadence.llm.suffix_sort import shared_offsets

LENGTH = 400
GRAM = 64
POSITION_BITS = 20
GROUP_LIMIT = 20_000
SLICE = 512

_BYTE = numbered(256, 31)
_FACTORS = numbered(GRAM.bit_length(), 32) | np.uint64(1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on, by doubling."""
    h, width = _BYTE[data], 1
    while width < GRAM:
        h = h[:-width] * _FACTORS[width.bit_length()] + h[width:]
        width *= 2
    return mix(h)


def sliding_min(x: np.ndarray, window: int) -> np.ndarray:
    """Smallest value of every ``window`` consecutive values."""
    width = 1
    while 2 * width <= window:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = window - width
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, stops: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(position, first window, last window, gram hash) of every anchor of the
    texts in ``data`` that end at ``stops``; at most 2^POSITION_BITS bytes."""
    if len(data) < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    h = gram_hashes(data)
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1)
    owner = (least & low).astype(np.int64)
    starts = np.arange(len(owner))
    stop_of = np.repeat(stops, np.diff(stops, prepend=0))[:len(owner)]
    valid = np.flatnonzero(starts + length <= stop_of)
    if not len(valid):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    own = owner[valid]
    first = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(valid, prepend=-2) != 1))
    last = np.append(first[1:], len(valid)) - 1
    return own[first], valid[first], valid[last], h[own[first]]


def _chunks(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int]], np.ndarray]]:
    """(bytes, (text number, offset in it) of each part, ends of the parts) of
    bounded size; parts of a long text overlap so that no window is lost."""
    most = 1 << POSITION_BITS
    parts: list[bytes] = []
    where: list[tuple[int, int]] = []
    size = 0
    for k, text in enumerate(texts):
        at = 0
        while True:
            piece = text[at:at + most]
            if parts and size + len(piece) > most:
                yield b"".join(parts), where, np.cumsum([len(p) for p in parts])
                parts, where, size = [], [], 0
            parts.append(piece)
            where.append((k, at))
            size += len(piece)
            if at + most >= len(text):
                break
            at += most - length + 1
    if parts:
        yield b"".join(parts), where, np.cumsum([len(p) for p in parts])


ANCHORS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int64()), ("lo", pa.int64()),
                     ("hi", pa.int64()), ("gram", pa.int64()), ("ctx", pa.int64())])
ANCHORS_TYPE = "doc_id long, text_hash long, pos long, lo long, hi long, gram long, ctx long"


def anchor_rows(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per anchor of (doc_id, text_hash, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                batch = whole.slice(i, SLICE)
                encoded = [t.encode() for t in batch.column(2).to_pylist()]
                for data, where, stops in _chunks(encoded, length):
                    pos, lo, hi, gram = anchors(np.frombuffer(data, np.uint8), stops, length)
                    part = np.searchsorted(stops, pos, "right")
                    begin = stops - np.diff(stops, prepend=0)
                    at = np.array([w[1] for w in where])
                    shift = at[part] - begin[part]
                    ctx = [xxhash.xxh3_64_intdigest(data[a:b + length], p - a) for p, a, b in zip(
                        pos.tolist(), lo.tolist(), hi.tolist())]
                    row = pa.array(np.array([w[0] for w in where])[part])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(row), batch.column(1).take(row), pa.array(pos + shift),
                         pa.array(lo + shift), pa.array(hi + shift), pa.array(gram.view(np.int64)),
                         pa.array(np.array(ctx, np.uint64).view(np.int64))], schema=ANCHORS)

    return texts.mapInArrow(run, ANCHORS_TYPE)


def repeated_windows(texts: DataFrame, length: int = LENGTH, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, text_hash, first, last): ranges of window starts whose windows
    occur elsewhere too. ``texts``: (doc_id, text_hash, text)."""
    spark = texts.sparkSession
    listed = scratch_table(anchor_rows(texts, length), "anchors")
    grams = scratch_table(
        listed.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b"))
        .where("n > 1").select("gram", (F.col("a") != F.col("b")).alias("mixed")), "grams")
    repeated = scratch_table(listed.join(grams, "gram"), "repeated")
    classes = scratch_table(
        repeated.groupBy("gram", "ctx", "mixed")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "pos", "lo", "hi")).alias("one")),
        "classes")
    whole = repeated.join(classes.where("n > 1").select("gram", "ctx"), ["gram", "ctx"]).select(
        "doc_id", "text_hash", F.col("lo").alias("first"), F.col("hi").alias("last"))

    # Contexts of one member of each class that shares its gram with others.
    sizes = scratch_table(classes.where("mixed").groupBy("gram").agg(
        (F.count(F.lit(1)) > group_limit).alias("many")), "sizes")
    asked = (classes.where("mixed").join(sizes, "gram")
             .select("gram", (F.col("n") > 1).alias("whole"), "many", "one.*")
             .groupBy(F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash"))
             .agg(F.collect_list(F.struct("pos", "lo", "hi", "gram", "whole", "many")).alias("wanted")))
    asked = scratch_table(asked, "asked")  # one list per text, no longer than its anchors
    holders = texts.join(asked, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                rows = batch.slice(i, 64).to_pylist()
                out = {n: [] for n in ("doc_id", "text_hash", "pos", "lo", "hi", "gram", "whole", "many", "bytes")}
                for r in rows:
                    data = r["text"].encode()
                    for w in r["wanted"]:
                        out["doc_id"].append(r["doc_id"])
                        out["text_hash"].append(r["text_hash"])
                        for name in ("pos", "lo", "hi", "gram", "whole", "many"):
                            out[name].append(w[name])
                        out["bytes"].append(data[w["lo"]:w["hi"] + length])
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                    [(n, pa.int64()) for n in ("doc_id", "text_hash", "pos", "lo", "hi", "gram")]
                    + [("whole", pa.bool_()), ("many", pa.bool_()), ("bytes", pa.binary())]))

    contexts = scratch_table(
        holders.select("doc_id", "text_hash", "text", "wanted").mapInArrow(
            fetch, "doc_id long, text_hash long, pos long, lo long, hi long, gram long, whole boolean, many boolean, "
                   "bytes binary"), "contexts")
    ranges_type = "doc_id long, text_hash long, first long, last long"
    ranges = pa.schema([(n, pa.int64()) for n in ("doc_id", "text_hash", "first", "last")])

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by gram; a group is at most group_limit rows (more
        only for repeated rows, each twice)."""
        def rows():
            for batch in batches:
                for i in range(0, batch.num_rows, 1024):
                    yield from batch.slice(i, 1024).to_pylist()

        out: list[tuple] = []
        for _, group in groupby(rows(), key=lambda r: r["gram"]):
            members = list(group)
            if len(members) == 1 or all(m["whole"] for m in members):
                continue
            # Bytes outside the owned windows are padded by 0xFF, which UTF-8 never holds.
            lefts = [m["bytes"][:m["pos"] - m["lo"]][::-1].ljust(length, b"\xff") for m in members]
            rights = [m["bytes"][m["pos"] - m["lo"]:].ljust(length, b"\xff") for m in members]
            for m, offsets in zip(members, shared_offsets(lefts, rights, length)):
                if m["whole"]:
                    continue
                for low, high in offsets:
                    first, last = max(m["lo"], m["pos"] - high), min(m["hi"], m["pos"] - low)
                    if first <= last:
                        out.append((m["doc_id"], m["text_hash"], first, last))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=ranges)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=ranges)

    partial = (contexts.where("not many").select("gram", "doc_id", "text_hash", "pos", "lo", "hi", "whole", "bytes")
               .repartition(shuffle_partitions(spark), "gram").sortWithinPartitions("gram")
               .mapInArrow(sort_groups, ranges_type))

    def window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                out = []
                for r in batch.slice(i, 128).to_pylist():
                    for s in range(r["hi"] - r["lo"] + 1):
                        h = xxhash.xxh3_128_digest(r["bytes"][s:s + length])
                        out.append((r["doc_id"], r["text_hash"], r["lo"] + s, int.from_bytes(h[:8], "big", signed=True),
                                    int.from_bytes(h[8:], "big", signed=True), 2 if r["whole"] else 1))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out)],
                        names=["doc_id", "text_hash", "first", "h1", "h2", "weight"])

    hashed = contexts.where("many").select("doc_id", "text_hash", "lo", "hi", "whole", "bytes").mapInArrow(
        window_hashes, "doc_id long, text_hash long, first long, h1 long, h2 long, weight long")
    if sizes.where("many").isEmpty():
        return whole.unionByName(partial)
    hashed = scratch_table(hashed, "windows")
    twice = scratch_table(hashed.groupBy("h1", "h2").agg(F.sum("weight").alias("n")).where("n > 1"), "twice")
    counted = hashed.join(twice, ["h1", "h2"]).select("doc_id", "text_hash", "first", F.col("first").alias("last"))
    return whole.unionByName(partial).unionByName(counted)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (the maximal removed runs,
    start and stop in bytes) and kept (the remaining bytes)."""
    ship_package(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = scratch_table(
        repeated_windows(texts, length, group_limit)
        .groupBy(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"))
        .agg(F.collect_set(F.struct("first", "last")).alias("ranges")), "ranges")
    joined = texts.join(
        found, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")), "left")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                out: dict[str, list] = {n: [] for n in schema.names}
                for r in batch.slice(i, SLICE).to_pylist():
                    data, spans = r["text"].encode(), []
                    for a, b in sorted((x["first"], x["last"] + length) for x in r["ranges"] or ()):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], b)
                        else:
                            spans.append([a, b])
                    edges = [0, *(e for s in spans for e in s), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    for name, value in zip(schema.names, (
                            r["doc_id"], len(data), [{"start": a, "stop": b} for a, b in spans], kept)):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return joined.select("doc_id", "text", "ranges").mapInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
