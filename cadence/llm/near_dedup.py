"""Near-duplicate documents with circulant MinHash (operator 8).

A shingle's hash names one of D = 2^20 positions. One permutation scatters the
positions; the second, read from the scattered position onwards and wrapping
around, gives all signature coordinates: coordinate k of a set is the smallest
pi[(sigma(x) + k) mod D] over its members. The signature is cut into bands;
texts that share a band are candidates, which are confirmed on full shingle
sets (see ``linking``). With 32 bands of 6 a pair at the threshold of 0.85
misses every band with a probability of about 3e-7.

Equal sets are one class from the start, so copies are never paired. Documents
are linked when 100 * intersection >= percent * union; a group is a connected
component.

Defined cases: a NULL text counts as empty; a text without words has the empty
set and is linked with nothing, also not with another empty text; a NULL doc_id
never names a component unless all members' ids are NULL; rows sharing a doc_id
are judged by their own texts; repeated rows get equal results, and
``drop_near_duplicates`` leaves one of them; an empty table gives an empty
result; other columns, whatever their names, pass through
``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.bloom import maybe_in
from cadence.llm.common import fresh, give_back, keyed_texts, scratch_table, ship_package, slices, whole_text
from cadence.llm.linking import band_components
from cadence.llm.shingles import mix, numbered, set_key, shingle_sets

POSITION_BITS = 20
BANDS, ROWS = 32, 6
PERCENT = 85
BLOCK = 2048


@lru_cache(maxsize=1)
def permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """sigma, and all circular shifts of pi as windows over one array."""
    sigma = np.argsort(numbered(1 << POSITION_BITS, 11), kind="stable").astype(np.uint32)
    pi = np.argsort(numbered(1 << POSITION_BITS, 12), kind="stable").astype(np.uint32)
    shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:coordinates - 1]]), coordinates)
    return sigma, shifted


def signature(shingles: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """The circulant MinHash signature of a non-empty set of 64-bit hashes."""
    sigma, shifted = permutations(coordinates)
    at = sigma[shingles >> np.uint64(64 - POSITION_BITS)]
    out = shifted[at[:BLOCK]].min(axis=0)
    for i in range(BLOCK, len(at), BLOCK):
        np.minimum(out, shifted[at[i:i + BLOCK]].min(axis=0), out=out)
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket number per band; the band's number is part of it."""
    factor = numbered(rows, 13) | np.uint64(1)
    sums = (sig[:bands * rows].astype(np.uint64).reshape(bands, rows) * factor).sum(axis=1, dtype=np.uint64)
    return mix(sums + numbered(bands, 14)).view(np.int64)


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, n, key_a, key_b, bands) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int32()), ("key_a", pa.int64()),
                        ("key_b", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in (part for whole in batches for part in slices(whole, 2)):
            n, keys, buckets = [], [], []
            for s in shingle_sets(batch.column(2).to_pylist()):
                n.append(len(s))
                keys.append(set_key(s))
                buckets.append(band_hashes(signature(s, bands * rows), bands, rows) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array([k[0] for k in keys], pa.int64()),
                 pa.array([k[1] for k in keys], pa.int64()), pa.array(buckets, pa.list_(pa.int64()))], schema=schema)

    rows_in = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows_in.mapInArrow(
        run, "doc_id long, text_hash long, n int, key_a long, key_b long, bands array<long>")


def shingle_rows(texts: DataFrame) -> DataFrame:
    """(vid, items) of (vid, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["vid", "items"])

    return texts.select("vid", "text").mapInArrow(run, "vid long, items array<long>")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
           bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_shingles, component_id, kept."""
    ship_package(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)
    signed = scratch_table(signatures(texts, bands, rows), "signatures")
    classes = scratch_table(
        signed.where("n > 0").groupBy("key_a", "key_b")
        .agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("doc_id").alias("least_id"),
             F.min(F.struct("text_hash", "doc_id")).alias("one"))
        .withColumn("vid", F.monotonically_increasing_id()), "classes")

    def sets_of(vids: DataFrame) -> DataFrame:
        wanted = scratch_table(classes.join(vids, "vid").select(
            "vid", F.col("one.doc_id").alias("w_id"), F.col("one.text_hash").alias("w_hash")), "wanted")
        hashed = texts.withColumn("text_hash", F.xxhash64("text"))
        found = hashed.where(maybe_in(wanted.select("w_hash"))("text_hash")).join(
            wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")))
        return shingle_rows(found)

    labels = band_components(classes.select("vid", "n", "bands"), sets_of, percent)
    labelled = scratch_table(
        classes.select("vid", "key_a", "key_b", "least_id").join(labels, "vid", "left")
        .select("key_a", "key_b", "least_id", F.coalesce("label", "vid").alias("label")), "labelled")
    least = scratch_table(labelled.groupBy("label").agg(F.min("least_id").alias("component_id")), "components")
    named = scratch_table(labelled.join(least, "label").select("key_a", "key_b", "component_id"), "named")
    linked = signed.where("n > 0").select("doc_id", "text_hash", "n", "key_a", "key_b").join(named, ["key_a", "key_b"])
    alone = signed.where("n = 0").select("doc_id", "text_hash", "n", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "text_hash", "n", "component_id").unionByName(alone).select(
        "doc_id", "text_hash", F.col("n").cast("bigint").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                         bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, all columns kept."""
    kept = scratch_table(
        groups(docs, id_col, text_col, percent, bands, rows).where("kept")
        .groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"), F.first("component_id").alias("c"),
                                            F.first("n_shingles").alias("n")), "kept")
    # Rows of one id whose different texts are linked: the smallest hash stays.
    kept = kept.where("n = 0").unionByName(
        kept.where("n > 0").join(kept.where("n > 0").groupBy("c").agg(F.min("text_hash").alias("text_hash"))
                                 .withColumnRenamed("c", "g"),
                                 "text_hash").where(F.col("c").eqNullSafe(F.col("g"))).select(*kept.columns))
    th, k_id, k_hash, copies = fresh(docs, "th", "k_id", "k_hash", "copies")
    tagged = docs.withColumn(th, F.xxhash64(whole_text(text_col)))
    found = tagged.join(
        kept.select(F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_hash), F.col("copies").alias(copies)),
        F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(k_id)) & (F.col(th) == F.col(k_hash)))
    columns = [f"`{c}`" for c in docs.columns]
    single = found.where(F.col(copies) == 1).select(*columns)
    return single.unionByName(found.where(F.col(copies) > 1).dropDuplicates([k_id, k_hash]).select(*columns))
