"""Exact deduplication with two-pass Bloom filtering (operator 9).

Pass 1 reads the row hashes and keeps, for every position of a Bloom filter,
whether no row, one row, or more rows set it (two bitmaps: "once" and
"repeated"). Partial bitmaps are merged by filter segment: a position is
repeated when one part repeats it or two parts set it. Pass 2 tests each row
against the "repeated" bitmap: a row whose positions are not all repeated is
provably unique and passes straight through; only the others shuffle, into an
exact aggregation by SHA-256, so false positives cost time, never rows.

The filter (``bloom``) has a bounded size whatever the input. With more rows it
grows fuller and lets more unique rows into the shuffle, until the plan is a
plain aggregation by hash. Results are the same at every size.

Defined cases: a NULL text counts as the empty text, and all empty texts are
one group; a NULL doc_id sorts after every other id; repeated rows (same id,
same text) count in ``group_size`` and share one decision, and
``drop_duplicates`` leaves one of them; an empty table gives an empty result;
other columns, whatever their names, pass through ``drop_duplicates`` and are
ignored by ``decisions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.bloom import MAX_BITS, filter_bits, membership, position_bitmap
from cadence.llm.common import SPACE, fresh, keyed_texts, scratch_table, ship_package, whole_text

def text_sha256(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without white space."""
    return F.sha2(F.regexp_replace(text, f"{SPACE}+", ""), 256)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256, row_hash, n_points) of every row."""
    rows = keyed_texts(docs, id_col, text_col)
    return rows.select(
        "doc_id", text_sha256(F.col("text")).alias("text_sha256"),
        F.length("text").cast("bigint").alias("n_points"),
    ).withColumn("row_hash", F.xxhash64("text_sha256"))


def _plan(docs: DataFrame, id_col: str, text_col: str, max_bits: int):
    """The stored digests, the Bloom test, and the table of real groups."""
    ship_package(docs.sparkSession)
    rows = scratch_table(digests(docs, id_col, text_col), "exact-digests")
    bits = filter_bits(rows.count(), max_bits=max_bits)
    test = membership(docs.sparkSession, position_bitmap(rows.select("row_hash"), bits, least=2), bits)
    groups = (
        rows.where(test("row_hash")).groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"),
             F.max(F.struct(F.col("n_points"), F.col("doc_id").isNotNull().alias("known"),
                            (-F.col("doc_id")).alias("neg_id"))).alias("best"))
        .where("group_size > 1")
        .select("text_sha256", "group_size", (-F.col("best.neg_id")).alias("keep_id"),
                F.col("best.n_points").alias("keep_points")))
    return rows, test, scratch_table(groups, "exact-groups")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal without white space; the row with the most code
    points stays, then the smallest doc_id. The groups table is stored before
    the join, so that a group holding a large share of the rows is an ordinary
    skewed sort-merge join, which adaptive execution splits."""
    rows, test, groups = _plan(docs, id_col, text_col, max_bits)
    alone = rows.where(~test("row_hash")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    shuffled = rows.where(test("row_hash")).join(groups, "text_sha256", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("group_size").isNull()
         | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")))).alias("kept"),
        "text_sha256")
    return alone.unionByName(shuffled)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept. Rows that pass the
    Bloom test as unique are not shuffled; the others are joined with the
    groups, and repeated rows of a kept document are reduced to one."""
    _, test, groups = _plan(docs, id_col, text_col, max_bits)
    sha, row_hash, points = fresh(docs, "sha", "row_hash", "points")
    tagged = (
        docs.withColumn(sha, text_sha256(whole_text(text_col)))
        .withColumn(row_hash, F.xxhash64(sha)).withColumn(points, F.length(whole_text(text_col))))
    alone = tagged.where(~test(row_hash)).select(*(f"`{c}`" for c in docs.columns))
    names = fresh(tagged, "g_sha", "g_id", "g_points")
    g = groups.select(F.col("text_sha256").alias(names[0]), F.col("keep_id").alias(names[1]),
                      F.col("keep_points").alias(names[2]))
    found = tagged.where(test(row_hash)).join(g, F.col(sha) == F.col(names[0]), "left")
    single = found.where(F.col(names[0]).isNull())
    kept = found.where(
        F.col(names[0]).isNotNull()
        & F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(names[1])) & (F.col(points) == F.col(names[2]))
    ).dropDuplicates([sha])
    columns = [f"`{c}`" for c in docs.columns]
    return alone.unionByName(single.select(*columns)).unionByName(kept.select(*columns))
