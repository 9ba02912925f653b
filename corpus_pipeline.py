"""A training-corpus pipeline over ``documents``.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread as the next
stage's docs. All stages but the last return the columns of ``documents``;
the last returns the pieces of packed sequences.

Toxic texts go, of equal texts one stays, of linked near copies one stays,
secrets are replaced in the texts, and what is left is packed.

In every stage a NULL text counts as empty (and stays NULL while the row is kept),
NULLs in other columns pass through, texts are read whole, ties go as the stage's
operator states, repeated rows are copies of one another, columns of any name pass
through, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import exact_dedup, near_dedup, packing, secret_scan, toxicity
from cadence.llm.common import documents, fresh, scratch_table

#: Similarity from which near copies are one group, in percent.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold, repeated rows each
    by its own text. Empty texts have the score of a text without features; without
    labels of both kinds the model scores all texts alike."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (score,) = fresh(docs, "toxicity")
    return toxicity.with_scores(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of texts equal without white space: the most
    code points, then the smallest doc_id (NULL last); all empty texts are one group."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest
    doc_id. Texts without words are linked with nothing and stay."""
    return near_dedup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by a mark; n_chars follows
    where it and the text are known."""
    redacted = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.when(
        F.col("n_chars").isNotNull() & F.col("text").isNotNull(), F.length("text").cast("bigint"))
        .otherwise(F.col("n_chars"))).select(*(f"`{c}`" for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token sequences; an empty text is one piece of its
    end token."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: The fitted classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and reread in between."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch_table(docs, f"stage-{name}")
    return docs
