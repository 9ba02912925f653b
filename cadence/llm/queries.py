"""One query per operator; ``QUERIES`` and ``ORACLE`` are read by the entry
module. Each query applies its operator with production parameters to the whole
table and derives the digest columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import (conversation_repair, exact_dedup, fingerprints, near_dedup, packing, paragraphs, pieces,
                         ring_sharding, secret_scan, spelling, substring_dedup, token_files, toxicity)
from cadence.llm.common import documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.with_scores(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256")).withColumn(
        "removed_share", F.when(F.col("n_bytes") > 0, F.col("n_removed") / F.col("n_bytes")).otherwise(0.0))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rule"] < len(secret_scan.BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *(count(i).alias(f"n_{kind}") for i, kind in enumerate(secret_scan.BASE)),
        F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"), secret_scan.span_list(F.col("spans")).alias("spans"))


def op4_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(documents(spark, sf_dir)).drop("text_hash")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_documents(token_files.write_tokens(documents(spark, sf_dir)))


def op6_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.piece_digests(documents(spark, sf_dir))
    best = F.get("segmentations", F.lit(0))
    return found.select(
        "doc_id", best["n_pieces"].alias("n_pieces"), best["score"].alias("score"), best["ids_crc32"].alias("ids_crc32"),
        F.col("segmentations.score").alias("nbest_scores"), F.col("segmentations.ids_crc32").alias("nbest_crc32"),
        "round_trip")


def op7_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(documents(spark, sf_dir))


def op8_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    decisions, _ = conversation_repair.repair(conversation_repair.damage(conversations))
    return conversation_repair.with_missing(conversations, decisions)


def op12_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_sharding.assign(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_suffix_dedup, op3_secret_scan, op4_paragraph_minhash, op5_token_files, op6_piece_nbest,
    op7_weighted_fingerprints, op8_circulant_minhash, op9_exact_dedup, op10_packing, op11_conversation_repair,
    op12_ring_sharding, op13_spelling_variants)}

def _secret_sql() -> str:
    """Spans from the lengths of a rule's matches and of the text between them."""
    def lengths(rule: secret_scan.Rule, call: str) -> str:
        return f"list_transform({call.format(rule.pattern.replace(chr(39), chr(39) * 2))}, lambda x: length(x))"

    parts = ", ".join(
        f"{lengths(r, "regexp_extract_all(text, '{}', 0)")} AS own{k}, "
        f"{lengths(r, "regexp_split_to_array(text, '{}')")} AS gap{k}, "
        f"{lengths(r, f"regexp_extract_all(text, '{{}}', {r.group})")} AS kept{k}"
        for k, r in enumerate(secret_scan.RULES))
    start = "CAST(list_sum(gap{0}[1:i]) + coalesce(list_sum(own{0}[1:i - 1]), 0) AS BIGINT)"
    found = ", ".join(
        f"[{{'start': {start.format(k)}, 'rule': {k}, 'stop': {start.format(k)} + own{k}[i]}} "
        f"FOR i IN range(1, len(own{k}) + 1) IF kept{k}[i] >= {r.least}]" for k, r in enumerate(secret_scan.RULES))
    kinds = ", ".join(f"'{r.kind}'" for r in secret_scan.RULES)

    def listed(only: str) -> str:
        return (f"coalesce(array_to_string([([{kinds}])[s.rule + 1] || ':' || s.start || ':' || s.stop "
                f"FOR s IN found IF {only}], ','), '')")

    base = len(secret_scan.BASE)
    counts = ", ".join(f"len([s FOR s IN found IF s.rule = {k}]) AS n_{kind}" for k, kind in enumerate(secret_scan.BASE))
    return f"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        parts AS (SELECT doc_id, {parts} FROM t),
        spans AS (SELECT doc_id, list_sort(flatten([{found}])) AS found FROM parts)
        SELECT doc_id, {counts}, sha256({listed(f"s.rule < {base}")}) AS base_sha256, {listed("true")} AS spans
        FROM spans"""


#: White space, as in the contracts of the queries below.
ORACLE: dict[str, str] = {
    "op3_secret_scan": _secret_sql(),
    "op9_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents),
        g AS (
            SELECT text_sha256, first(doc_id ORDER BY length(text) DESC, doc_id) AS keep_id,
                   count(*) AS group_size
            FROM t GROUP BY text_sha256)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
        FROM t JOIN g USING (text_sha256)""",
}
