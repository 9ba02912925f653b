"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at ``vnodes`` places of a ring of 64-bit hashes; a document
belongs to the first place clockwise of its doc_id's hash. A shard takes no more
than its capacity. Documents between the same two places (one arc) share the
order in which they meet the shards clockwise, so the loads are settled on the
counts of arcs: first every arc fills its own shard, then what a full shard could
not take continues to the next shard clockwise, and so on. Arcs are served in
ring order, documents of an arc in order of their hash. With no slack the
capacities add up to the number of documents, so the shards' counts differ by
one at most; with slack fewer documents leave their own shard.

Everything is DataFrame functions. Documents are sorted on the ring as narrow
rows (no texts) by range partitioning, ties spread; the place in an arc comes
from counts of (partition, arc), which number partitions plus arcs at most. The
arcs' table has ``shards * vnodes + 1`` rows whatever the input.

NULL text has no bytes; NULL doc_ids hash alike, and overflow like any other arc;
documents with equal doc_id, size and checksum are interchangeable. Other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.llm.common import keyed_texts, scratch_table

SHARDS = 16
VNODES = 64
CELL_BITS = 12
_LOCAL_BITS = 33


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _ring(spark: SparkSession, shards: int, vnodes: int) -> DataFrame:
    """(shard, at): the places of the shards' virtual nodes."""
    return spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.xxhash64(F.lit("shard"), F.col("id") % shards, F.floor(F.col("id") / shards)).alias("at"))


def _cell(at: Column) -> Column:
    return F.shiftright(at, 64 - CELL_BITS)


def _arcs(docs: DataFrame, ring: DataFrame) -> DataFrame:
    """``docs`` (at, ...) with ``arc``, the number of virtual nodes before them,
    looked up through equal cells of the ring."""
    cells = docs.sparkSession.range(1 << CELL_BITS).select((F.col("id") - (1 << (CELL_BITS - 1))).alias("cell"))
    nodes = ring.groupBy(_cell(F.col("at")).alias("cell")).agg(F.sort_array(F.collect_list("at")).alias("nodes"))
    held = F.coalesce(F.size("nodes"), F.lit(0))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    table = cells.join(nodes, "cell", "left").select(
        "cell", "nodes", F.coalesce(F.sum(F.greatest(held, F.lit(0))).over(before), _long(0)).alias("base"))
    inside = F.when(F.col("nodes").isNull(), _long(0)).otherwise(
        F.size(F.filter("nodes", lambda n: n < F.col("at"))).cast("bigint"))
    return docs.withColumn("cell", _cell(F.col("at"))).join(F.broadcast(table), "cell").select(
        *docs.columns, (F.col("base") + inside).alias("arc"))


def _settle(counts: DataFrame, ring: DataFrame, shards: int, vnodes: int, slack: float) -> DataFrame:
    """(arc, low, n, shard, slot, home): which shard takes the documents ``low``
    to ``low + n`` of an arc, and the slot of the first."""
    arcs = shards * vnodes + 1
    order = ring.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "shard"))), lambda r: r["shard"]).alias("ring"))
    clockwise = order.select(F.explode(F.sequence(_long(0), _long(arcs - 1))).alias("arc"), "ring").select(
        "arc", F.array_distinct(F.concat(
            F.expr(f"slice(ring, CAST(arc AS INT) + 1, {arcs})"), F.expr("slice(ring, 1, CAST(arc AS INT))"))).alias("way"))
    loads = clockwise.join(counts.groupBy("arc").agg(F.sum("n").alias("load")), "arc", "left")
    one = loads.agg(
        F.flatten(F.transform(
            F.sequence(F.lit(1), F.lit(shards)),
            lambda hop: F.transform(F.sort_array(F.collect_list(F.struct("arc", "way"))), lambda a: F.struct(
                a["arc"].alias("arc"), F.get(a["way"], hop - 1).alias("shard"))))).alias("steps"),
        F.transform(F.sort_array(F.collect_list(F.struct("arc", F.coalesce("load", _long(0)).alias("n")))),
                    lambda a: a["n"]).alias("load"),
        F.coalesce(F.sum("load"), _long(0)).alias("total"))
    shard_ids = F.sequence(_long(0), _long(shards - 1))
    if slack:
        room = F.transform(shard_ids, lambda s: F.ceil(F.col("total") * (1 + slack) / shards).cast("bigint"))
    else:
        room = F.transform(shard_ids, lambda s: F.floor(F.col("total") / shards).cast("bigint")
                           + F.when(s < F.col("total") % shards, _long(1)).otherwise(_long(0)))
    one = one.withColumn("room", room)
    zero = F.struct(F.col("load").alias("left"), F.col("room").alias("room"),
                    F.array().cast("array<struct<arc:bigint,low:bigint,n:bigint,shard:int,slot:bigint>>").alias("parts"))

    def less(values: Column, at: Column, n: Column) -> Column:
        return F.transform(values, lambda x, i: F.when(i == at, x - n).otherwise(x))

    def step(state: Column, way: Column) -> Column:
        left, room_left = F.get(state["left"], way["arc"].cast("int")), F.get(state["room"], way["shard"])
        n = F.least(left, room_left)
        part = F.struct(way["arc"].alias("arc"), (F.get(F.col("load"), way["arc"].cast("int")) - left).alias("low"),
                        n.alias("n"), way["shard"].alias("shard"),
                        (F.get(F.col("room"), way["shard"]) - room_left).alias("slot"))
        return F.when(n == 0, state).otherwise(F.struct(
            less(state["left"], way["arc"], n).alias("left"), less(state["room"], way["shard"], n).alias("room"),
            F.concat(state["parts"], F.array(part)).alias("parts")))

    parts = one.select(F.explode(F.aggregate("steps", zero, step, lambda s: s["parts"])).alias("p")).select("p.*")
    return parts.join(clockwise.select("arc", F.get("way", F.lit(0)).alias("home")), "arc")


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """Per document: doc_id, size (bytes and one), text_crc32, home_shard (the
    ring's own), shard, slot (gapless from 0 in its shard)."""
    spark = docs.sparkSession
    ring = _ring(spark, shards, vnodes)
    narrow = keyed_texts(docs).select(
        "doc_id", (F.octet_length("text") + 1).cast("bigint").alias("size"), F.crc32("text").alias("text_crc32"),
        F.xxhash64("doc_id").alias("at"))
    order = ["at", "doc_id", "size", "text_crc32"]
    placed = scratch_table(
        _arcs(narrow, ring).withColumn("spread", F.monotonically_increasing_id())
        .repartitionByRange(*order, "spread").sortWithinPartitions(*order, "spread").drop("at", "spread")
        .withColumn("place", F.monotonically_increasing_id()), "ring")
    runs = placed.groupBy("arc", F.shiftright("place", _LOCAL_BITS).alias("pid")).agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("arc").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("arc", "pid", "first", F.coalesce(F.sum("n").over(before), _long(0)).alias("before"))
    ranked = placed.withColumn("pid", F.shiftright("place", _LOCAL_BITS)).join(
        F.broadcast(starts), ["arc", "pid"]).withColumn("rank", F.col("before") + F.col("place") - F.col("first"))
    parts = _settle(runs, ring, shards, vnodes, slack).withColumnRenamed("arc", "part_arc")
    taken = (F.col("arc") == F.col("part_arc")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("low") + F.col("n"))
    return ranked.join(F.broadcast(parts), taken).select(
        "doc_id", "size", "text_crc32", F.col("home").alias("home_shard"), "shard",
        (F.col("slot") + F.col("rank") - F.col("low")).alias("slot"))
