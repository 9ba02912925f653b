"""Derived input views over the driver tables.

The reference reads music catalogues and listening histories; the test tables
are a TPC-H-style star schema. These views turn them into the inputs the
operators expect (see FIXTURES.md). Each view exists twice with the same
meaning: a DataFrame builder for Spark and a SQL text for the DuckDB oracle.
Both derive every row from the whole input table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.operators.segments import ordered
from cadence.sources.tables import read_table


def _pad_id(prefix: str, k: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(k.cast("string"), 8, "0"))


def _ratio(k: Column, mul: int, add: int, mod: int, div: float) -> Column:
    return ((k * mul + add) % mod) / F.lit(float(div))


def _audio_columns(k: Column, p_size: Column, p_brand: Column, invert_energy: bool) -> list[Column]:
    energy = F.when(k % 43 == 0, F.lit(None).cast("double")).otherwise(
        _ratio(k, 104729, 31, 1013, 1012.0))
    if invert_energy:
        energy = F.lit(1.0) - energy
    artist = (
        F.when(k % 3 == 0, F.concat(F.lit("['"), p_brand, F.lit("', 'Brand#"),
                                    (1 + (k * 7) % 25).cast("string"), F.lit("']")))
        .when(k % 3 == 1, F.concat(F.lit("['"), p_brand, F.lit("']")))
        .otherwise(p_brand)
    )
    year = (2012 + (k * 13) % 12).cast("string")
    return [
        artist.alias("artist_raw"),
        (p_size * 2).alias("popularity"),
        F.when(k % 41 == 0, F.lit(None).cast("double")).otherwise(
            _ratio(k, 7919, 17, 1009, 1008.0)
            + F.when(k % 53 == 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("danceability"),
        energy.alias("energy"),
        (_ratio(k, 1299709, 7, 1019, 1018.0)
         - F.when(k % 59 == 0, F.lit(0.25)).otherwise(F.lit(0.0))).alias("valence"),
        _ratio(k, 224737, 3, 1021, 1020.0).alias("acousticness"),
        _ratio(k, 350377, 11, 1031, 1030.0).alias("instrumentalness"),
        (F.lit(30.0) + _ratio(k, 15485863, 5, 2300, 10.0)).alias("tempo"),
        _ratio(k, 611953, 13, 1033, 3096.0).alias("speechiness"),
        _ratio(k, 746773, 19, 1039, 2076.0).alias("liveness"),
        (F.lit(-60.0) + _ratio(k, 882377, 23, 601, 10.0)).alias("loudness"),
        (150000 + (k * 9973) % 150000).alias("duration_ms"),
        ((k * 31 + 5) % 12).alias("key"),
        ((k * 17 + F.floor(k / F.lit(12.0)).cast("bigint")) % 2).alias("mode"),
        (3 + (k * 13) % 3).alias("time_signature"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, year)
        .otherwise(F.concat(year, F.lit("-0"), (1 + k % 9).cast("string"), F.lit("-15")))
        .alias("release_date"),
    ]


def tracks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source 1 of the catalogue: one track per part."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("bigint")
    cols = _audio_columns(k, F.col("p_size"), F.col("p_brand"), invert_energy=False)
    return p.select(
        _pad_id("T", k).alias("track_id"),
        F.col("p_name").alias("track_name"),
        cols[0],
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("genre"),
        *cols[1:],
    )


def tracks_raw_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source 2 with the raw column names of another catalogue (``id``,
    ``name``, ``artists``, ``playlist_subgenre``), ids overlapping source 1
    (``3k``), some null ids, energy inverted and no genre."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("bigint")
    cols = _audio_columns(k, F.col("p_size"), F.col("p_brand"), invert_energy=True)
    return p.select(
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(_pad_id("T", k * 3)).alias("id"),
        F.col("p_name").alias("name"),
        cols[0].alias("artists"),
        F.col("p_brand").alias("playlist_subgenre"),
        *cols[1:],
        k.alias("source_row"),
    )


def tracks_raw_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source 3, one row per customer, with the hard rows: two rows to an id, some
    rows without an id, without any feature, or with features that are all zero."""
    return spark.sql(TRACKS_RAW_C_SQL.replace("FROM customer", "FROM {customer}"),
                     customer=read_table(spark, sf_dir, "customer"))


def interactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listening events: one row per line item, user = ordering customer."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _pad_id("U", F.col("o_custkey")).alias("user_id"),
        _pad_id("T", F.col("l_partkey")).alias("track_id"),
        F.col("l_quantity").cast("bigint").alias("play_count"),
        F.col("o_orderdate").alias("ts"),
    )


def playlist_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences with a large vocabulary: a customer's line items in order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_shipdate")
    rows = o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    order = ["o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_shipdate"]
    return ordered(rows, ["o_custkey"], order).select(
        F.col("o_custkey").alias("seq_id"), "pos", _pad_id("T", F.col("l_partkey")).alias("track_id"))


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences with a small vocabulary: a user's event types in time order."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return ordered(e, ["user_id"], ["ts", "event_id"]).select(
        F.col("user_id").alias("seq_id"), "pos", F.col("event_type").alias("track_id"))


# ---------------------------------------------------------------------------
# The same views as SQL text (DuckDB oracle side)
# ---------------------------------------------------------------------------

def _audio_sql(energy_expr: str) -> str:
    return f"""
       CASE WHEN k % 3 = 0 THEN concat('[''', p_brand, ''', ''Brand#', cast(1 + (k * 7) % 25 AS VARCHAR), ''']')
            WHEN k % 3 = 1 THEN concat('[''', p_brand, ''']') ELSE p_brand END AS {{artist}},
       p_size * 2 AS popularity,
       CASE WHEN k % 41 = 0 THEN NULL ELSE ((k * 7919 + 17) % 1009) / 1008e0
            + CASE WHEN k % 53 = 0 THEN 0.5e0 ELSE 0e0 END END AS danceability,
       {energy_expr} AS energy,
       ((k * 1299709 + 7) % 1019) / 1018e0 - CASE WHEN k % 59 = 0 THEN 0.25e0 ELSE 0e0 END AS valence,
       ((k * 224737 + 3) % 1021) / 1020e0 AS acousticness,
       ((k * 350377 + 11) % 1031) / 1030e0 AS instrumentalness,
       30e0 + ((k * 15485863 + 5) % 2300) / 10e0 AS tempo,
       ((k * 611953 + 13) % 1033) / 3096e0 AS speechiness,
       ((k * 746773 + 19) % 1039) / 2076e0 AS liveness,
       -60e0 + ((k * 882377 + 23) % 601) / 10e0 AS loudness,
       150000 + (k * 9973) % 150000 AS duration_ms,
       (k * 31 + 5) % 12 AS key,
       (k * 17 + cast(floor(k / 12e0) AS BIGINT)) % 2 AS mode,
       3 + (k * 13) % 3 AS time_signature,
       CASE WHEN k % 11 = 0 THEN NULL
            WHEN k % 7 = 0 THEN cast(2012 + (k * 13) % 12 AS VARCHAR)
            ELSE concat(cast(2012 + (k * 13) % 12 AS VARCHAR), '-0', cast(1 + k % 9 AS VARCHAR), '-15') END AS release_date"""


_ENERGY = "CASE WHEN k % 43 = 0 THEN NULL ELSE ((k * 104729 + 31) % 1013) / 1012e0 END"

# genre sits between artist_raw and popularity in the Spark view; column order
# does not matter to the oracle comparison, so it is appended here.
TRACKS_RAW_SQL = f"""
SELECT concat('T', lpad(cast(k AS VARCHAR), 8, '0')) AS track_id,
       p_name AS track_name,
       CASE WHEN k % 97 = 0 THEN NULL ELSE p_type END AS genre,
       {_audio_sql(_ENERGY).replace('{artist}', 'artist_raw').strip()}
FROM (SELECT CAST(p_partkey AS BIGINT) AS k, * FROM part) p
"""

TRACKS_RAW_B_SQL = f"""
SELECT CASE WHEN k % 17 = 0 THEN NULL ELSE concat('T', lpad(cast(k * 3 AS VARCHAR), 8, '0')) END AS id,
       p_name AS name,
       p_brand AS playlist_subgenre,
       {_audio_sql('1e0 - (' + _ENERGY + ')').replace('{artist}', 'artists').strip()},
       k AS source_row
FROM (SELECT CAST(p_partkey AS BIGINT) AS k, * FROM part) p
"""

def _customer_feature(expr: str, zero: str) -> str:
    return f"CASE WHEN k % 13 = 0 THEN NULL WHEN k % 29 = 0 THEN {zero} ELSE {expr} END"


_CUSTOMER_UNIT = ", ".join(
    f"{_customer_feature(f'((k * {m} + {a}) % 997) / 996e0', '0e0')} AS {c}" for c, m, a in [
        ("danceability", 7907, 3), ("energy", 7901, 5), ("valence", 7883, 7), ("acousticness", 7879, 11),
        ("instrumentalness", 7877, 13), ("speechiness", 7873, 17), ("liveness", 7867, 19)])

# valid in both engines
TRACKS_RAW_C_SQL = f"""
SELECT CASE WHEN k % 19 = 0 THEN NULL
            ELSE concat('T', lpad(CAST(CAST(floor(k / 2e0) AS BIGINT) * 5 AS STRING), 8, '0')) END AS track_id,
       c_name AS track_name,
       concat('[\'\'', c_mktsegment, '\'\']') AS artists,
       CASE WHEN k % 5 = 0 THEN NULL ELSE c_mktsegment END AS genre,
       CAST(k % 101 AS INT) AS popularity,
       {_CUSTOMER_UNIT},
       {_customer_feature("35e0 + (k * 613) % 220", "0e0")} AS tempo,
       {_customer_feature("-50e0 + (k * 389) % 51", "0e0")} AS loudness,
       {_customer_feature("180000 + (k * 773) % 90000", "0")} AS duration_ms,
       {_customer_feature("k % 12", "0")} AS key, {_customer_feature("k % 2", "0")} AS mode,
       {_customer_feature("3 + k % 3", "0")} AS time_signature,
       CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(2015 + k % 9 AS STRING) END AS release_date,
       k AS source_row
FROM (SELECT CAST(c_custkey AS BIGINT) AS k, * FROM customer) c
"""

INTERACTIONS_RAW_SQL = """
SELECT concat('U', lpad(cast(o_custkey AS VARCHAR), 8, '0')) AS user_id,
       concat('T', lpad(cast(l_partkey AS VARCHAR), 8, '0')) AS track_id,
       CAST(l_quantity AS BIGINT) AS play_count,
       o_orderdate AS ts
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
"""

PLAYLIST_ITEMS_SQL = """
SELECT o_custkey AS seq_id,
       CAST(row_number() OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  l_quantity, l_extendedprice, l_shipdate) - 1 AS BIGINT) AS pos,
       concat('T', lpad(cast(l_partkey AS VARCHAR), 8, '0')) AS track_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
"""

EVENT_ITEMS_SQL = """
SELECT user_id AS seq_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS pos,
       event_type AS track_id
FROM events
"""
