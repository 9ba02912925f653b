"""Catalogue queries: sources, union, dedupe, index, cleaning steps, year,
split, joins, search, lookup and catalogue statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import AUDIO_FEATURES, UNIT_FEATURES, VIBE_FEATURES, YEAR_COLUMNS
from cadence.functions.text import clean_artist, clean_artist_sql, infer_year, text_contains
from cadence.operators import clean, index
from cadence.plans.registry import (all_sources, interactions, query, r9, r9_sql, tracks,
                                    union_all_sources, vibe)
from cadence.plans.sql import deduped_sql, median_sql, with_ctes, year_sql
from cadence.sources import fixtures as fx

# Per-source load summary ------------------------------------------------

query("source_summary", with_ctes("""
SELECT source_priority, count(*) AS rows, count(DISTINCT track_id) AS distinct_track_ids,
       count(*) - count(track_id) AS null_track_ids,
       count(*) - count(danceability) AS null_danceability,
       count(*) - count(energy) AS null_energy,
       count(genre) AS with_genre
FROM union_src GROUP BY source_priority""", "union_src"))(
    lambda spark, sf: union_all_sources(spark, sf).groupBy("source_priority").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("track_id").alias("distinct_track_ids"),
        F.count(F.when(F.col("track_id").isNull(), 1)).alias("null_track_ids"),
        F.count(F.when(F.col("danceability").isNull(), 1)).alias("null_danceability"),
        F.count(F.when(F.col("energy").isNull(), 1)).alias("null_energy"),
        F.count("genre").alias("with_genre")))

# U1 / W2 / W1 -----------------------------------------------------------------

query("union_sources", with_ctes("SELECT * FROM union_src", "union_src"))(
    lambda spark, sf: union_all_sources(spark, sf))

query("dedupe_tracks", with_ctes("SELECT * FROM deduped", "deduped"))(
    lambda spark, sf: clean.dedupe_tracks(union_all_sources(spark, sf)))

query("dense_track_index", with_ctes("""
SELECT track_id, CAST(row_number() OVER (ORDER BY track_id) - 1 AS BIGINT) AS track_idx
FROM (SELECT DISTINCT track_id FROM union_src WHERE track_id IS NOT NULL) d""", "union_src"))(
    lambda spark, sf: index.distinct_index(union_all_sources(spark, sf), "track_id", "track_idx"))

# P3 / P4 / P5 / P6 ------------------------------------------------------------

query("clean_artist", with_ctes(
    f"SELECT track_id, artist_raw, {clean_artist_sql('artist_raw')} AS artist FROM tracks_raw",
    "tracks_raw"))(
    lambda spark, sf: fx.tracks_raw(spark, sf).select(
        "track_id", "artist_raw", clean_artist(F.col("artist_raw")).alias("artist")))

query("impute_median", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {median_sql('tracks_f1', c)} AS median" for c in AUDIO_FEATURES),
    "tracks_f1"))(
    lambda spark, sf: clean.median_frame(
        fx.tracks_raw(spark, sf).dropna(how="all", subset=AUDIO_FEATURES), AUDIO_FEATURES))

query("clamp_features", with_ctes(
    "SELECT track_id, " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, 0e0), 1e0) END AS {c}"
        for c in UNIT_FEATURES) + " FROM tracks_raw", "tracks_raw"))(
    lambda spark, sf: fx.tracks_raw(spark, sf).select("track_id", *[
        F.when(F.col(c).isNull(), F.lit(None)).otherwise(
            F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0))).alias(c) for c in UNIT_FEATURES]))

query("infer_year", with_ctes(
    f"SELECT track_id, release_date, {year_sql('release_date')} AS year FROM tracks_raw",
    "tracks_raw"))(
    lambda spark, sf: fx.tracks_raw(spark, sf).select(
        "track_id", "release_date",
        infer_year(YEAR_COLUMNS, {"release_date"}).alias("year")))

# temporal split -----------------------------------------------------------

query("temporal_split", with_ctes("""
SELECT track_id, track_idx, year,
       CASE WHEN year IN (2021) THEN 'val' WHEN year IN (2022) THEN 'test' ELSE 'train' END AS split
FROM tracks""", "tracks"))(
    lambda spark, sf: clean.temporal_split(tracks(spark, sf)).select(
        "track_id", "track_idx", "year", "split"))

# Cleaning report ---------------------------------------------------------

_ALL_NULL = " AND ".join(f"{c} IS NULL" for c in AUDIO_FEATURES)
query("cleaning_report", with_ctes(f"""
SELECT 0 AS step_no, 'input' AS step, count(*) AS rows FROM union_src
UNION ALL SELECT 1, 'dedupe', count(*) FROM deduped
UNION ALL SELECT 2, 'drop_all_null', count(*) FROM deduped WHERE NOT ({_ALL_NULL})
UNION ALL SELECT 3, 'tempo_filter', count(*) FROM deduped
  WHERE NOT ({_ALL_NULL}) AND (tempo BETWEEN 40 AND 250 OR tempo IS NULL)""", "deduped"))(
    lambda spark, sf: clean.cleaning_report(union_all_sources(spark, sf)))

# Metadata joins --------------------------------------------------------

_META = ["track_id", "track_name", "artist", "genre", "popularity", "loudness", "duration_ms",
         "key", "mode", "time_signature", "track_idx", "year"]


@query("track_feature_join", with_ctes(
    "SELECT " + ", ".join(f"t.{c}" for c in _META) + ", "
    + ", ".join(r9_sql(c, "v") for c in VIBE_FEATURES)
    + " FROM tracks t LEFT JOIN vibe v ON t.track_idx = v.track_idx", "tracks", "vibe"))
def q_track_feature_join(spark, sf):
    tr = tracks(spark, sf)
    v = vibe(spark, sf, tr).select("track_idx", *[r9(c) for c in VIBE_FEATURES])
    return tr.select(*_META).join(v, "track_idx", "left")


@query("track_search", with_ctes("""
SELECT track_idx, track_id, track_name, artist FROM tracks
WHERE coalesce(contains(lower(track_name), 'red'), false)
   OR coalesce(contains(lower(artist), 'red'), false)
ORDER BY track_idx LIMIT 20""", "tracks"))
def q_track_search(spark, sf, text: str = "red"):
    if len(text) < 2:
        raise ValueError("search text needs at least 2 characters")
    tr = tracks(spark, sf)
    hit = text_contains(F.col("track_name"), text) | text_contains(F.col("artist"), text)
    return tr.where(hit).select("track_idx", "track_id", "track_name", "artist") \
        .orderBy("track_idx").limit(20)


_CARD = ["track_id", "track_idx", "track_name", "artist", "genre", "popularity", "energy",
         "valence", "tempo", "danceability", "key", "mode"]


@query("track_lookup", with_ctes(
    "SELECT " + ", ".join(_CARD) + " FROM tracks WHERE track_id IN "
    "(SELECT track_id FROM interactions_raw)", "tracks", "interactions_raw"))
def q_track_lookup(spark, sf):
    wanted = fx.interactions_raw(spark, sf).select("track_id")
    return tracks(spark, sf).join(wanted, "track_id", "left_semi").select(*_CARD)


# Catalogue statistics ---------------------------------------------------

query("catalog_stats", with_ctes("""
SELECT count(*) AS tracks, count(DISTINCT genre) AS genres, count(DISTINCT artist) AS artists
FROM tracks""", "tracks"))(
    lambda spark, sf: tracks(spark, sf).agg(
        F.count(F.lit(1)).alias("tracks"), F.countDistinct("genre").alias("genres"),
        F.countDistinct("artist").alias("artists")))

query("top_genres", with_ctes("""
SELECT genre, count(*) AS tracks FROM tracks WHERE genre IS NOT NULL
GROUP BY genre ORDER BY tracks DESC, genre LIMIT 20""", "tracks"))(
    lambda spark, sf: tracks(spark, sf).where(F.col("genre").isNotNull())
    .groupBy("genre").agg(F.count(F.lit(1)).alias("tracks"))
    .orderBy(F.col("tracks").desc(), F.col("genre")).limit(20))


# The cleaned catalogue itself (F1, P4, P5, F2, P3, W1, P6) -------------------------

query("clean_tracks", with_ctes("SELECT * FROM tracks", "tracks"))(
    lambda spark, sf: tracks(spark, sf))

# The chain over all three sources, hard rows included -------------------------------

query("build_catalogue", with_ctes("SELECT * FROM catalogue", "catalogue"))(
    lambda spark, sf: clean.build_catalogue(all_sources(spark, sf)))

query("dedupe_richest", with_ctes(deduped_sql(
    "union_all_src", " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in AUDIO_FEATURES) + ","), "union_all_src"))(
    lambda spark, sf: clean.dedupe_tracks(clean.union_sources(all_sources(spark, sf)), prefer="richest"))

query("catalogue_report", with_ctes(f"""
SELECT 0 AS step_no, 'input' AS step, count(*) AS rows FROM union_all_src
UNION ALL SELECT 1, 'dedupe', count(*) FROM deduped_all
UNION ALL SELECT 2, 'drop_all_null', count(*) FROM deduped_all WHERE NOT ({_ALL_NULL})
UNION ALL SELECT 3, 'tempo_filter', count(*) FROM deduped_all
  WHERE NOT ({_ALL_NULL}) AND (tempo BETWEEN 40 AND 250 OR tempo IS NULL)""", "deduped_all"))(
    lambda spark, sf: clean.cleaning_report(clean.union_sources(all_sources(spark, sf))))
