"""Catalogue cleaning: column standardisation (P1, P2), artist parsing (P3),
union of sources (U1), first-wins dedupe (W2), null handling (F1, P4),
clamping (P5), tempo filter (F2), dense track index (W1), release year (P6),
temporal split (F3) and the cleaning report (G12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.config import (AUDIO_FEATURES, DEFAULT_YEAR, DEFAULTS, RENAME_MAP, UNIT_FEATURES,
                            YEAR_COLUMNS)
from cadence.functions.text import clean_artist, infer_year
from cadence.operators.index import dense_index
from cadence.operators.selection import middle_values
from cadence.session import cut_lineage, stored


# ---------------------------------------------------------------------------
# names
# ---------------------------------------------------------------------------

def standardize_columns(df: DataFrame, rename_map: dict | None = None,
                        parse_artist: bool = True) -> DataFrame:
    """Lower-case and trim names, rename by the synonym map. When several
    source columns land on one name they are coalesced in map order."""
    rename_map = rename_map or RENAME_MAP
    order = list(rename_map)
    targets: dict[str, list[str]] = {}
    for c in df.columns:
        norm = c.strip().lower()
        tgt = rename_map.get(norm, norm)
        targets.setdefault(tgt, []).append(c)

    def rank(src: str) -> int:
        n = src.strip().lower()
        return order.index(n) if n in order else -1

    out = []
    for tgt, srcs in targets.items():
        srcs = sorted(srcs, key=rank)
        expr = F.col(f"`{srcs[0]}`") if len(srcs) == 1 else F.coalesce(*[F.col(f"`{s}`") for s in srcs])
        if tgt == "artist" and parse_artist:
            expr = clean_artist(expr)
        out.append(expr.alias(tgt))
    return df.select(*out)


def classify_interaction_columns(columns: list[str]) -> dict[str, str]:
    """Map interaction columns to user_id / track_id / play_count / timestamp
    by substring (user -> track|song -> count|play -> date|time). An exact
    name wins; otherwise the first matching column does."""
    rules = [("user_id", ("user",)), ("track_id", ("track", "song")),
             ("play_count", ("count", "play")), ("timestamp", ("date", "time"))]
    chosen: dict[str, str] = {}
    for tgt, _ in rules:
        if tgt in columns:
            chosen[tgt] = tgt
    for c in columns:
        low = c.lower()
        for tgt, subs in rules:
            if any(s in low for s in subs):
                if tgt not in chosen and c not in chosen.values():
                    chosen[tgt] = c
                break
    return {src: tgt for tgt, src in chosen.items()}


# ---------------------------------------------------------------------------
# Union and dedupe
# ---------------------------------------------------------------------------

def union_sources(sources: list[DataFrame]) -> DataFrame:
    """Standardise each source, tag ``source_priority`` (1-based, list order)
    and keep ``source_row``; missing columns become NULL."""
    out = None
    for i, src in enumerate(sources, start=1):
        s = standardize_columns(src)
        if "source_row" not in s.columns:
            s = s.withColumn("source_row", F.lit(None).cast("bigint"))
        s = s.withColumn("source_priority", F.lit(i))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    return out


def dedupe_key(df: DataFrame) -> list:
    """Dedupe key: track_id, or (track_name, artist) when the id is NULL; a
    column that the frame lacks counts as NULL."""
    def column(name: str):
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    no_id = column("track_id").isNull()
    return [column("track_id").alias("_k_id"),
            F.when(no_id, column("track_name")).alias("_k_name"),
            F.when(no_id, column("artist")).alias("_k_artist")]


def dedupe_tracks(df: DataFrame, order: list[str] | None = None, prefer: str = "first") -> DataFrame:
    """First-wins dedupe; ``prefer="richest"`` lets the row with the most audio
    features win before the order counts. The winner per key is the row with the smallest
    ``order`` tuple (default: source_priority, source_file, source_row,
    track_id), and of equal tuples the row with the smallest hash, so the winner
    does not depend on the partitioning; it is chosen with ``min_by``, which pre-aggregates on the map side, so a key
    holding a large share of the rows never lands whole in one task."""
    order = order or [c for c in ["source_priority", "source_file", "source_row", "track_id"] if c in df.columns]
    cols = df.columns
    if prefer not in ("first", "richest"):
        raise ValueError(f"prefer is first or richest, not {prefer!r}")
    missing = F.lit(0)
    if prefer == "richest":
        missing = sum([F.col(c).isNull().cast("int") for c in AUDIO_FEATURES if c in cols], F.lit(0))
    keyed = df.select(*dedupe_key(df), F.struct(*cols).alias("_row"),
                      F.struct(missing.alias("_missing"), *order, F.xxhash64(*cols).alias("_hash")).alias("_ord"))
    return (keyed.groupBy("_k_id", "_k_name", "_k_artist")
            .agg(F.min_by("_row", "_ord").alias("_row"))
            .select("_row.*"))


# ---------------------------------------------------------------------------
# Audio features
# ---------------------------------------------------------------------------

def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact median (mean of the two middle values) of each column, NULLs
    ignored, found by counting bits of the values (``selection``)."""
    return {c: None if m is None else (m[0] + m[1]) / 2.0 for c, m in middle_values(df, cols).items()}


def median_frame(df: DataFrame, cols: list[str]) -> DataFrame:
    """The same medians as rows (feature, median)."""
    found = exact_medians(df, cols)
    return df.sparkSession.createDataFrame([(c, m) for c, m in found.items() if m is not None],
                                           "feature string, median double")


def _nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({
        c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c))
        for c in cols if types.get(c) in ("double", "float")})


def clean_audio_features(df: DataFrame, features: list[str] | None = None,
                         tempo_range: tuple[float, float] = (40.0, 250.0)) -> DataFrame:
    """Drop rows whose features are all NULL (F1), fill NULLs with the exact
    column median (P4), clamp the unit features to [0, 1] (P5) and keep tempo
    in range or NULL (F2)."""
    present = [c for c in (features or AUDIO_FEATURES) if c in df.columns]
    if not present:
        return df
    df = _nan_to_null(df, present)
    df = df.dropna(how="all", subset=present)
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in present]).first()
    with_nulls = [c for c in present if nulls[c]]
    medians = exact_medians(df.select(*with_nulls), with_nulls)
    types = dict(df.dtypes)
    fills = {}
    for c, m in medians.items():
        if m is None:
            continue
        fill = F.lit(float(m))
        if types[c] not in ("double", "float"):
            fill = fill.cast(types[c])
        fills[c] = F.coalesce(F.col(c), fill)
    if fills:
        df = df.withColumns(fills)
    clamps = {c: F.when(F.col(c).isNull(), F.lit(None)).otherwise(
        F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0)))
        for c in UNIT_FEATURES if c in df.columns}
    if clamps:
        df = df.withColumns(clamps)
    if "tempo" in df.columns:
        lo, hi = tempo_range
        df = df.where(F.col("tempo").between(lo, hi) | F.col("tempo").isNull())
    return df


# ---------------------------------------------------------------------------
# Catalogue build, year, split
# ---------------------------------------------------------------------------

def with_year(df: DataFrame, default: int = DEFAULT_YEAR) -> DataFrame:
    return df.withColumn("year", infer_year(YEAR_COLUMNS, set(df.columns), default))


def build_tracks(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    """Standardise, dedupe, clean, index by track_id and add the year."""
    df = standardize_columns(raw)
    if "artist_raw" in df.columns and "artist" not in df.columns:
        df = df.withColumn("artist", clean_artist(F.col("artist_raw"))).drop("artist_raw")
    if dedupe and "track_id" in df.columns:
        df = stored(dedupe_tracks(df))  # read by the counts of NULLs, the medians and the index
    df = clean_audio_features(df)
    df = dense_index(df, ["track_id"], "track_idx")
    return with_year(df)


def build_catalogue(sources: list[DataFrame], prefer: str = "first") -> DataFrame:
    """The whole chain over all sources: union, dedupe, clean, index, year and
    split. Rows without an id are indexed first, by name and artist."""
    df = clean_audio_features(cut_lineage(dedupe_tracks(union_sources(sources), prefer=prefer)))
    df = dense_index(df, ["track_id", "track_name", "artist"], "track_idx")
    return temporal_split(with_year(df))


def temporal_split(df: DataFrame, train_years=DEFAULTS.train_years,
                   val_years=DEFAULTS.val_years, test_years=DEFAULTS.test_years,
                   leftover: str = "train") -> DataFrame:
    """Add ``split``. Years outside every list (and NULL) go to train, as in
    the reference; ``leftover="drop"`` removes them instead."""
    y = F.col("year")
    split = (F.when(y.isin(list(val_years)), F.lit("val"))
             .when(y.isin(list(test_years)), F.lit("test"))
             .when(y.isin(list(train_years)), F.lit("train")))
    if leftover == "train":
        split = split.otherwise(F.lit("train"))
    out = df.withColumn("split", split)
    return out.where(F.col("split").isNotNull()) if leftover == "drop" else out


def cleaning_report(raw: DataFrame) -> DataFrame:
    """Row counts after each cleaning step (G12), as (step_no, step, rows)."""
    df = standardize_columns(raw)
    present = [c for c in AUDIO_FEATURES if c in df.columns]
    deduped = dedupe_tracks(df) if "track_id" in df.columns else df
    f1 = _nan_to_null(deduped, present).dropna(how="all", subset=present)
    cleaned = clean_audio_features(deduped)
    steps = [("input", df), ("dedupe", deduped), ("drop_all_null", f1), ("tempo_filter", cleaned)]
    out = None
    for i, (name, d) in enumerate(steps):
        part = d.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col("rows"))
        out = part if out is None else out.unionByName(part)
    return out
