"""File sources for raw catalogue exports (A1-A5).

Raw track tables arrive as CSV files somewhere below a landing folder. Each
reader is one lazy ``spark.read.csv`` over the folder tree, filtered by file
name, so the files are read by all executors at once. Nothing is listed or read on the driver beyond Spark's own
file listing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from cadence.config import AUDIO_FEATURES, RENAME_MAP
from cadence.operators.clean import union_sources

log = logging.getLogger(__name__)

# Columns every track source should carry (A5).
REQUIRED_TRACK_COLUMNS = ["track_id", "track_name"] + AUDIO_FEATURES


#: Types of a raw catalogue's columns by standardised name; other columns are text (A1).
TRACK_TYPES = ({c: "double" for c in AUDIO_FEATURES}
               | {"popularity": "int", "key": "int", "mode": "int", "time_signature": "int", "duration_ms": "bigint"})


def _csv(spark: SparkSession, root: str, name_glob: str, types: dict[str, str] | None, multi_line: bool) -> DataFrame:
    """Quoted fields may hold commas and doubled quotes, and with ``multi_line`` also
    line breaks, which makes a file one split. With ``types`` nothing is inferred:
    columns are read as text, and those whose standardised name has a type are cast
    (NULL where the text is none), so all folders have the same types; a file whose
    header differs from the first one's is an error. ``source_file`` and
    ``source_row`` give every row its place."""
    df = (spark.read.option("header", True).option("inferSchema", types is None).option("enforceSchema", types is None)
          .option("recursiveFileLookup", True).option("pathGlobFilter", name_glob).option("mode", "PERMISSIVE")
          .option("multiLine", multi_line).option("quote", '"').option("escape", '"').csv(root))
    place = [F.col("_metadata.file_path").alias("source_file"), F.monotonically_increasing_id().alias("source_row")]
    if types is None:
        return df.select("*", *place)

    def typed(name: str):
        plain = name.strip().lower()
        kind = types.get(RENAME_MAP.get(plain, plain))
        return F.expr(f"try_cast(`{name}` AS {kind})").alias(name) if kind else F.col(f"`{name}`")

    return df.select(*map(typed, df.columns), *place)


def read_csv_tree(spark: SparkSession, root: str, name_glob: str = "*.csv",
                  fallback_glob: str | None = "*.csv", required: bool = True,
                  schema: str | None = None, types: dict[str, str] | None = None,
                  multi_line: bool = True) -> DataFrame | None:
    """A1 / A3: every file below ``root`` whose name matches ``name_glob``;
    when none does, any file matching ``fallback_glob``. A missing input is
    an error when ``required``; otherwise an empty frame of ``schema`` (or
    ``None`` without a schema) is returned. ``types`` (as ``TRACK_TYPES``) replaces
    the inference of types, which reads all files once more; ``multi_line`` off
    lets Spark split large files whose fields hold no line breaks."""
    for glob in [name_glob] + ([fallback_glob] if fallback_glob and fallback_glob != name_glob else []):
        try:
            return _csv(spark, root, glob, types, multi_line)
        except AnalysisException as e:  # no matching file: Spark cannot infer a schema
            log.info("no %s below %s: %s", glob, root, str(e).splitlines()[0])
    if required:
        raise FileNotFoundError(f"no CSV matching {name_glob!r} below {root}")
    if schema is not None:
        return spark.createDataFrame([], schema)
    return None


def read_tracks_and_history(spark: SparkSession, root: str, tracks_glob: str,
                            history_glob: str) -> tuple[DataFrame, DataFrame]:
    """A2: a track table and its listening history from one landing folder."""
    return (read_csv_tree(spark, root, tracks_glob, fallback_glob=None),
            read_csv_tree(spark, root, history_glob, fallback_glob=None))


def missing_columns(df: DataFrame, wanted: list[str] | None = None) -> list[str]:
    """A5: wanted columns the frame lacks (after name standardisation)."""
    from cadence.operators.clean import standardize_columns
    have = set(standardize_columns(df, parse_artist=False).columns)
    return [c for c in (wanted or REQUIRED_TRACK_COLUMNS) if c not in have]


def load_sources(readers: list[Callable[[], DataFrame | None]]) -> tuple[DataFrame, DataFrame]:
    """A4: run every reader; a failing or absent source is skipped and
    reported, no source at all is an error. Returns the standardised union
    (with ``source_priority`` = position in ``readers``) and a report
    (source, status, missing_columns)."""
    frames, report = [], []
    for i, read in enumerate(readers, start=1):
        try:
            df = read()
        except Exception as e:  # noqa: BLE001 - a bad source must not stop the others
            report.append((i, f"failed: {type(e).__name__}", None))
            continue
        if df is None:
            report.append((i, "absent", None))
            continue
        report.append((i, "loaded", ",".join(missing_columns(df)) or None))
        frames.append((i, df))
    if not frames:
        raise RuntimeError("no catalogue source could be loaded")
    union = None
    for i, df in frames:
        part = union_sources([df]).withColumn("source_priority", F.lit(i))
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    spark = frames[0][1].sparkSession
    rep = spark.createDataFrame(report, "source int, status string, missing_columns string")
    return union, rep
