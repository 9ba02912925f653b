"""Feature matrices: min-max vibe vectors (P7), z-scores (P8), categorical
encoding (P9), the full matrix (P10) and global column statistics (G5).

Global statistics are one aggregation returning one row; that row is the only
thing brought to the driver and it is applied as literals, so the scan of the
big table stays a single narrow projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.config import CATEGORICAL_FEATURES, CONTINUOUS_FEATURES, VIBE_FEATURES

ID_COLUMNS = ["track_id", "track_idx"]
MAX_CATEGORIES = 256


def column_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """min / max / mean / population stddev per column, long form."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"),
                 F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__min").alias("min"),
                 F.col(f"{c}__max").alias("max"), F.col(f"{c}__mean").alias("mean"),
                 F.col(f"{c}__std").alias("stddev"))
        for c in cols])).alias("s")).select("s.*")


def _ids(df: DataFrame) -> list[str]:
    return [c for c in ID_COLUMNS if c in df.columns]


def vibe_matrix(tracks: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Scale each vibe feature to [0, 1] by the data min / max; a constant
    column scales to 0.0."""
    present = [c for c in (features or VIBE_FEATURES) if c in tracks.columns]
    st = tracks.agg(*[F.min(c).cast("double").alias(f"mn_{c}") for c in present],
                    *[F.max(c).cast("double").alias(f"mx_{c}") for c in present]).first()
    cols = []
    for c in present:
        mn, mx = st[f"mn_{c}"], st[f"mx_{c}"]
        if mn is None or mx is None or mx == mn:
            cols.append(F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.lit(0.0)).alias(c))
        else:
            cols.append(((F.col(c).cast("double") - F.lit(mn)) / F.lit(mx - mn)).alias(c))
    return tracks.select(*_ids(tracks), *cols)


def zscore_columns(tracks: DataFrame, features: list[str] | None = None) -> list:
    """(x - mean) / population stddev per feature; zero stddev -> 0.0."""
    present = [c for c in (features or CONTINUOUS_FEATURES) if c in tracks.columns]
    st = tracks.agg(*[F.avg(c).alias(f"mu_{c}") for c in present],
                    *[F.stddev_pop(c).alias(f"sd_{c}") for c in present]).first()
    cols = []
    for c in present:
        mu, sd = st[f"mu_{c}"], st[f"sd_{c}"]
        if mu is None or not sd:
            cols.append(F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.lit(0.0)).alias(c))
        else:
            cols.append(((F.col(c).cast("double") - F.lit(mu)) / F.lit(sd)).alias(c))
    return cols


def zscore_features(tracks: DataFrame, features: list[str] | None = None) -> DataFrame:
    return tracks.select(*_ids(tracks), *zscore_columns(tracks, features))


def category_levels(tracks: DataFrame, cols: list[str]) -> dict[str, list]:
    """Sorted distinct values of each categorical column (bounded vocabularies)."""
    levels = {}
    for c in cols:
        vals = [r[0] for r in tracks.select(c).where(F.col(c).isNotNull()).distinct()
                .limit(MAX_CATEGORIES + 1).collect()]
        if len(vals) > MAX_CATEGORIES:
            raise ValueError(f"{c} has more than {MAX_CATEGORIES} levels; not categorical")
        levels[c] = sorted(vals)
    return levels


def _level_name(c: str, v) -> str:
    if isinstance(v, float) and v.is_integer():
        v = int(v)
    return f"{c}_{v}"


def onehot_columns(tracks: DataFrame, features: list[str] | None = None,
                   encoding: str = "onehot") -> list:
    """One 0/1 column per level of key / mode / time_signature (the
    documented intent). ``encoding="passthrough"`` keeps the raw values, which
    is what the reference's code does."""
    present = [c for c in (features or CATEGORICAL_FEATURES) if c in tracks.columns]
    if encoding == "passthrough":
        return [F.col(c) for c in present]
    levels = category_levels(tracks, present)
    return [(F.col(c) == F.lit(v)).cast("int").alias(_level_name(c, v))
            for c in present for v in levels[c]]


def one_hot_features(tracks: DataFrame, features: list[str] | None = None,
                     encoding: str = "onehot") -> DataFrame:
    return tracks.select(*_ids(tracks), *onehot_columns(tracks, features, encoding))


def full_feature_matrix(tracks: DataFrame, encoding: str = "onehot") -> DataFrame:
    """z-scored continuous features next to the encoded categoricals: one
    projection of the rows, so the input is scanned once."""
    return tracks.select(*_ids(tracks), *zscore_columns(tracks),
                         *onehot_columns(tracks, encoding=encoding))
