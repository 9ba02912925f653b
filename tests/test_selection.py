"""Middle values by counting bits against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cadence.operators import clean
from cadence.operators.selection import middle_values


def _columns():
    rnd = random.Random(8)
    return {
        "normal": [rnd.gauss(0, 1) for _ in range(1001)],
        "even": [rnd.random() for _ in range(1000)] + [None],
        "ties": [rnd.choice([0.25, 0.5]) for _ in range(700)] + [0.5] * 301,
        "signs": [rnd.choice([-1.5, -0.0, 0.0, 1e-300, -1e300, float("inf")]) for _ in range(998)] + [None, float("nan"), 3.0],
        "whole": [rnd.randint(-5, 5) for _ in range(1001)],
        "one": [None] * 1000 + [7.0], "none": [None] * 1001,
    }


@pytest.mark.parametrize("parts", [1, 7])
def test_middle_values(spark, parts):
    columns = _columns()
    rows = [tuple(c[i] if i < len(c) else None for c in columns.values()) for i in range(1001)]
    kinds = ", ".join(f"{n} {'long' if n == 'whole' else 'double'}" for n in columns)
    df = spark.createDataFrame(rows, kinds).repartition(parts)
    got = middle_values(df, list(columns))
    for name, values in columns.items():
        kept = sorted(float(v) for v in values if v is not None and not math.isnan(v))
        want = (kept[(len(kept) - 1) // 2], kept[len(kept) // 2]) if kept else None
        assert got[name] == want, name
    assert middle_values(df.limit(0), ["even"]) == {"even": None}


def test_richest_row_wins(spark):
    rows = [("a", 1, 1, None, 1.0), ("a", 2, 1, 0.5, 1.0), ("a", 2, 2, 0.7, 1.0), ("b", 1, 1, None, None), ("b", 1, 2, None, None)]
    df = spark.createDataFrame(rows, "track_id string, source_priority int, source_row int, energy double, valence double")
    first = {r.track_id: r.energy for r in clean.dedupe_tracks(df).collect()}
    rich = {r.track_id: (r.energy, r.source_row) for r in clean.dedupe_tracks(df, prefer="richest").collect()}
    assert first == {"a": None, "b": None} and rich == {"a": (0.5, 1), "b": (None, 1)}
    with pytest.raises(ValueError):
        clean.dedupe_tracks(df, prefer="latest")


def test_hard_rows_are_there(spark, sf):
    """The third source holds repeated ids, NULL ids, rows without features and zero vectors."""
    from cadence.config import VIBE_FEATURES
    from cadence.sources import fixtures as fx
    c = fx.tracks_raw_c(spark, sf)
    ids = c.where(F.col("track_id").isNotNull()).groupBy("track_id").count()
    assert ids.where("count > 1").count() > 0 and c.where("track_id IS NULL").count() > 0
    assert c.where(" AND ".join(f"{f} IS NULL" for f in VIBE_FEATURES)).count() > 0
    assert c.where(" AND ".join(f"{f} = 0" for f in VIBE_FEATURES)).count() > 0
    from cadence.plans.catalog import QUERIES
    steps = {r.step: r.rows for r in QUERIES["catalogue_report"](spark, sf).collect()}
    assert steps["input"] > steps["dedupe"] > steps["drop_all_null"] > steps["tempo_filter"]
