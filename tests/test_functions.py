"""Scalar expressions: Camelot codes and compatibility, BPM tolerance,
transition score, artist parsing, year inference."""

import pytest
from pyspark.sql import functions as F

from cadence.functions import harmonic as hf
from cadence.functions import text as tx


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_known_camelot_codes(spark):
    data = [(0, 1), (9, 0), (7, 1), (4, 0), (11, 1), (None, 1), (12, 0), (3, 2)]
    got = _one(spark, hf.camelot(F.col("k"), F.col("m")), data, "k int, m int")
    assert got == ["8B", "8A", "9B", "9A", "1B", None, None, None]


@pytest.mark.parametrize("a,b,ok", [
    ("8B", "8B", True),    # same
    ("8B", "9B", True),    # adjacent
    ("8B", "7B", True),
    ("12A", "1A", True),   # wrap-around on the wheel
    ("8B", "8A", True),    # relative major / minor
    ("8B", "9A", False),   # adjacent number, other letter
    ("8B", "3B", False),   # incompatible
    ("8B", None, False),   # NULL never compatible
])
def test_camelot_compatibility(spark, a, b, ok):
    got = _one(spark, hf.camelot_compatible(F.col("a"), F.col("b")), [(a, b)], "a string, b string")
    assert got == [ok]


@pytest.mark.parametrize("ta,tb,ok", [
    (120.0, 124.0, True), (120.0, 126.0, False), (120.0, 60.0, True),
    (60.0, 121.0, True), (120.0, 243.0, True), (120.0, 250.0, False), (120.0, 90.0, False), (None, 120.0, False)])
def test_bpm_compatibility(spark, ta, tb, ok):
    got = _one(spark, hf.bpm_compatible(F.col("a"), F.col("b"), 5.0), [(ta, tb)], "a double, b double")
    assert got == [ok]


def test_transition_score_range_and_identity(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for _ in range(200):
        rows.append((rnd.randint(0, 11), rnd.randint(0, 1), rnd.uniform(60, 200), rnd.random(), rnd.random(),
                     rnd.randint(0, 11), rnd.randint(0, 1), rnd.uniform(60, 200), rnd.random(), rnd.random()))
    df = spark.createDataFrame(rows, "k1 int, m1 int, t1 double, e1 double, v1 double, "
                                     "k2 int, m2 int, t2 double, e2 double, v2 double")
    a = {"code": hf.camelot(F.col("k1"), F.col("m1")), "tempo": F.col("t1"), "energy": F.col("e1"),
         "valence": F.col("v1")}
    b = {"code": hf.camelot(F.col("k2"), F.col("m2")), "tempo": F.col("t2"), "energy": F.col("e2"),
         "valence": F.col("v2")}
    s = [r[0] for r in df.select(hf.transition_score(a, b, 5.0)).collect()]
    assert all(0.0 <= x <= 1.0 for x in s)
    same = [r[0] for r in df.select(hf.transition_score(a, a, 5.0)).collect()]
    assert all(x == 1.0 for x in same)


def test_clean_artist(spark):
    data = [("['A', 'B']",), ('["Céline Dion"]',), ("[Solo]",), ("  plain  ",), (None,), ("[]",)]
    got = _one(spark, tx.clean_artist(F.col("a")), data, "a string")
    assert got == ["A, B", "Céline Dion", "Solo", "plain", None, ""]


def test_infer_year(spark):
    df = spark.createDataFrame([("2001-05-01", None), (None, "1999"), ("bad", None)],
                               "release_date string, year string")
    got = [r[0] for r in df.select(tx.infer_year(["release_date", "year"], set(df.columns))).collect()]
    assert got == [2001, 1999, None]
    got = [r[0] for r in df.select(tx.infer_year(["nope"], set(df.columns))).collect()]
    assert got == [2018, 2018, 2018]
