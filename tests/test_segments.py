"""Row numbers, previous rows and running sums of ordered groups against plain Python."""

import random

import pytest

from cadence.operators.segments import ordered


@pytest.mark.parametrize("parts, n, groups", [(8, 2000, 60), (8, 500, 1), (40, 300, 3), (3, 0, 1)])
def test_positions_and_previous_rows(spark, parts, n, groups):
    rnd = random.Random(n + parts)
    rows = []
    for i in range(n):  # one group holds a third of the rows, one has a NULL key
        g = "hot" if i % 3 == 0 else rnd.choice([None, *[f"g{k}" for k in range(groups)]])
        rows.append((g, rnd.choice([None, *range(50)]), i, rnd.choice(["a", "b", None]), rnd.choice([None, .5, 2.0])))
    df = spark.createDataFrame(rows, "g string, t long, id long, v string, x double").repartition(4)
    got = ordered(df, ["g"], ["t", "id"], "place", {"before": "v", "id_before": "id"}, {"total": "x"}, num_partitions=parts)
    assert got.columns == ["g", "t", "id", "v", "x", "place", "before", "id_before", "total"]
    want, last = set(), {}
    for g, t, i, v, x in sorted(rows, key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        place, before, id_before, total = last.get(g, (-1, None, None, 0.0))
        want.add((g, t, i, v, x, place + 1, before, id_before, total))
        last[g] = (place + 1, v, i, total + (x or 0.0))
    assert {tuple(r) for r in got.collect()} == want
