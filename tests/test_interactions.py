"""The user x item matrix against a plain count; its input is computed once."""

from pyspark.sql import functions as F

from cadence.operators import interactions as inter


def test_matrix_reads_the_counts_once(spark):
    rows = [(None if u == 3 else f"U{u}", None if i == 4 else f"T{i}", u + i) for u in range(8) for i in range(0, 12, 1 + u % 2)]
    rows += rows[:10]  # keys that repeat
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(n):
        seen.add(1)
        return n

    counts = spark.createDataFrame(rows, "user_id string, track_id string, n long").select(
        "user_id", "track_id", noted.asNondeterministic()("n").alias("play_count"))
    got = inter.interaction_matrix(counts, 80).collect()
    total = {}
    for u, _, n in rows:
        total[u] = total.get(u, 0) + n
    active = sorted(u for u, n in total.items() if u is not None and n >= 80)
    cells = {}
    for u, t, n in rows:
        if u in active:
            cells[u, t] = cells.get((u, t), 0) + n
    items = sorted({t for _, t in cells if t is not None})
    assert sorted(map(tuple, got)) == sorted(
        (active.index(u), items.index(t), u, t, float(n)) for (u, t), n in cells.items() if t is not None)
    assert 0 < len(active) < len(total) - 1
    assert seen.value == len(rows)
