"""Interaction queries: play counts, active users, the user x item matrix
and its density."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import interactions as inter
from cadence.plans.registry import query
from cadence.plans.sql import active_sql, matrix_sql, with_ctes
from cadence.sources import fixtures as fx

# The default activity limit (5 plays) removes nobody from these tables; the
# queries use 500 so the filter has work to do (FIXTURES.md 2.2).
ACTIVE_MIN = 500


def counts(spark, sf):
    return inter.play_counts(inter.standardize_interactions(fx.interactions_raw(spark, sf)))


query("play_counts", with_ctes("SELECT * FROM play_counts", "play_counts"))(counts)

query("active_users", with_ctes(active_sql(ACTIVE_MIN), "play_counts"))(
    lambda spark, sf: inter.active_users(counts(spark, sf), ACTIVE_MIN))

query("interaction_matrix", with_ctes(matrix_sql(ACTIVE_MIN), "play_counts"))(
    lambda spark, sf: inter.interaction_matrix(counts(spark, sf), ACTIVE_MIN))

query("interaction_density", with_ctes(f"""
SELECT count(DISTINCT user_idx) AS n_users, count(DISTINCT item_idx) AS n_items, count(*) AS nnz,
       round(count(*) / (count(DISTINCT user_idx) * count(DISTINCT item_idx)), 9) AS density
FROM ({matrix_sql(ACTIVE_MIN)}) m""", "play_counts"))(
    lambda spark, sf: inter.interaction_density(inter.interaction_matrix(counts(spark, sf), ACTIVE_MIN)))

del F
