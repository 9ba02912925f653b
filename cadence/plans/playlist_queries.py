"""Transition playlist queries: beam search for every seed of the catalogue
(H3, H4) and its oracle, generated SQL with one CTE per beam step."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import DEFAULTS, FALLBACK_TOP
from cadence.functions import harmonic as hf
from cadence.operators import playlist as pl
from cadence.plans.feature_queries import _knn_select, catalogue_knn
from cadence.plans.registry import query, tracks
from cadence.plans.sql import score_sql, with_ctes

N = DEFAULTS.playlist_len
B = DEFAULTS.beam_width
TOL = DEFAULTS.bpm_tolerance
POOL = 3 * N


def transition_playlist(spark, sf, n=N, beam=B):
    """Every catalogue track as a seed: pool = seed + its 3n content
    neighbours, graph inside the pool, beam search of n - 1 steps."""
    tr = tracks(spark, sf)
    seeds = tr.select(F.col("track_idx").alias("seed_idx"))
    neighbours = catalogue_knn(spark, sf, 3 * n).select("seed_idx", "rank", "track_idx")
    out = pl.transition_playlists(seeds, neighbours, tr, n, beam, TOL, DEFAULTS.energy_arc)
    return out.select(F.col("pool_id").alias("seed_idx"), "order", "track_idx", "transition_score")


def _beam_sql(n: int = N, beam: int = B) -> str:
    arc = hf.energy_arc_bonus_sql("s.plen", "s.esum", "c.dst_energy", DEFAULTS.energy_arc)
    parts = [f"""
knn AS ({_knn_select(3 * n, 0.0)}),
pool AS (SELECT track_idx AS pool_id, track_idx, 0 AS pos FROM vibe
         UNION ALL SELECT seed_idx AS pool_id, track_idx, rank AS pos FROM knn),
pf AS (SELECT p.pool_id, p.track_idx, p.pos, t.key, t.mode, t.tempo, t.energy, t.valence, t.code
       FROM pool p JOIN scored_tracks t ON t.track_idx = p.track_idx),
pe AS (SELECT * FROM (
         SELECT a.pool_id, a.track_idx AS src, b.track_idx AS dst, b.pos AS dst_pos,
                b.energy AS dst_energy, {score_sql('a', 'b', TOL)} AS score_e
         FROM pf a JOIN pf b ON a.pool_id = b.pool_id AND a.track_idx <> b.track_idx
          AND {hf.bpm_compatible_sql('a.tempo', 'b.tempo', 2 * TOL)}) e WHERE score_e >= 0.5e0),
pfb AS (SELECT a.pool_id, a.track_idx AS src, b.track_idx AS dst, b.pos AS dst_pos,
               b.energy AS dst_energy, {score_sql('a', 'b', 2 * TOL)} * 0.5e0 AS score_e
        FROM pf a JOIN pf b ON a.pool_id = b.pool_id AND a.track_idx <> b.track_idx
        WHERE NOT EXISTS (SELECT 1 FROM pe WHERE pe.pool_id = a.pool_id AND pe.src = a.track_idx)),
s0 AS (SELECT f.pool_id, 1 AS brank, [f.track_idx] AS path, f.track_idx AS last, 0e0 AS score,
              f.energy AS esum, 1 AS plen, least({n}, z.sz) AS n_pool
       FROM pf f JOIN (SELECT pool_id, count(*) AS sz FROM pf GROUP BY pool_id) z ON z.pool_id = f.pool_id
       WHERE f.pos = 0)"""]
    for t in range(1, n):
        p = f"s{t - 1}"
        parts.append(f"""
c{t} AS (
  SELECT s.pool_id, s.brank, s.path, s.esum, s.plen, s.n_pool, s.score, e.dst, e.dst_energy,
         e.score_e, e.dst_pos AS nb
  FROM {p} s JOIN pe e ON e.pool_id = s.pool_id AND e.src = s.last
  WHERE s.plen < s.n_pool AND NOT list_contains(s.path, e.dst)
  UNION ALL
  SELECT * FROM (
    SELECT s.pool_id, s.brank, s.path, s.esum, s.plen, s.n_pool, s.score, f.dst, f.dst_energy, f.score_e,
           row_number() OVER (PARTITION BY s.pool_id, s.brank ORDER BY f.score_e DESC, f.dst_pos) AS nb
    FROM {p} s JOIN pfb f ON f.pool_id = s.pool_id AND f.src = s.last
    WHERE s.plen < s.n_pool AND NOT list_contains(s.path, f.dst)) x WHERE nb <= {FALLBACK_TOP}),
r{t} AS (SELECT c.*, (c.score + c.score_e) + {arc.replace('s.plen', 'c.plen').replace('s.esum', 'c.esum')} AS ns
         FROM c{t} c),
q{t} AS (SELECT *, row_number() OVER (PARTITION BY pool_id ORDER BY ns DESC, brank, nb) AS nr FROM r{t}),
s{t} AS (SELECT pool_id, nr AS brank, list_append(path, dst) AS path, dst AS last, ns AS score,
                esum + dst_energy AS esum, plen + 1 AS plen, n_pool FROM q{t} WHERE nr <= {beam}
         UNION ALL SELECT * FROM {p} WHERE pool_id NOT IN (SELECT pool_id FROM c{t}))""")
    last = f"s{n - 1}"
    final = f"""
SELECT pool_id AS seed_idx, CAST(ord AS INTEGER) AS "order", track_idx,
       CASE WHEN ord = 0 THEN NULL ELSE {hf.transition_score_sql(
           {"code": "lag(code) OVER w", "tempo": "lag(tempo) OVER w", "energy": "lag(energy) OVER w",
            "valence": "lag(valence) OVER w"},
           {"code": "code", "tempo": "tempo", "energy": "energy", "valence": "valence"}, TOL)} END
       AS transition_score
FROM (SELECT b.pool_id, u.ord, u.track_idx, t.code, t.tempo, t.energy, t.valence
      FROM (SELECT pool_id, unnest(path) AS track_idx, generate_subscripts(path, 1) - 1 AS ord
            FROM {last} WHERE brank = 1) u
      JOIN (SELECT pool_id FROM {last} WHERE brank = 1) b ON b.pool_id = u.pool_id
      JOIN scored_tracks t ON t.track_idx = u.track_idx) x
WINDOW w AS (PARTITION BY pool_id ORDER BY ord)"""
    body = "SELECT * FROM (WITH " + ",".join(parts) + final + ") z"
    return with_ctes(body, "vibe", "scored_tracks")


query("transition_playlist", _beam_sql())(transition_playlist)


# Energy by position of every generated playlist, with the running mean
# the arc bonus compares against.
_ARC_W = "(PARTITION BY z.seed_idx ORDER BY z.\"order\" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
query("playlist_energy_arc", with_ctes(f"""
SELECT z.seed_idx, z."order", z.track_idx, t.energy,
       round(avg(t.energy) OVER {_ARC_W}, 9) AS running_energy
FROM ({_beam_sql()}) z JOIN scored_tracks t ON t.track_idx = z.track_idx""", "scored_tracks"))(
    lambda spark, sf: energy_arc(transition_playlist(spark, sf), tracks(spark, sf)))


def energy_arc(rows, tr):
    from pyspark.sql import Window
    w = Window.partitionBy("seed_idx").orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(tr.select("track_idx", "energy"), "track_idx").select(
        "seed_idx", "order", "track_idx", "energy",
        F.round(F.avg("energy").over(w), 9).alias("running_energy"))
