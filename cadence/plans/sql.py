"""Oracle SQL: named CTEs with dependencies, assembled per query.

Each CTE mirrors one DataFrame step of the Spark side; ``with_ctes`` pulls in
the transitive dependencies in order so every oracle is one statement over
the pre-registered base tables."""

from __future__ import annotations

from cadence.config import AUDIO_FEATURES, CONTINUOUS_FEATURES, UNIT_FEATURES, VIBE_FEATURES
from cadence.functions.text import clean_artist_sql
from cadence.sources import fixtures as fx

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(final: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1].strip()}\n)" for n in order)
    return f"WITH {parts}\n{final}"


DOUBLE_FEATURES = [c for c in AUDIO_FEATURES if c in CONTINUOUS_FEATURES and c != "duration_ms"]


def median_sql(src: str, c: str) -> str:
    return (f"(SELECT (min(v) + max(v)) / 2e0 FROM (SELECT {c} AS v, "
            f"row_number() OVER (ORDER BY {c}) - 1 AS rn, count(*) OVER () AS n "
            f"FROM {src} WHERE {c} IS NOT NULL) m WHERE rn = (n - 1) // 2 OR rn = n // 2)")


def year_sql(c: str) -> str:
    y = f"regexp_extract(CAST({c} AS VARCHAR), '^\\s*(\\d{{4}})', 1)"
    return f"(CASE WHEN {y} = '' THEN NULL ELSE CAST({y} AS INTEGER) END)"


cte("tracks_raw", [], fx.TRACKS_RAW_SQL)
cte("tracks_raw_b", [], fx.TRACKS_RAW_B_SQL)
cte("interactions_raw", [], fx.INTERACTIONS_RAW_SQL)
cte("playlist_items", [], fx.PLAYLIST_ITEMS_SQL)
cte("event_items", [], fx.EVENT_ITEMS_SQL)

_ALL_NULL = " AND ".join(f"{c} IS NULL" for c in AUDIO_FEATURES)
cte("tracks_f1", ["tracks_raw"], f"SELECT * FROM tracks_raw WHERE NOT ({_ALL_NULL})")

_FILLED = ",\n".join(
    f"coalesce({c}, {median_sql('tracks_f1', c)}) AS {c}" if c in DOUBLE_FEATURES else c
    for c in AUDIO_FEATURES)
_CLAMPED = ",\n".join(
    f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, 0e0), 1e0) END AS {c}"
    if c in UNIT_FEATURES else c for c in AUDIO_FEATURES)

cte("tracks_p4", ["tracks_f1"], f"""
SELECT track_id, track_name, artist_raw, genre, popularity, release_date,
{_FILLED}
FROM tracks_f1""")

cte("tracks_clean", ["tracks_p4"], f"""
SELECT track_id, track_name, {clean_artist_sql('artist_raw')} AS artist, genre, popularity,
       release_date,
{_CLAMPED}
FROM tracks_p4
WHERE tempo BETWEEN 40 AND 250 OR tempo IS NULL""")

cte("tracks", ["tracks_clean"], f"""
SELECT *, CAST(row_number() OVER (ORDER BY track_id) - 1 AS BIGINT) AS track_idx,
       {year_sql('release_date')} AS year
FROM tracks_clean""")

_VIBE_MINMAX = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in VIBE_FEATURES)
_VIBE_COLS = ",\n".join(
    f"CASE WHEN s.mx_{c} = s.mn_{c} THEN 0e0 ELSE (t.{c} - s.mn_{c}) / (s.mx_{c} - s.mn_{c}) END AS {c}"
    for c in VIBE_FEATURES)
cte("vibe", ["tracks"], f"""
SELECT t.track_id, t.track_idx,
{_VIBE_COLS}
FROM tracks t, (SELECT {_VIBE_MINMAX} FROM tracks) s""")

# ---------------------------------------------------------------------------
# multi-source catalogue
# ---------------------------------------------------------------------------

_FEATS = ", ".join(AUDIO_FEATURES)
cte("union_src", ["tracks_raw", "tracks_raw_b"], f"""
SELECT track_id, track_name, {clean_artist_sql('artist_raw')} AS artist, genre,
       CAST(NULL AS VARCHAR) AS subgenre, popularity, {_FEATS}, release_date,
       CAST(NULL AS BIGINT) AS source_row, 1 AS source_priority
FROM tracks_raw
UNION ALL
SELECT id AS track_id, name AS track_name, {clean_artist_sql('artists')} AS artist,
       CAST(NULL AS VARCHAR) AS genre, playlist_subgenre AS subgenre, popularity, {_FEATS},
       release_date, source_row, 2 AS source_priority
FROM tracks_raw_b""")

cte("tracks_raw_c", [], fx.TRACKS_RAW_C_SQL)

cte("union_all_src", ["union_src", "tracks_raw_c"], f"""
SELECT * FROM union_src
UNION ALL
SELECT track_id, track_name, {clean_artist_sql('artists')} AS artist, genre, CAST(NULL AS VARCHAR) AS subgenre,
       popularity, {_FEATS}, release_date, source_row, 3 AS source_priority
FROM tracks_raw_c""")


def deduped_sql(src: str, first: str = "") -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY track_id, CASE WHEN track_id IS NULL THEN track_name END,
                   CASE WHEN track_id IS NULL THEN artist END
      ORDER BY {first} source_priority, source_row NULLS FIRST, track_id NULLS FIRST) AS rn
  FROM {src}) d
WHERE rn = 1"""


cte("deduped_all", ["union_all_src"], deduped_sql("union_all_src"))
cte("all_f1", ["deduped_all"], f"SELECT * FROM deduped_all WHERE NOT ({_ALL_NULL})")
cte("all_p4", ["all_f1"], f"""
SELECT * EXCLUDE ({_FEATS}), {_FILLED.replace("tracks_f1", "all_f1")}
FROM all_f1""")
cte("catalogue", ["all_p4"], f"""
SELECT * EXCLUDE ({_FEATS}, yr), {_CLAMPED}, yr AS year,
       CASE WHEN yr IN (2021) THEN 'val' WHEN yr IN (2022) THEN 'test' ELSE 'train' END AS split,
       CAST(row_number() OVER (ORDER BY track_id NULLS FIRST, track_name NULLS FIRST, artist NULLS FIRST) - 1 AS BIGINT)
         AS track_idx
FROM (SELECT *, {year_sql('release_date')} AS yr FROM all_p4) y
WHERE tempo BETWEEN 40 AND 250 OR tempo IS NULL""")

cte("deduped", ["union_src"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY track_id, CASE WHEN track_id IS NULL THEN track_name END,
                   CASE WHEN track_id IS NULL THEN artist END
      ORDER BY source_priority, source_row NULLS FIRST, track_id NULLS FIRST) AS rn
  FROM union_src) d
WHERE rn = 1""")

# ---------------------------------------------------------------------------
# histories and similarity
# ---------------------------------------------------------------------------

cte("hist", ["interactions_raw", "vibe"], """
SELECT DISTINCT i.user_id, v.* FROM interactions_raw i JOIN vibe v ON v.track_id = i.track_id""")

cte("tracks_heard", ["interactions_raw", "tracks"], """
SELECT DISTINCT i.user_id, i.track_id FROM interactions_raw i JOIN tracks t ON t.track_id = i.track_id""")

cte("req", ["interactions_raw", "tracks"], """
SELECT user_id, track_idx AS seed_idx FROM (
  SELECT c.user_id, t.track_idx, row_number() OVER (PARTITION BY c.user_id ORDER BY c.n DESC, c.track_id) AS rn
  FROM (SELECT user_id, track_id, sum(play_count) AS n FROM interactions_raw GROUP BY user_id, track_id) c
  JOIN tracks t ON t.track_id = c.track_id) r
WHERE rn = 1""")

cte("profile", ["hist"], "SELECT user_id, count(*) AS n_items, "
    + ", ".join(f"avg({c}) AS {c}" for c in VIBE_FEATURES) + " FROM hist GROUP BY user_id")

# ---------------------------------------------------------------------------
# harmonic
# ---------------------------------------------------------------------------

from cadence.functions import harmonic as _hf  # noqa: E402

cte("scored_tracks", ["tracks"], f"""
SELECT track_idx, track_id, key, mode, tempo, energy, valence,
       {_hf.camelot_sql('key', 'mode')} AS code
FROM tracks""")


def score_sql(a: str, b: str, tol: float = 5.0) -> str:
    return _hf.transition_score_sql(
        {"code": f"{a}.code", "tempo": f"{a}.tempo", "energy": f"{a}.energy", "valence": f"{a}.valence"},
        {"code": f"{b}.code", "tempo": f"{b}.tempo", "energy": f"{b}.energy", "valence": f"{b}.valence"},
        tol)


cte("graph", ["scored_tracks"], f"""
SELECT src, dst, score FROM (
  SELECT a.track_idx AS src, b.track_idx AS dst, {score_sql('a', 'b')} AS score
  FROM scored_tracks a JOIN scored_tracks b
    ON a.track_idx <> b.track_idx AND {_hf.bpm_compatible_sql('a.tempo', 'b.tempo', 10.0)}) e
WHERE score >= 0.5e0""")

# ---------------------------------------------------------------------------
# interactions
# ---------------------------------------------------------------------------

cte("play_counts", ["interactions_raw"], """
SELECT user_id, track_id, CAST(coalesce(sum(play_count), 0) AS BIGINT) AS play_count
FROM interactions_raw WHERE user_id IS NOT NULL AND track_id IS NOT NULL
GROUP BY user_id, track_id""")


def active_sql(min_plays: int) -> str:
    return (f"SELECT user_id, CAST(sum(play_count) AS BIGINT) AS total_plays FROM play_counts "
            f"GROUP BY user_id HAVING sum(play_count) >= {min_plays}")


def matrix_sql(min_plays: int) -> str:
    return f"""
SELECT CAST(u.user_idx AS BIGINT) AS user_idx, CAST(i.item_idx AS BIGINT) AS item_idx,
       c.user_id, c.track_id, CAST(c.play_count AS FLOAT) AS value
FROM (SELECT * FROM play_counts WHERE user_id IN (SELECT user_id FROM ({active_sql(min_plays)}) a)) c
JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM
      (SELECT DISTINCT user_id FROM play_counts WHERE user_id IN (SELECT user_id FROM ({active_sql(min_plays)}) a)) x) u
  ON u.user_id = c.user_id
JOIN (SELECT track_id, row_number() OVER (ORDER BY track_id) - 1 AS item_idx FROM
      (SELECT DISTINCT track_id FROM play_counts WHERE user_id IN (SELECT user_id FROM ({active_sql(min_plays)}) a)) y) i
  ON i.track_id = c.track_id"""


# ---------------------------------------------------------------------------
# evaluation
# ---------------------------------------------------------------------------

cte("genre_sizes", ["tracks"], """
SELECT s.track_idx AS seed_idx, s.genre, CAST(g.n - 1 AS BIGINT) AS n_relevant
FROM tracks s JOIN (SELECT genre, count(*) AS n FROM tracks WHERE genre IS NOT NULL GROUP BY genre) g
  ON g.genre = s.genre""")


def metrics_sql(recs_sql: str, ks=(5, 10, 20)) -> str:
    """Per-query P/R/NDCG at each k for lists (seed_idx, rank, track_idx)
    judged by genre equality; every catalogue track is a query."""
    klist = ", ".join(str(k) for k in ks)
    return f"""
SELECT q.track_idx AS seed_idx, CAST(k.k AS INTEGER) AS k,
       CASE WHEN coalesce(z.n_relevant, 0) > 0 AND coalesce(p.n_recs, 0) > 0
            THEN coalesce(p.hits, 0) / k.k ELSE 0e0 END AS precision_at_k,
       CASE WHEN coalesce(z.n_relevant, 0) > 0 AND coalesce(p.n_recs, 0) > 0
            THEN coalesce(p.hits, 0) / z.n_relevant ELSE 0e0 END AS recall_at_k,
       CASE WHEN coalesce(z.n_relevant, 0) > 0 AND coalesce(p.n_recs, 0) > 0
            THEN coalesce(p.dcg, 0e0) / list_sum(list_transform(range(1, least(z.n_relevant, k.k) + 1),
                                                 lambda i: 1e0 / log2(i + 1)))
            ELSE 0e0 END AS ndcg_at_k
FROM tracks q CROSS JOIN (SELECT unnest([{klist}]) AS k) k
LEFT JOIN (
  SELECT j.seed_idx, kk.k, sum(j.hit) AS hits,
         sum(CASE WHEN j.hit = 1 THEN 1e0 / log2(j.rank + 1) ELSE 0e0 END) AS dcg, count(*) AS n_recs
  FROM (SELECT r.seed_idx, r.rank, CASE WHEN s.genre = t.genre THEN 1 ELSE 0 END AS hit
        FROM ({recs_sql}) r JOIN tracks s ON s.track_idx = r.seed_idx
        LEFT JOIN tracks t ON t.track_idx = r.track_idx) j
  JOIN (SELECT unnest([{klist}]) AS k) kk ON j.rank <= kk.k
  GROUP BY j.seed_idx, kk.k) p ON p.seed_idx = q.track_idx AND p.k = k.k
LEFT JOIN genre_sizes z ON z.seed_idx = q.track_idx"""


def baseline_sql(n: int, src: str = "tracks") -> str:
    return f"""
SELECT seed_idx, CAST(rn AS INTEGER) AS rank, track_idx, track_id, popularity,
       popularity / 100e0 AS baseline_score
FROM (SELECT s.track_idx AS seed_idx, t.track_idx, t.track_id, t.popularity,
             row_number() OVER (PARTITION BY s.track_idx
                                ORDER BY t.popularity DESC NULLS LAST, t.track_idx) AS rn
      FROM {src} s
      LEFT JOIN (SELECT genre, count(*) AS n FROM {src} WHERE genre IS NOT NULL GROUP BY genre) g
        ON g.genre = s.genre
      JOIN {src} t ON t.track_idx <> s.track_idx
       AND (CASE WHEN coalesce(g.n, 0) - 1 >= {n} THEN t.genre = s.genre ELSE true END)) b
WHERE rn <= {n}"""

# ---------------------------------------------------------------------------
# sequences
# ---------------------------------------------------------------------------

cte("vocab_tracks", ["tracks"], """
SELECT track_id AS item, CAST(row_number() OVER (ORDER BY track_id) AS BIGINT) AS code FROM tracks""")
cte("vocab_events", ["event_items"], """
SELECT item, CAST(row_number() OVER (ORDER BY item) AS BIGINT) AS code
FROM (SELECT DISTINCT track_id AS item FROM event_items WHERE track_id IS NOT NULL) d""")


def encoded_sql(items: str, vocab: str) -> str:
    return f"""
SELECT seq_id, pos, code, item FROM (
  SELECT seq_id, CAST(row_number() OVER (PARTITION BY seq_id ORDER BY p) - 1 AS BIGINT) AS pos,
         code, item, count(*) OVER (PARTITION BY seq_id) AS n
  FROM (SELECT s.seq_id, s.pos AS p, v.code, v.item FROM {items} s JOIN {vocab} v ON v.item = s.track_id) x) y
WHERE n >= 2"""


cte("enc_pl", ["playlist_items", "vocab_tracks"], encoded_sql("playlist_items", "vocab_tracks"))
cte("enc_ev", ["event_items", "vocab_events"], encoded_sql("event_items", "vocab_events"))


def model_sql(enc: str, max_len: int = 20, decay: float = 0.8) -> str:
    return f"""
SELECT ctx_item, next_item, weight, weight / sum(weight) OVER (PARTITION BY ctx_item) AS prob
FROM (SELECT c.item AS ctx_item, t.item AS next_item, sum(pow({decay}e0, t.pos - c.pos - 1)) AS weight
      FROM {enc} c JOIN {enc} t ON t.seq_id = c.seq_id AND t.pos - c.pos BETWEEN 1 AND {max_len}
      GROUP BY c.item, t.item) m"""


def scores_sql(enc: str, max_len: int = 20, decay: float = 0.8) -> str:
    """Next-item probabilities for each sequence of ``enc`` from its last
    ``max_len`` items, with the model fit on ``enc``."""
    return f"""
SELECT * FROM (
WITH model AS ({model_sql(enc, max_len, decay)}),
ctx AS (SELECT e.seq_id, e.item AS ctx_item, l.lp - e.pos + 1 AS d
        FROM {enc} e JOIN (SELECT seq_id, max(pos) AS lp FROM {enc} GROUP BY seq_id) l ON l.seq_id = e.seq_id
        WHERE l.lp - e.pos + 1 <= {max_len}),
known AS (SELECT * FROM ctx WHERE ctx_item IN (SELECT ctx_item FROM model)),
norm AS (SELECT seq_id, sum(pow({decay}e0, d - 1)) AS z FROM known GROUP BY seq_id),
shares AS (SELECT item AS next_item, count(*) / sum(count(*)) OVER () AS prob
           FROM {enc} WHERE pos >= 1 GROUP BY item),
warm AS (SELECT k.seq_id, m.next_item, sum(pow({decay}e0, k.d - 1) * m.prob) / n.z AS probability
         FROM known k JOIN model m ON m.ctx_item = k.ctx_item JOIN norm n ON n.seq_id = k.seq_id
         GROUP BY k.seq_id, m.next_item, n.z),
cold AS (SELECT q.seq_id, s.next_item, s.prob AS probability
         FROM (SELECT DISTINCT seq_id FROM ctx WHERE seq_id NOT IN (SELECT seq_id FROM norm)) q, shares s)
SELECT * FROM warm UNION ALL SELECT * FROM cold) sc"""
