"""Defaults and fixed values.

Hyper-parameters live in one frozen dataclass (the reference keeps them in a
YAML file). Feature lists and the Camelot table are fixed values that must be
equal to the reference's for equal results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

AUDIO_FEATURES = [
    "danceability", "energy", "loudness", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence",
    "tempo", "duration_ms", "key", "mode", "time_signature",
]

VIBE_FEATURES = [
    "danceability", "energy", "valence",
    "acousticness", "instrumentalness", "tempo",
    "speechiness", "liveness",
]

CONTINUOUS_FEATURES = [
    "danceability", "energy", "loudness", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence",
    "tempo", "duration_ms",
]

CATEGORICAL_FEATURES = ["key", "mode", "time_signature"]

# Features clamped to [0, 1] during cleaning.
UNIT_FEATURES = [
    "danceability", "energy", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence",
]

# Column synonyms: source name -> canonical name (first listed wins on collision).
RENAME_MAP = {
    "track_id": "track_id",
    "track_name": "track_name",
    "artists": "artist",
    "album_name": "album",
    "track_genre": "genre",
    "popularity": "popularity",
    "id": "track_id",
    "name": "track_name",
    "track_artist": "artist",
    "playlist_genre": "genre",
    "playlist_subgenre": "subgenre",
    "track_album_name": "album",
    "track_popularity": "popularity",
    # display synonyms
    "title": "track_name",
    "song_name": "track_name",
    "song": "track_name",
}

# Release-year candidates, in priority order.
YEAR_COLUMNS = [
    "release_date", "year", "release_year", "album_release_date",
    "track_album_release_date",
]
DEFAULT_YEAR = 2018

# Camelot wheel: (pitch class, mode) -> code. mode 1 = major (B), 0 = minor (A).
CAMELOT = {
    (0, 1): "8B", (1, 1): "3B", (2, 1): "10B", (3, 1): "5B",
    (4, 1): "12B", (5, 1): "7B", (6, 1): "2B", (7, 1): "9B",
    (8, 1): "4B", (9, 1): "11B", (10, 1): "6B", (11, 1): "1B",
    (0, 0): "5A", (1, 0): "12A", (2, 0): "7A", (3, 0): "2A",
    (4, 0): "9A", (5, 0): "4A", (6, 0): "11A", (7, 0): "6A",
    (8, 0): "1A", (9, 0): "8A", (10, 0): "3A", (11, 0): "10A",
}

# Transition score weights: harmonic, bpm, energy, valence.
W_HARMONIC, W_BPM, W_ENERGY, W_VALENCE = 0.40, 0.30, 0.20, 0.10
EDGE_MIN_SCORE = 0.5
FALLBACK_PENALTY = 0.5
FALLBACK_TOP = 10
ARC_BONUS, ARC_PENALTY = 0.05, -0.02
ARC_EXPECTED_LENGTH = 15

RANKER_FEATURES = [
    "content_score", "cf_score",
    "danceability", "energy", "valence", "acousticness",
    "instrumentalness", "tempo", "popularity",
    "genre_match", "energy_delta", "valence_delta", "tempo_delta",
]

MODES = ["content", "collaborative", "hybrid", "autoplay", "transition"]


@dataclass(frozen=True)
class Defaults:
    n_neighbors: int = 20
    knn_n: int = 10
    similar_n: int = 10
    baseline_n: int = 20
    history_n: int = 20
    k_values: tuple = (5, 10, 20)
    min_interactions: int = 5
    train_years: tuple = (2014, 2015, 2016, 2017, 2018, 2019, 2020)
    val_years: tuple = (2021,)
    test_years: tuple = (2022,)
    bpm_tolerance: float = 5.0
    beam_width: int = 5
    playlist_len: int = 15
    energy_arc: str = "gradual"
    als_rank: int = 128
    als_iterations: int = 30
    als_reg: float = 0.01
    als_alpha: float = 40.0
    seq_max_len: int = 20
    seq_decay: float = 0.8
    pca_components: int = 32
    eval_sample: int = 100
    eval_seed: int = 42
    max_recommendations: int = 50
    extra: dict = field(default_factory=dict)


DEFAULTS = Defaults()
