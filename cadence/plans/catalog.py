"""The whole query catalogue: importing this module registers every query."""

from cadence.plans import catalogue_queries  # noqa: F401
from cadence.plans import feature_queries  # noqa: F401
from cadence.plans import harmonic_queries  # noqa: F401
from cadence.plans import interaction_queries  # noqa: F401
from cadence.plans import evaluation_queries  # noqa: F401
from cadence.plans import sequence_queries  # noqa: F401
from cadence.plans import playlist_queries  # noqa: F401
from cadence.plans import ml_queries  # noqa: F401
from cadence.plans import serving_queries  # noqa: F401
from cadence.plans.registry import ORACLE, QUERIES  # noqa: F401
from cadence.plans.feature_queries import flagship  # noqa: F401
