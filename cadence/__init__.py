"""cadence — a Spark-native music catalogue analytics and recommendation engine.

Every operator takes DataFrames and returns a DataFrame. Batch forms answer a
whole table of seeds / users / playlists in one distributed job, with total
orderings so that results do not depend on partitioning.
"""

from cadence.config import Defaults  # noqa: F401

__version__ = "0.1.0"
