"""tessera: Spark-native feature, evaluation and leaderboard operators for labelled tables.

Every operator is a function from DataFrame(s) to DataFrame, written with Spark's own
expressions so Catalyst can prune, push down and fuse the work.
"""

from tessera.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
