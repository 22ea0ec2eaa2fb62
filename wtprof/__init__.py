"""wtprof: Spark-native web-traffic profiling.

Plain functions from DataFrame to DataFrame. Fitted state (vocabularies,
scaler parameters, thresholds) is kept as small DataFrames so that every
step stays inside one lazy Spark plan until an action is needed.
"""

from wtprof.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
