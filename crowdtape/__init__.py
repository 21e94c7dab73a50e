"""crowdtape: relate a stream of dated text posts to a daily price series, on Spark.

Every operator takes and returns DataFrames and is written in built-in Spark
expressions, so one lazy plan runs from the raw lines to the feature table.
"""

from crowdtape import functions, operators, plans, sources
from crowdtape.session import get_spark, shared_dir

__all__ = ["functions", "get_spark", "operators", "plans", "shared_dir", "sources"]
