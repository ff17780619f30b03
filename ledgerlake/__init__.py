"""ledgerlake: retail-bank analytics (raw -> staging -> marts -> dashboards) on Spark.

Every model is a function from DataFrames to a DataFrame; nothing in the
library reads a path except the source readers in :mod:`ledgerlake.sources`.
"""

__version__ = "0.1.0"
