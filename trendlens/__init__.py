"""trendlens: Spark-native analytics for trending-video style data.

Every public operator takes and returns a ``pyspark.sql.DataFrame``; nothing
is collected to the driver except bounded scalars (a histogram's bin count,
a model's coefficients).  Regions are a column, not copies of code.
"""

__version__ = "0.1.0"
