"""tastemap: collaborative filtering and click prediction on Spark DataFrames."""

__version__ = "0.1.0"
