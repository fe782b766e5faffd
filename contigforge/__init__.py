"""A Spark-native genome-binning analytics engine: typed tables in, DataFrames out."""

__version__ = "0.1.0"
