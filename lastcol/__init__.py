"""lastcol: record search and run-length / Burrows-Wheeler text analytics on Spark DataFrames."""

__version__ = "0.1.0"
