"""Schema of stored runs (never inferred)."""

from pyspark.sql import types as T

# One row per maximal run of equal symbols inside a block.
RUNS = T.StructType([
    T.StructField("block_id", T.LongType(), False),
    T.StructField("run_no", T.LongType(), False),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("start_pos", T.LongType(), False),
    T.StructField("run_len", T.LongType(), False),
])
