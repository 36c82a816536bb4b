"""Session and lineage helpers.

Library code never invents storage locations on a cluster: lineage is cut
with ``DataFrame.checkpoint()`` into the folder named by
``spark.checkpoint.dir``.  Only a local-mode session (tests, bench) gets a
scratch folder when the setting is missing.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Options of a writer for large sorted tables: texts that share their beginnings and
#: numbers that follow each other are stored by their differences.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "lastcol", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, Arrow on."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a scratch one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_CONF, None) or sc.getConf().get(_CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"set {_CHECKPOINT_CONF} to a shared folder; iterative operators "
                "cut their lineage there")
        configured = tempfile.mkdtemp(prefix="lastcol-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out before CPU-heavy work per row: by ``keys``, else in turn.
    The number of tasks is fixed, so that adaptive execution does not pack a
    few bytes of hard work into one task; it neither looks at the input's
    partitions (which may be empty) nor runs a job."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys) if keys else df.repartition(n)
