"""Session settings the library counts on. A cluster's own values are kept."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits hot join keys and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
# Read at run time, so they can also be given to a running session.
RUNTIME_SETTINGS = {
    # JSON objects with a repeated key: the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM does not compile larger methods. Stages above this run as smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_settings(spark: SparkSession) -> None:
    given = spark.sparkContext.getConf()
    for key, value in RUNTIME_SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)


def build_session(app: str = "lockscope", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed and kept in the shared folder of ``spark.checkpoint.dir``.

    Only a local session without that setting makes a folder of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="lockscope-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
