"""Session settings the operators are designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "caseworks", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans expect.

    ``master`` and shuffle sizing stay with the cluster unless given. AQE picks
    the number of reduce partitions and splits skewed join partitions; the time
    zone is pinned so that string dates parse to the same wall clock everywhere.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.scheduler.mode": "FAIR",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names, set on the context once.

    A temporary folder is used only where ``spark.checkpoint.dir`` is unset and
    the session is local, as in tests; a cluster without the setting is an error
    because no executor could read a folder of the driver machine.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="caseworks-checkpoint-")
    spark.sparkContext.setCheckpointDir(configured)
    return configured
