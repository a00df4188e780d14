"""Session helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "lmtables", **conf: object) -> SparkSession:
    """A session with the settings the library expects; a cluster's own settings win over these."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder of the cluster (``spark.checkpoint.dir``); a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    fallback = tempfile.mkdtemp(prefix="lmtables-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back, which cuts its lineage and survives lost executors."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing will read any more: what was made from them is written itself.

    Only folders that :func:`stage` made are touched. A table that is gone already is left out.
    """
    for table in tables:
        spark = table.sparkSession
        root = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark))
        system = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in {os.path.dirname(name) for name in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if system.makeQualified(path).getParent() == system.makeQualified(root):
                system.delete(path, True)
