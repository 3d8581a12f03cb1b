"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(name: str = "tabulary", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; the caller's own settings win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own;
    on a cluster a machine-local folder would not be visible to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors see")
        folder = tempfile.mkdtemp(prefix="tabulary-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
