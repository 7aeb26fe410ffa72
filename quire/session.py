"""A session with the settings that the operators are written for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def session(app: str = "quire", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    return builder.config(map=settings | conf).getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir; only a local session gets one of this machine where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return f"{(root or '/tmp/checkpoints/quire').rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
