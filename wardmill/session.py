"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wardmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, UTC and Arrow on. Sizes are left to the cluster."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share.

    Where it is unset, a folder of our own on a session that runs in one process (tests); on a cluster an
    error, since no machine-local folder will do there.
    """
    sc = spark.sparkContext
    if named := sc.getConf().get("spark.checkpoint.dir"):
        return named
    if sc.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir isn't set: name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "wardmill-checkpoint")


def fresh_folder(spark: SparkSession, prefix: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/{prefix}-{uuid.uuid4()}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
