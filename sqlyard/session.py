"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "sqlyard", master: str | None = None, **settings) -> SparkSession:
    """Session with the settings the jobs are written for; ``settings`` use __ for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    wanted = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    wanted.update({k.replace("__", "."): str(v) for k, v in settings.items()})
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: list[str] = []  # this process' folder, once a local session has asked for one


def shared_base(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which the driver and every executor reach.

    Where the setting is missing, a local session, whose executor is the driver, gets a folder of this machine that goes when the
    process ends; any other session gets an error, since its executors would each write to a folder of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="sqlyard-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path that the driver and every executor can reach."""
    return f"{shared_base(spark)}/{purpose}-{uuid.uuid4().hex}"
