"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results (time zone) or protect big joins from hot keys.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the one explicit time zone that all date strings are rendered in."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_roots: dict[str, str] = {}


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for stream checkpoints and written tables.

    It lies in the session's checkpoint folder: ``spark.checkpoint.dir``, or what was set
    on the context. Only a session on one machine may go without; it gets one temporary
    folder, which goes when Python ends.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and context._jsc.getCheckpointDir().isPresent():
        root = context._jsc.getCheckpointDir().get()
    if not root:
        if not re.match(r"local(\[[^-]*)?$", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tonearm-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
