"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


# Runtime settings the plans count on. A projection that normalizes every field makes a
# method beyond the 8,000 bytes up to which the JVM compiles; past that limit Spark should
# generate the operators one by one, in small methods, instead of one slow big one.
_RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "entigrid", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings above, without a web page.

    On a cluster the submit command sets master, memory and shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = {
        **_RUNTIME_SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session that names none (a local test) falls back to a new temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_dir()


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="entigrid-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/entigrid-{name}-{uuid.uuid4().hex}"
