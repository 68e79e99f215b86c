"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI semantics, UTC, adaptive execution (runtime
# re-planning, partition coalescing, skew-join splitting), no UI server.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "airledger",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``); without one, the folder
    registered on the context. A folder of one machine would not be seen by the others, so none
    is made up: a session that has neither is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return base


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder's name under the shared checkpoint folder. Only a session in one JVM (tests,
    benches) may have none and gets a scratch folder, as no other machine has to see it."""
    master = spark.sparkContext.master
    try:
        base = checkpoint_dir(spark)
    except ValueError:
        if master != "local" and not master.startswith("local["):
            raise
        base = tempfile.mkdtemp(prefix="airledger-shared-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
