"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every entry point of the library is written for. Cluster size,
# memory and the shuffle partition count stay with the caller.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with SESSION_CONF; dots in `conf` keys are written as double underscores."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            # Both are needed on hosts whose name does not resolve to a local interface.
            builder = (
                builder.config("spark.driver.host", "127.0.0.1")
                .config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.ui.enabled", "false")
                .config("spark.ui.showConsoleProgress", "false")
            )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below `spark.checkpoint.dir`, the shared folder the cluster names. Only a
    local session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tillscope-")
    return f"{base.rstrip('/')}/tillscope/{label}-{uuid.uuid4().hex}"
