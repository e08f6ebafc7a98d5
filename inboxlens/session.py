"""Session helpers: a tuned builder for tests/bench and the shared scratch folder.

Library code never sets the master; it only reads settings from the session it is
handed.  ``build_session`` exists for tests, ``bench.py`` and local runs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

# Settings the plans are designed around.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "inboxlens",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system); only a local-mode session
    may fall back to a fresh temporary folder, which is then recorded in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="inboxlens-")
        if not spark.sparkContext.getCheckpointDir():  # one that the user set stays
            spark.sparkContext.setCheckpointDir(_LOCAL_ROOTS[key])
    return _LOCAL_ROOTS[key]


_LOCAL_ROOTS: dict[str, str] = {}


def local_path(path: str) -> str | None:
    """The local file-system path of ``path`` (plain or ``file:`` URI), else None."""
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return parsed.path if parsed.scheme else path
    return None


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the scratch root (never reused, never cleared)."""
    path = os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    local = local_path(path)
    if local is not None:  # remote stores need no directories up front
        os.makedirs(local, exist_ok=True)
    return path
