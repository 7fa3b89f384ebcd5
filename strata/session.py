"""Session construction and shared storage locations.

The library never invents machine-local folders on a cluster: written
intermediates go under the directory the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (unit tests, a
laptop) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. Partition counts are left to AQE: it
# coalesces small shuffle partitions and splits skewed ones at runtime.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove checkpoint files (exact quantiles) once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the scale settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory named by the cluster.

    Read from the session; a private one is set only where it is unset and
    Spark runs in a single local process (tests, a laptop). On a cluster
    without the setting this raises. Sessions without a SparkContext handle (Spark Connect) use
    the ``spark.checkpoint.dir`` setting.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def app_key(spark: SparkSession) -> str:
    """Identifier of the running application (scopes written layers)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 -- Spark Connect
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for a written intermediate table under the shared
    checkpoint directory (never a machine-local temp folder)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-tables/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["build_session", "checkpoint_dir", "scratch_path", "app_key", "SCALE_CONF"]
