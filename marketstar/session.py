"""Session construction and shared storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app: str = "marketstar",
    driver_memory: str | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """A session with the library's defaults.

    Master and shuffle partitions are set only if given, or for a local
    master; on a cluster the platform's settings stand.  A missing
    ``spark.checkpoint.dir`` gets a fresh local folder in local mode and is an
    error on any other master.
    """
    b = SparkSession.builder.appName(app)
    settings = dict(DEFAULT_CONF)
    if master:
        b = b.master(master)
        if _is_local(master):
            settings["spark.sql.shuffle.partitions"] = "8"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return spark


def _is_local(master: str) -> bool:
    """Local mode proper; ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def app_id(spark: SparkSession) -> str:
    """The application id, read from the session conf (works without a SparkContext handle)."""
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


_SESSION_MARK = "spark.marketstar.session"


def session_key(spark: SparkSession) -> str:
    """A name for this session alone (plans kept for reuse belong to one session and its settings)."""
    key = spark.conf.get(_SESSION_MARK, None)
    if key is None:
        key = uuid.uuid4().hex
        spark.conf.set(_SESSION_MARK, key)
    return key


def _checkpoint_base(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or None


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Raises when it is unset and the master is not known to be local: a
    machine-local temp folder is not visible to other executors.
    """
    base = _checkpoint_base(spark)
    if base:
        return base.rstrip("/")
    if not _is_local(spark.conf.get("spark.master", "")):
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for this cluster")
    local = tempfile.mkdtemp(prefix="marketstar-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/marketstar/{name}-{uuid.uuid4().hex}"
