"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE coalesces the shuffle
# partitions of small aggregates and splits skewed join partitions at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join side is broadcast by its measured size, not by an estimate.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "taxaspark",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset so spark-submit decides, and set
    ``spark.checkpoint.dir`` to a shared folder.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except AttributeError:  # a Spark Connect client has no SparkContext
        pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Unset, a session on a local master gets a fresh temporary
    folder, registered for its later calls; on a cluster that folder would not be shared, so it fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except AttributeError:  # a Spark Connect client sees the session's settings only
            root = None
    if not root:
        try:
            master = spark.sparkContext.master
        except AttributeError:  # a Spark Connect client
            master = "a remote session"
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        root = tempfile.mkdtemp(prefix="taxaspark-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/taxaspark/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access (tests only)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path

