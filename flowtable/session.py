"""Session helpers: a tuned local session for tests/bench, and the shared scratch root.

On a cluster the session is built by the caller; nothing here overrides it.  The only
place we write scratch data is below ``spark.checkpoint.dir`` (a shared folder on a
cluster, where it must be set).  A private temporary folder is used only when that setting
is unset on a local master, as in unit tests.
"""

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
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_fallback_root: str | None = None


def build_session(
    master: str = "local[*]",
    app: str = "flowtable",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - remote sessions set their log level elsewhere
        pass
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; set our own only where it is unset."""
    global _fallback_root
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local SparkContext
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if _fallback_root is None:
            _fallback_root = tempfile.mkdtemp(prefix="flowtable-")
        root = _fallback_root
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - core conf may be read-only in some deployments
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared root (never reused between runs)."""
    tail = "/".join(p.strip("/") for p in parts if p)
    base = f"{shared_root(spark)}/flowtable-scratch/{uuid.uuid4().hex}"
    return f"{base}/{tail}" if tail else base


def checkpoint(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint into the shared checkpoint folder."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=eager)
