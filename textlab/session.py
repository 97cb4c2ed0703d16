"""Session construction and the shared scratch location.

Library code never creates its own session; tests and ``bench.py`` call
:func:`build_session`.  Anything that has to be written and read back
(checkpoints, round-trip files, materialised stages) goes under
:func:`scratch_dir`, which is the cluster's ``spark.checkpoint.dir``.
A private folder is only created when that setting is unset *and* the
master is local (tests, benches).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "textlab",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.scheduler.mode", "FAIR")  # independent fits overlap
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster, set only when unset on a local master."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running textlab jobs")
        root = tempfile.mkdtemp(prefix="textlab-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root (never reused, never cleared)."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/textlab/{name}-{uuid.uuid4().hex[:12]}"


def workers_can_import(spark: SparkSession) -> None:
    """Let Python workers import ``textlab`` whatever the driver's working folder.

    Fold, pooling and encoder functions reach the workers by module name.
    On a local master the package's parent folder is added to the worker
    ``PYTHONPATH`` (sent with every Python function).  On a cluster, ship the
    package with ``--py-files`` or install it on the executors.
    """
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parts = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *parts])
