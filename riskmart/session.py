"""Session construction and the shared working folder.

All intermediate tables (landing copies, Silver, Gold, stream checkpoints) are
written below the folder the cluster names in ``spark.checkpoint.dir``.  On a
cluster that setting must point at shared storage; only a local-mode session
(tests, bench) without it gets a private temporary folder.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from riskmart import fs

PACKAGE = Path(__file__).resolve().parent
_SHIPPED: set[str] = set()


def build_session(master: str = "local[8]", app_name: str = "riskmart",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.ansi.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared working folder (the session's checkpoint dir)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        # Unset and local: tests and bench only.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskmart-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return sc.getCheckpointDir()


def new_work_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once an application and before a Python step
    is planned.  A local master whose workers find it by their path needs nothing; otherwise
    it is put into the shared folder, from which Spark hands it to every executor."""
    sc = spark.sparkContext
    seen = {os.path.realpath(p or ".") for p in [".", *os.environ.get("PYTHONPATH", "").split(os.pathsep)]}
    if sc.applicationId in _SHIPPED or (sc.master.startswith("local") and str(PACKAGE.parent) in seen):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    archive = f"{new_work_dir(spark, 'code')}/{PACKAGE.name}.zip"
    fs.write_bytes(spark, archive, packed.getvalue())
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
