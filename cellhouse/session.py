"""Session defaults and the shared work folder."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "cellhouse", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings this package is tuned for.

    AQE re-plans joins and coalesces shuffle partitions from runtime sizes and
    splits skewed join partitions; the session time zone is UTC so stream
    watermarks on converted ``timestamp_ntz`` columns are stable.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for written tables and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster's shared folder).  Only
    when it is unset -- local runs and tests -- a folder of our own is made
    and registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cellhouse-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the work root."""
    return f"{work_root(spark)}/cellhouse/{name}-{uuid.uuid4().hex[:12]}"


def local_path(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p


def is_local(p: str) -> bool:
    return p.startswith("/") or p.startswith("file:")


_SHIPPED: set = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``cellhouse`` importable in Python workers (``addPyFile`` of a
    zip of the package), once per application.  Needed whenever Python runs
    on executors -- Arrow map functions, stateful stream functions -- and the
    package is not installed there.  The zip is written next to the tables
    when the work folder is local, else to the driver's scratch folder, from
    where Spark's file server distributes it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        files = sorted(
            os.path.join(dp, f) for dp, _, fs in os.walk(pkg) for f in fs if f.endswith(".py")
        )
        digest = hashlib.sha1()
        for f in files:
            with open(f, "rb") as fh:
                digest.update(f.encode() + fh.read())
        root = work_root(spark)
        base = local_path(root) if is_local(root) else tempfile.mkdtemp(prefix="cellhouse-pkg-")
        out_dir = os.path.join(base, "cellhouse-pkg")
        os.makedirs(out_dir, exist_ok=True)
        out = os.path.join(out_dir, f"cellhouse-{digest.hexdigest()[:12]}.zip")
        if not os.path.exists(out):
            tmp = f"{out}.{uuid.uuid4().hex}.tmp"
            with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
                for f in files:
                    z.write(f, os.path.join("cellhouse", os.path.relpath(f, pkg)))
            os.replace(tmp, out)
        sc.addPyFile(out)
        _SHIPPED.add(app)


__all__ = ["build_session", "work_root", "new_path", "local_path", "is_local", "ship_package"]
