"""Session helpers: local/test session and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "churnlens") -> SparkSession:
    """Session for tests and local runs; on a cluster the submitter's settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):  # builder settings would beat those of the submitter
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        builder = builder.config("spark.driver.memory", os.environ.get("CHURNLENS_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none (local tests) do we create a scratch folder and register it.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if sc_dir:
        return sc_dir
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="churnlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written intermediate tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in tasks are pickled by reference, so workers must be able to import them
    wherever the driver found the package.  Spark distributes the archive itself."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(top)
    archive = os.path.join(tempfile.mkdtemp(prefix="churnlens-package-"), "churnlens.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(top):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, base))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
