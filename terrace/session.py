"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_FOLDERS: dict[str, str] = {}


def local_session(app: str = "terrace", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; on a cluster use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """A folder for intermediate tables that every executor can reach.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint folder). Only a local-mode session without that
    setting gets a temporary folder, because there one machine is the cluster.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            root = tempfile.mkdtemp(prefix="terrace-")
            spark.sparkContext.setCheckpointDir(root)
        _FOLDERS[app] = f"{root.rstrip('/')}/terrace-{app}-{uuid.uuid4().hex[:8]}"
    return _FOLDERS[app]


def drop_work_folder(spark: SparkSession) -> None:
    """Delete this application's intermediate tables once nothing reads them any more."""
    from terrace.sources import storage

    folder = _FOLDERS.pop(spark.sparkContext.applicationId, None)
    if folder:
        storage.delete(spark, folder)
