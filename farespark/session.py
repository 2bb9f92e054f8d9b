"""Spark session and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


# Starting point for a large cluster (spark-submit --conf ...): many initial
# shuffle partitions that AQE coalesces to ~256 MB each, larger input splits,
# skew-join splitting on, and a broadcast threshold kept small so that only
# genuinely small sides are broadcast.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "farespark",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every farespark job assumes.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (AQE coalesces
    small ones at run time).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is required: a folder of one machine is not seen
    by the others. Where it is unset and everything runs on this machine
    (local master, as in tests), a private folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="farespark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    made = Path(tempfile.mkdtemp(prefix="farespark-py-")) / f"{package.name}.zip"
    with zipfile.ZipFile(made, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(made))
    _shipped.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/farespark/{name}-{uuid.uuid4().hex[:12]}"

