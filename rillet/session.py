"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so timestamps compare equal across
# engines, AQE for runtime partition coalescing and skew-join splitting,
# RocksDB for the keyed state of the streaming processors.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rillet", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the
    submitter's values win and AQE coalesces small shuffles.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.driver.memory", os.environ.get("RILLET_DRIVER_MEMORY", "8g"))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``rillet`` importable in Python workers of a local session.

    On a cluster the package is shipped at submit time (``--py-files``);
    the streaming processors are pickled by value and need nothing shipped.
    In local mode the package is zipped and added with ``addPyFile`` once
    per context, so workers started from any directory can import it.
    """
    sc = spark.sparkContext
    if not sc.master.startswith("local") or getattr(sc, "_rillet_shipped", False):
        return
    import shutil

    pkg = os.path.dirname(os.path.abspath(__file__))
    base = tempfile.mkdtemp(prefix="rillet-pkg-")
    zip_path = shutil.make_archive(os.path.join(base, "rillet"), "zip", os.path.dirname(pkg), "rillet")
    sc.addPyFile(zip_path)
    sc._rillet_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir``; a cluster must name a shared
    folder there. Only a local-mode session with nothing configured (tests,
    bench) gets a fresh scratch folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="rillet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for one materialisation."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
