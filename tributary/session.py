"""Spark session defaults and the shared scratch location.

Every job that cuts lineage or keeps streaming state writes under the folder
the cluster names in ``spark.checkpoint.dir``.  A local fallback is created
only when that setting is absent (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # failed tasks are retried, lost executors re-run their map stages
    "spark.task.maxFailures": "4",
    # streaming state (de-dup ids, windows) off-heap and checkpointed incrementally
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tributary", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    ship_package(spark)
    return spark


def stateful(spark: SparkSession) -> SparkSession:
    """The session with the state store that arbitrary stateful operators need, whoever built it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(key, SESSION_DEFAULTS[key])
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch folder.

    Read from the session (``spark.checkpoint.dir`` or an already set RDD
    checkpoint dir).  Where neither is set, a local session gets a folder of its
    own; on a cluster that is an error, since executors share no local folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tributary-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/{kind}/{uuid.uuid4().hex}"


def materialize(df, kind: str = "stage"):
    """Write ``df`` as a parquet table under the shared folder and read it back.

    Cuts the lineage (a lost executor never forces recomputation past this
    point) and lets several consumers share one computation.  ``release`` drops
    the copy once nothing reads it any more.
    """
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._materialized = path
    return out


def release(*frames) -> None:
    """Delete the copies that ``materialize`` wrote."""
    from tributary.sources import storage
    for df in frames:
        path = getattr(df, "_materialized", None)
        if path:
            storage.delete(df.sparkSession, path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tributary`` importable on the executors' Python workers.

    Grouped pandas functions and pandas UDFs are pickled by reference to this
    package; a zip of it under the shared folder is added once per application.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import tributary
    pkg = os.path.dirname(os.path.abspath(tributary.__file__))
    base = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    # through Spark's file system, so the shared folder may be in any store
    path = f"{shared_dir(spark)}/pyfiles/{uuid.uuid4().hex}/tributary.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(path)
    _SHIPPED.add(app)
