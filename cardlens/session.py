"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every session of this engine should carry.  Time zone is fixed to
# UTC so that epoch days never depend on the JVM's zone; ANSI mode stays on,
# so every division in the library goes through try_divide.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even where a window or aggregate on its keys then needs a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "cardlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches (a cluster passes its own)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of SESSION_CONF to a given session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(k, SESSION_CONF[k])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; if it is unset there, that is an error.  Only a ``local`` master
    (tests, benches), where one machine does all the work, gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not is_local_master(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="cardlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def is_local_master(master: str) -> bool:
    """``local``, ``local[n]``, ``local[n,m]``: driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def drop_tables(spark: SparkSession) -> None:
    """Delete all tables this session has written to its scratch folder.  DataFrames
    built on them cannot be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_table(df, name: str):
    """Materialise ``df`` as parquet in the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor re-reads files instead of
    recomputing the plan) and later scans prune columns and push filters."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def at_once(spark: SparkSession, jobs: list[Callable]) -> list:
    """Results of ``jobs``, run side by side by threads of the driver: Spark jobs of one use the cores that the others leave idle."""
    send_package(spark)
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return [x.result() for x in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def send_package(spark: SparkSession) -> None:
    """Send the package's own source to the executors, once a session: they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_cardlens_sent", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="cardlens-code-"), "cardlens_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._cardlens_sent = True
