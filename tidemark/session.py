"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key holding a large share of the rows is split across tasks, even when
    # that costs one more exchange of the already reduced rows above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators are planned for."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and timing runs."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def is_local(master: str) -> bool:
    """Whether all tasks run in the driver's process; ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own; on a
    cluster such a folder would be invisible to the other machines.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not root and not is_local(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="tidemark-"))
    return root or context.getCheckpointDir()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder path below the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote and nobody reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
