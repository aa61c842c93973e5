"""Session helpers: a local session for tests/bench, the shared work folder, size checks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "coverlens") -> SparkSession:
    """Local session with AQE on and the UI off.  On a cluster the caller's session is used as is."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder the cluster names in spark.checkpoint.dir.

    The setting is read from the session.  Only a local-mode session without it (tests,
    bench) gets a folder of its own; a cluster session without it is an error, because a
    machine-local folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="coverlens-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make DataFrame.checkpoint() usable: keep the session's folder, set one only where unset (local)."""
    if not spark.sparkContext.getCheckpointDir():
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            spark.sparkContext.setCheckpointDir(root)
        else:
            work_dir(spark, "init")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint folder: computed once, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
