"""An update log: what streams in update mode leave behind, one folder for each micro-batch, compacted now and then."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.sources.sinks import replace_epoch

#: Micro-batches between two compactions.
COMPACT_EVERY = 16

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB: a micro-batch touches the keys it holds, the rest stays on disk."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _numbers(spark: SparkSession, path: str, prefix: str, whole: bool = False) -> list[int]:
    """Numbers of the sub-folders ``prefix=number``; with ``whole`` only of those that were written to the end."""
    fs, at = _files(spark, path)
    if not fs.exists(at(path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at(path)) if s.isDirectory()]
    found = [int(n[len(prefix) + 1:]) for n in names if n.startswith(prefix + "=")]
    return sorted(n for n in found if not whole or fs.exists(at(f"{path}/{prefix}={n}/_SUCCESS")))


def write_updates(batch: DataFrame, path: str, epoch: int, key: Sequence[str], compact_every: int = COMPACT_EVERY) -> None:
    """Add a micro-batch's updated rows (one for each key) to the log at ``path``; repeating the micro-batch replaces them.

    Every ``compact_every`` micro-batches the current rows are written as a snapshot and what it
    covers is removed, so the log holds no more than that many micro-batches (0: never).
    """
    spark = batch.sparkSession
    covered = _numbers(spark, f"{path}/snapshots", "upto", whole=True)
    if covered and covered[-1] >= epoch:
        return  # the same micro-batch again, after the snapshot that holds it
    replace_epoch(batch, f"{path}/log", epoch, ())
    if compact_every and epoch % compact_every == compact_every - 1:
        read_latest(spark, path, key).write.mode("overwrite").parquet(f"{path}/snapshots/upto={epoch}")
        fs, at = _files(spark, path)
        for n in _numbers(spark, f"{path}/log", "epoch"):
            if n <= epoch:
                fs.delete(at(f"{path}/log/epoch={n}"), True)
        for n in covered:
            fs.delete(at(f"{path}/snapshots/upto={n}"), True)


def read_latest(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """The last row of each key: from the newest snapshot and the micro-batches after it (a mergeable ``max_by``)."""
    covered = _numbers(spark, f"{path}/snapshots", "upto", whole=True)
    parts = []
    if covered:
        parts.append(spark.read.parquet(f"{path}/snapshots/upto={covered[-1]}").withColumn("epoch", F.lit(covered[-1]).cast("long")))
    later = [n for n in _numbers(spark, f"{path}/log", "epoch") if not covered or n > covered[-1]]
    for n in later:
        try:
            parts.append(spark.read.parquet(f"{path}/log/epoch={n}").withColumn("epoch", F.lit(n).cast("long")))
        except AnalysisException as e:
            if (e.getCondition() or "") != "UNABLE_TO_INFER_SCHEMA":  # a micro-batch without updates
                raise
    if not parts:
        raise FileNotFoundError(f"no updates in {path}")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rest = [c for c in rows.columns if c not in (*key, "epoch")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "epoch").alias("__v")).select(*key, "__v.*")
