"""Session settings for local runs and the shared folder of a cluster."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
"""A batch then commits what it changed, and not the whole store."""
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int, memory: str = "8g") -> SparkSession:
    """A local session as tests and the bench use it."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trisketch")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(STATE_STORE, ROCKSDB)
        .config(STATE_CHANGES, "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="trisketch-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path under spark.checkpoint.dir.

    Where the setting is absent only a local session gets a temporary folder instead; on a
    cluster a machine-local one would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame once to the shared folder and go on from the written table.

    For edges that many jobs read: it cuts the lineage, and lost executors cost no recompute.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: a reader sees the text or no file of that name."""
    store, target = _store(spark, path)
    started = target.suffix(".new")
    out = store.create(started, True)
    out.write(bytearray(text.encode()))
    out.close()
    store.delete(target, False)
    store.rename(started, target)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    store, target = _store(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(target)) if store.exists(target) else []


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _store(spark, path)
    return store.exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder that no frame reads any more."""
    store, target = _store(spark, path)
    store.delete(target, True)


def forget(df: DataFrame) -> None:
    """Remove the folder of a frame that `materialize` gave and that no frame reads any more."""
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)
