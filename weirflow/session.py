"""Session settings, shared work folders and reliable checkpoints."""

from __future__ import annotations

import atexit
import logging
import os
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Settings the operators rely on.  All of them are runtime settings, so they can be applied to a
# session that somebody else has built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles methods above 8000 bytes; rule chains reach that, and beyond it Spark's
    # plan without whole-stage code is the faster one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; UTC because every rule on dates is defined in UTC."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "weirflow", cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.weirflow.source.partitions", str(os.cpu_count() if cores == "*" else cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture costs a round trip per Column; rule chains have hundreds of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; a cluster without the setting is
    an error, since executors cannot see the driver's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="weirflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


KEEP_SCRATCH = "spark.weirflow.scratch.keep"
_scratch: list[tuple[object, str]] = []  # Hadoop configuration and path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never used twice.

    What lies there when the program ends is deleted then, since results that are read lazily may need
    it until the end; the setting ``spark.weirflow.scratch.keep`` = ``true`` keeps it.
    """
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if spark.conf.get(KEEP_SCRATCH, "false").lower() != "true":
        if not _scratch:
            atexit.register(clear_scratch)
        _scratch.append((spark._jsc.hadoopConfiguration(), path))
    return path


def clear_scratch() -> None:
    """Delete the scratch files of this program's sessions.  Tables that were read from them are void then."""
    gateway = SparkContext._gateway
    while _scratch and gateway is not None:
        conf, path = _scratch.pop()
        try:
            place = gateway.jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        except Exception:  # noqa: BLE001  the JVM may be gone, and then nobody can delete anything
            log.debug("scratch files stay at %s", path, exc_info=True)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later passes see the same rows
    in the same places even if executors are lost in between."""
    shared = shared_dir(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: later passes see the same rows at no further
    cost, also after executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
