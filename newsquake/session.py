"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SALTS_CONF = "spark.newsquake.salts"
DEFAULT_SALTS = 16
CHECKPOINT_CONF = "spark.checkpoint.dir"
# Recording a call site for every column costs several round trips each; long plans feel it.
DEBUGGING_CONF = "spark.python.sql.dataFrameDebugging.enabled"
# State of streams on local disks; each batch uploads its changes, not the whole state.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "newsquake", **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; cluster sizing stays with spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(DEBUGGING_CONF, "false")
    )
    for key, value in STATE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def salts(spark: SparkSession) -> int:
    """Number of salts a skew-safe join spreads one key over."""
    return max(1, int(spark.conf.get(SALTS_CONF, str(DEFAULT_SALTS))))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that every executor sees, under the one the session names for checkpoints.

    A local session that names none gets a temporary one; a cluster has to name it.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="newsquake-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """A frame several branches read, computed once where the session names spark.checkpoint.dir.

    The checkpoint lies in that shared folder, so losing an executor does not lose it. Without the
    setting the frame stays lazy and each branch computes it again.
    """
    spark = df.sparkSession
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        return df
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
