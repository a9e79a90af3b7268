"""Session defaults and staging of intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every operator here relies on: UTC so that naive and zoned timestamps
# agree, and adaptive execution for coalescing, skew joins and runtime re-planning.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # List state and timers of streams.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Rows one task may have to sort for an ordered operator. Keys with more rows
# than this are cut into ranges (see operators.ordered).
CHUNK_ROWS = "tickspark.chunkRows"
DEFAULT_CHUNK_ROWS = 2_000_000


def get_session(app: str = "tickspark", **conf: str) -> SparkSession:
    """Build (or fetch) a session with the defaults above."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def chunk_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(CHUNK_ROWS, str(DEFAULT_CHUNK_ROWS)))


_LOCAL: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def staging_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for intermediate tables.

    Where none is set, a local session gets a temporary folder of its own, which goes when the
    program ends; a cluster has to name one, since a machine-local folder would not survive a
    lost executor. The setting itself is fixed when a session starts and is only read here.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tickspark-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def stage(df: DataFrame) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Unlike a cached frame this survives lost executors, and unlike an RDD
    checkpoint later reads of it still prune columns and push filters down.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark).rstrip('/')}/tickspark-stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Remove the staged tables of this session, once nothing derived from them is to be read
    again. Returns how many there were."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)
