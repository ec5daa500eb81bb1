"""Spark session helpers.

Settings here are the ones every job in the package relies on: UTC session time,
adaptive execution (runtime broadcast decisions, partition coalescing, skew-join
splitting) and Arrow for the few pandas boundaries.  Cluster deployments pass
their own master, memory and shuffle sizing; nothing here overrides a value the
cluster already set.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import threading
import uuid
from contextlib import contextmanager
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Conf keys we set only when the deployment did not set them already.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a shuffle join whose measured build partitions are all this small hashes instead of sorting
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128MB",
    # checkpoint files of collected intermediates are removed with their references
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Signature keys are derived on the driver; keep them out of plans and the UI.
    "spark.sql.redaction.string.regex": "(?i)(secret|ipad|opad|signature_key)",
}


def get_spark(app: str = "feedlens", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    launched = _launched_conf()
    for key, value in _DEFAULTS.items():
        if key not in launched:
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _launched_conf() -> set[str]:
    """Keys the deployment already set.

    Only read when a JVM is already up (spark-submit launches the Python driver
    from it); starting one here would freeze driver settings such as memory
    before the builder could apply them."""
    try:
        from pyspark import SparkConf, SparkContext
        if SparkContext._jvm is None and not os.environ.get("PYSPARK_GATEWAY_PORT"):
            return set()
        SparkContext._ensure_initialized()
        return {k for k, _ in SparkConf().getAll()}
    except Exception:  # pragma: no cover - no JVM available
        return set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment names a shared (HDFS/object-store) folder and we
    only read it; a cluster without one is an error (a machine-local folder would
    not survive a lost executor).  In local mode, as in tests, a private folder
    is created when none is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(HDFS or object store) that every executor can read")
        configured = tempfile.mkdtemp(prefix="feedlens-ckpt-")   # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured



def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder, unique to this call."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read back.

    Cuts the lineage as ``checkpoint()`` does, but the table is columnar (a reader takes only
    the columns it needs) and its size is known to the planner."""
    path = shared_folder(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def removed(*tables: DataFrame) -> None:
    """Removes tables of :func:`written` that nothing will read again."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """What is executed here leaves no shuffle files behind (else they stay on the executors' disks until
    the driver collects its garbage; a later stage that needs lost ones is run again)."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before) if before is not None else spark.conf.unset(setting)


@contextmanager
def garbage_collected(spark: SparkSession, seconds: float = 10):
    """Meanwhile the driver collects its garbage now and then, as ``spark.cleaner.periodicGC.interval`` has it
    done every half hour: only then are the shuffle files of past steps of an MLlib fit removed."""
    done, collect = threading.Event(), spark.sparkContext._jvm.System.gc

    def run():
        while not done.wait(seconds):
            collect()

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()


#: Rows and bytes of a batch that a Python task gets at a time.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def map_arrow(df: DataFrame, task, schema) -> DataFrame:
    """``df.mapInArrow(task, schema)`` in batches of BATCH_ROWS rows and BATCH_BYTES bytes at most (a
    longer row is a batch by itself), so that little text is handed over at a time."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(partial(_released, task=task), schema)


def _released(batches, task):
    """The worker returns its memory when a task ends, as it waits for other tasks then."""
    try:
        yield from task(batches)
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)             # where the C library has it
        if trim is not None:
            trim(0)
