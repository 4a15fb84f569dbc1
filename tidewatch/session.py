"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime re-planning does most of the partition sizing: shuffle partitions are
# set high by the cluster and AQE merges or splits them to the advisory size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a join side is broadcast up to this size, which is measured when it has been shuffled
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.optimizer.rebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # wide projections would fuse into methods the JIT compiler refuses (over
    # 8,000 bytes of bytecode); beyond the limit Spark splits them up instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # the call site of every column expression is not looked up
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or join) a session with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs within use the package's limit of method size also in a session that was built without it."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    if int(before) > int(DEFAULTS[key]):
        spark.conf.set(key, DEFAULTS[key])
    try:
        yield
    finally:
        spark.conf.set(key, before)


_local_roots: dict[str, str] = {}  # application id -> folder, local masters only


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one fresh
    temporary folder per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidewatch-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return _local_roots[context.applicationId]


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new, never reused folder name below the shared root."""
    path = f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_made: dict[str, list[str]] = {}  # application id -> folders named by scratch()


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this application has made so far; how many there were.

    For the end of a job, when the results that read them are written. A local master's own folder goes when Python ends.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    return len(paths)
