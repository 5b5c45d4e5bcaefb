"""Session construction and the shared scratch folder.

Library code never invents machine-local paths on a cluster: intermediate tables and streaming
checkpoints go below the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "navstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every job relies on: UTC clock, AQE on, dynamic partition overwrite."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Remove reliable checkpoint files once nothing references them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times, windows and month keys are defined on the UTC clock."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set on the context or in the conf), or, where a session
    names none, a folder below the warehouse, which a cluster shares as well."""
    root = None
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_navstream_scratch"
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/navstream/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint root and read back: computed once, however often it is used, and not
    again when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_RUNS: dict[tuple[str, str], str] = {}


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of a named job; the folder of this session's run before it is deleted, so
    scratch does not pile up. What an earlier run returned is read from its folder: finish with it first."""
    key = (spark.sparkContext.applicationId, name)
    old = _RUNS.pop(key, None)
    if old:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _RUNS[key] = scratch_path(spark, name)
    return _RUNS[key]


def together(spark: SparkSession, *writes: Callable[[], object]) -> None:
    """Independent writes at the same time: tasks of one fill the cores that the commits and last tasks of another leave idle. The
    first failure is raised once all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]:
            done.result()
