"""Session creation and the shared scratch location."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: adaptive execution (coalescing, skew splits,
# runtime join re-planning), UTC for date arithmetic, no UI server. Partition overwrite
# mode is chosen per write (static for full loads, dynamic for monthly refreshes).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Skip capturing the Python call site of every Column function (driver-side only).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "portolan",
                  shuffle_partitions: int | None = None, hive: bool = False, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` and ``shuffle_partitions`` are set only when given, so under ``spark-submit``
    the cluster's settings apply; size ``spark.sql.shuffle.partitions`` to the data (about
    128-256 MB of shuffle data per partition), AQE coalesces what is too small. ``hive``
    keeps the catalog in the cluster's metastore; without it, tables are found again from
    their location (``plans.warehouse.create_tables`` recovers their partitions).
    """
    builder = SparkSession.builder.appName(app)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises for sparkContext
        return None


def app_id(spark: SparkSession) -> str:
    """The application id, from the session's conf where possible."""
    sc = _context(spark)
    return spark.conf.get("spark.app.id", None) or (sc.applicationId if sc is not None else "app")


# Folders made for local sessions whose spark.checkpoint.dir is unset, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When the setting is missing we create a folder only for local masters (tests);
    on a cluster a machine-local folder would be wrong, so we refuse.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc is not None else None)
    if root:
        return root.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = app_id(spark)
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="portolan-ckpt-")
    return _LOCAL_ROOTS[app]


# Scratch folders of the applications of this process, deleted when it ends.
_SCRATCH: set[str] = set()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def files_size(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of the files (or folders) ``paths``."""
    jvm, hadoop_conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = [jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    return sum(path.getFileSystem(hadoop_conf).getContentSummary(path).getLength() for path in found)


@contextmanager
def sized_shuffles(spark: SparkSession, paths: Iterable[str], per_partition: int = 8 << 20) -> Iterator[None]:
    """Let the queries started inside shuffle into a partition per 8 MB of the files (or folders) ``paths``, the session's number at
    least, which adaptive execution joins up to 16 MB. A task's sorts and maps then hold the same amount however large the
    input is; with a fixed number of partitions they grow with it."""
    size = files_size(spark, paths)
    number, advised = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {name: spark.conf.get(name) for name in (number, advised)}
    spark.conf.set(number, str(max(int(before[number]), -(-size // per_partition))))
    spark.conf.set(advised, str(2 * per_partition))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries that are done with, which it does when the driver's garbage collectors meet their
    plans. What a first collection releases in the JVM is met by a second one only, a moment later."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def _delete_scratch(spark: SparkSession, folder: str) -> None:
    """Delete an application's own scratch folder; a JVM that is gone has nothing left to ask."""
    try:
        jvm = spark.sparkContext._gateway.jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the process is ending
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, in a folder of this
    application that goes when its driver ends."""
    folder = f"{checkpoint_root(spark)}/portolan/{app_id(spark)}"
    if folder not in _SCRATCH:
        _SCRATCH.add(folder)
        atexit.register(_delete_scratch, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the plan) and
    gives Catalyst a measured size, so a small dimension is broadcast by the planner's
    own threshold and a large one falls back to a sort-merge join.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
