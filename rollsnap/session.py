"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "rollsnap") -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                os.environ.get("ROLLSNAP_MIN_PARTITION_SIZE", "64k"))
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ROLLSNAP_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    The setting names a folder every executor can reach. Where it is unset a
    temporary folder serves, but only in local mode (tests and the bench): on
    a cluster each executor would write to a disk of its own, so the missing
    setting is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master!r})")
        app = spark.sparkContext.applicationId
        path = _LOCAL_DIRS.get(app) or _LOCAL_DIRS.setdefault(app, tempfile.mkdtemp(prefix="rollsnap-ckpt-"))
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
    except Exception:  # pragma: no cover - connect sessions have no SparkContext
        pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one run's output."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and continue from
    the files: a plan that reads its input several times computes it once,
    and the lineage is cut (a lost executor re-reads files, it does not
    recompute upstream stages)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def together(*jobs) -> list:
    """Run independent Spark jobs at the same time (each a function without
    arguments): the tasks of one fill the cores that the other leaves idle."""
    scope = contextvars.copy_context()
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(scope.copy().run, job) for job in jobs]]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system, if it exists."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Folders that ``scratch_path`` hands out inside the scope are deleted
    when it ends: a job's staged tables do not outlive it."""
    here: list[str] = []
    token = _SCOPE.set(here)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in here:
            delete_path(spark, path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rollsnap`` importable in every Python worker (the zip reader and
    fixture writers run there): the package is zipped once per application
    and distributed with ``addPyFile``, Spark's own code-shipping path."""
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - connect sessions ship code differently
        return
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="rollsnap-pkg-"), "rollsnap.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
