"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings a job of this package relies on. AQE re-plans shuffles at run
# time (partition coalescing, skew-join splitting); ANSI mode stays on so
# bad casts and divisions fail loudly unless written with try_*.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "credit_spark") -> SparkSession:
    """A local session for tests and benchmarks (clusters bring their own).

    Python workers find the package whatever the working folder is."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *known])
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is.
    Only when it is unset in local mode (tests) a fresh folder is created
    here; on a cluster, whose machines share no such folder, that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith(("local[", "local")) \
            or not path and spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="credit-spark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def file_listing(spark: SparkSession, path: str) -> tuple:
    """(name, length, modification time) of the files of a table, sorted; one listing on the driver."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, found = fs.listFiles(at, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if getattr(_SCOPES, "open", None):
        _SCOPES.open[-1].append(path)
    return path


_SCOPES = threading.local()
# Called after a scope's tables are gone, so that results kept in memory that read them are forgotten.
AFTER_SCOPE: list[Callable[[], None]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the scratch tables that are made inside, once the block is left.

    For a job that writes its result inside the block::

        with scratch_scope(spark):
            queries()["cleaned_correlation"](spark, folder).write.parquet(out)

    Only paths that ``scratch_path`` gave to this thread in this block go,
    also after an error; tables made before, the run table and a result
    elsewhere stay. A plan built inside must not be read afterwards.
    Scopes can be nested: each deletes its own.
    """
    made: list[str] = []
    if not hasattr(_SCOPES, "open"):
        _SCOPES.open = []
    _SCOPES.open.append(made)
    try:
        yield made
    finally:
        _SCOPES.open.pop()
        for path in made:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        if made:
            for forget in AFTER_SCOPE:
                forget()


def side_by_side(*jobs: Callable[[], object]) -> list:
    """The results of functions that run Spark jobs, each in a thread of its own.

    What they make with ``scratch_path`` belongs to the caller's open scopes."""
    scopes = getattr(_SCOPES, "open", [])

    def run(job):
        _SCOPES.open = list(scopes)
        return job()
    with ThreadPool(len(jobs)) as pool:
        return pool.map(inheritable_thread_target(run), jobs, chunksize=1)


def sf_table(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
