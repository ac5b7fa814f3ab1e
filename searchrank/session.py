"""Spark session defaults and the shared checkpoint folder.

The library never creates a session behind the caller's back inside an
operator; operators take DataFrames.  ``get_session`` is for scripts,
tests and the bench.
"""

from __future__ import annotations

import atexit
import hashlib
import io
import os
import re
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, redirect_stdout
from contextvars import ContextVar, copy_context
from functools import wraps
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library assumes.  AQE re-plans joins at run
# time: a join side whose *measured* size is under the threshold becomes a
# broadcast, anything larger stays a sort-merge join, and a skewed
# partition of a sort-merge join is split.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "searchrank",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, driver_memory: str | None = "8g") -> SparkSession:
    """Build (or return) a session with the library's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3,
    ...) that survives executor loss; that setting always wins.  Only in
    local mode, where every task runs in this process, an unset folder falls
    back to a fresh one under the system temp directory (removed at exit);
    any other master without a configured folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share: "
                               f"master {sc.master} cannot use a machine-local one")
        configured = tempfile.mkdtemp(prefix="searchrank-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Codec of staged tables of wide rows, which take space until their query ends.
COMPACT = "zstd"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "tables", name)
    for scope in _SCOPES.get():
        scope.append(path)
    return path


#: Paths handed out inside every ``staging`` block open in this context.  A block of one
#: thread does not see another thread's tables, unless ``in_threads`` runs them for it.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("staged", default=())


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables (through Spark's file system, so any store works)."""
    jvm = spark._jvm  # noqa: SLF001
    conf = spark._jsc.hadoopConfiguration()  # noqa: SLF001
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[list[str]]:
    """Delete every table staged inside the block when it ends.

    For callers that write their result inside the block; a lazy frame that
    reads staged tables must not leave it, unless its tables are taken out of the
    list (``read_by``).
    """
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield paths
    finally:
        _SCOPES.reset(token)
        release(spark, paths)


def in_threads(fn: Callable, items: Iterable, parallelism: int) -> list:
    """``[fn(x) for x in items]``, a few at once; what they stage belongs to the caller's ``staging`` blocks."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, fn, x) for x in items]]


def read_by(df: DataFrame, paths: Iterable[str]) -> list[str]:
    """Those of the staged ``paths`` that the plan of ``df`` reads, in subqueries too."""
    conf = df.sparkSession.conf
    key, old = "spark.sql.maxMetadataStringLength", conf.get("spark.sql.maxMetadataStringLength")
    conf.set(key, "1000000")
    try:
        with io.StringIO() as text, redirect_stdout(text):
            df.explain("formatted")
            plan = text.getvalue()
    finally:
        conf.set(key, old)
    files = df.inputFiles()
    # staged folders end in a random name, so the name alone tells them
    return [p for p in paths if os.path.basename(p) in plan or any(os.path.basename(p) in f for f in files)]


#: HotSpot leaves a method of more than 8,000 bytes to its interpreter.  The generated code of a log's
#: columns is longer than that, and Spark's own limit (65,535) lets it pass; under this one such a stage
#: runs operator by operator, in methods that are compiled.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def limit_methods(spark: SparkSession) -> None:
    """Set ``METHOD_LIMIT`` for wide rows, unless the session has a setting of its own."""
    _unless_set(spark, *METHOD_LIMIT)


#: AQE joins shuffle partitions up to this size (Spark: 64 MB, compressed).  Narrow pairs of numbers grow some
#: twenty times in the hash tables and sorts of the task that reads them.
TASK_SIZE = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def limit_tasks(spark: SparkSession) -> None:
    """Set ``TASK_SIZE``, unless the session has a setting of its own."""
    _unless_set(spark, *TASK_SIZE)


def _unless_set(spark: SparkSession, key: str, value: str) -> None:
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)


def tidy(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query that frees what it staged, but for the tables its lazy result still reads."""
    @wraps(fn)
    def run(spark: SparkSession, *args, **kw) -> DataFrame:
        with staging(spark) as paths:
            got = fn(spark, *args, **kw)
            for p in read_by(got, paths) if paths else ():
                paths.remove(p)
        return got

    return run


#: Shared tables of this application, by path.
_SHARED: dict[str, SparkSession] = {}


def shared_table(spark: SparkSession, name: str, inputs: Iterable[str], spec: str,
                 build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` as a staged table that later callers with the same inputs and ``spec`` find again.

    The key is a digest of every input file's path, size and time and of ``spec``,
    which names the recipe and its settings.  A table counts once Spark's commit
    marker stands in its folder; a half-written one is written anew.
    ``release_shared`` deletes what this application wrote.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(inputs)).select(
        "path", "length", "modificationTime")   # the content is not read
    listed = sorted((r[0], r[1], str(r[2])) for r in files.collect())
    digest = hashlib.sha256(repr((listed, spec)).encode()).hexdigest()[:32]
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"shared-{name}-{digest}")
    marker = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))  # noqa: SLF001
    with _SHARE:
        if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):  # noqa: SLF001
            with staging(spark):
                build().write.mode("overwrite").option("compression", COMPACT).parquet(path)
            _SHARED[path] = spark
    return spark.read.parquet(path)


#: One builder at a time: a second caller finds the first one's table.
_SHARE = Lock()


def release_shared(spark: SparkSession) -> None:
    """Delete the shared tables that this application wrote."""
    mine = [p for p, s in _SHARED.items() if s is spark]
    release(spark, mine)
    for p in mine:
        del _SHARED[p]
