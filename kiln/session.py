"""Session construction and the shared scratch / checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every kiln job wants; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app_name: str = "kiln",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder of the session.

    Uses the folder the cluster names in ``spark.checkpoint.dir``.  Only when
    that is unset *and* the master is local (tests, laptops) is a private
    temporary folder created; on a cluster an unset value is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="kiln-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables;
    ``clear_scratch`` removes it."""
    path = os.path.join(checkpoint_dir(spark), "kiln-tables", f"{name}-{uuid.uuid4().hex}")
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """The number of scratch tables so far, for ``clear_scratch``."""
    return len(_scratch.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, start: int = 0, end: int | None = None) -> None:
    """Remove the scratch tables of this application, or those numbered ``start``
    to ``end`` (results that still read them must be used before)."""
    sc = spark.sparkContext
    mine = _scratch.get(sc.applicationId, [])
    gone, mine[start:end] = mine[start:end], []
    for path in gone:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clear_at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        spark = SparkSession.getActiveSession()
        if spark is not None:
            clear_scratch(spark)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as
    ``--py-files`` would: their search path need not hold the repository."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="kiln-src-"), "kiln_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)


def laid_out(df, name: str):
    """``df`` written as a scratch table and read again, for rows that several jobs
    read: compressed by columns, where a checkpoint holds whole rows as they are in
    memory.  The shuffle files of the write are removed at its end."""
    path = scratch_path(df.sparkSession, name)
    write_spread(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_spread(df, path: str) -> None:
    """``df`` written to ``path``, its shuffles spread and their files removed after."""
    with spread(df.sparkSession), held(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)


#: Tasks a core that coalesced shuffles and packed files are spread over.
TASKS_PER_CORE = 3


@contextlib.contextmanager
def held(spark: SparkSession, conf: dict[str, str]):
    """These settings inside, what was there before after."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def spread(spark: SparkSession, on: bool = True):
    """Inside, shuffles are coalesced and files packed into some tasks a core at least.
    By default Spark aims at one a core and mostly makes one or two more, which then run
    alone in a second turn."""
    n = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return held(spark, {"spark.sql.adaptive.coalescePartitions.minPartitionNum": n, "spark.sql.files.minPartitionNum": n} if on else {})


def cut_lineage(df):
    """Reliable checkpoint (never ``localCheckpoint``): the result is written to
    the shared folder, so a lost executor does not force a recompute of the
    whole plan, and nondeterministic ids computed upstream stay fixed."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
