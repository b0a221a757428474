"""Session set-up and the shared folder for cut lineage and written tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "churnloom", conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings the operators rely on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # no call-site capture on every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make calendar functions independent of where the driver runs."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session that names none (a test) gets a temporary folder of its own; on a
    cluster a folder of one machine would be lost to the others, so there it must be named.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("name a folder shared by all executors in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="churnloom-")
    elif named.startswith("file:") and not sc.master.startswith("local"):
        raise ValueError(f"{named} is a folder of one machine; name one that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


#: folders of the runs that this thread has open, innermost last
_OPEN = threading.local()


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """A folder below the shared one for all tables stored inside the block; it goes when the block ends, however it ends.

    What is to outlive the block (its result) must be written elsewhere before it ends: to a path taken outside of it. Blocks
    may be nested, and hold for the thread that opens them. Tables stored outside of any block stay, since the library cannot
    know who still reads them.
    """
    path = scratch_path(spark, name)
    runs = _open_runs()
    runs.append(path)
    try:
        yield path
    finally:
        runs.remove(path)
        remove(spark, path)


def _open_runs() -> list[str]:
    if not hasattr(_OPEN, "runs"):
        _OPEN.runs = []
    return _OPEN.runs


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table or folder, on whatever file system it lies."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def copied(spark: SparkSession, path: str, to: str) -> None:
    """Copy a stored table or folder, on whatever file system it lies."""
    sc = spark.sparkContext
    hadoop, conf = sc._jvm.org.apache.hadoop.fs, sc._jsc.hadoopConfiguration()
    source, target = hadoop.Path(path), hadoop.Path(to)
    hadoop.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table, in the innermost open run folder or else in the shared folder."""
    runs = _open_runs()
    return f"{runs[-1] if runs else shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Compute ``df`` once into a table in the shared folder and continue from the stored rows.

    For tables read by several jobs or several branches of one plan: losing an executor costs a
    re-read, not a recomputation from the raw log, and every branch reads only its own columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def checkpointed(df: DataFrame) -> Iterator[DataFrame]:
    """The rows of ``df``, partitions and order included, as a reliable checkpoint that goes when the block ends.

    For rows that very many small jobs read: their tasks carry no plan but a list of files.
    """
    spark = df.sparkSession
    shared_dir(spark)
    rows = df.checkpoint()
    try:
        yield rows
    finally:
        remove(spark, rows._jdf.logicalPlan().rdd().getCheckpointFile().get())
