"""Session helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: What a batch of rows for a Python worker may weigh, and Spark's own bound, which it replaces.
BATCH_BYTES, BATCH_BOUND = 2 << 20, ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b")
#: What Spark may take a table for that it broadcasts by itself, and its own bound, which that replaces.
SMALL_BYTES, SMALL_BOUND = 256 << 10, ("spark.sql.autoBroadcastJoinThreshold", "10485760b")
#: Folders of intermediate tables, by application.
_written: dict[str, list[str]] = {}


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="notegraph-code-")) / "notegraph.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, Path("notegraph") / f.relative_to(root))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)
    return spark


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to the session's Python workers in batches of ``BATCH_BYTES``, if Spark's own bound was in force.

    By that one a task holds up to 64 MB of texts at once, several times over: in Arrow's buffers and those of the socket, both
    outside the heap, and in the worker. No result here depends on where a batch ends.
    """
    _lower(spark, *BATCH_BOUND, BATCH_BYTES)


def small_broadcasts(spark: SparkSession) -> None:
    """From now on the session broadcasts by itself what it takes for `SMALL_BYTES` at most, if Spark's own bound was in force.

    Spark goes by the size of compressed files and by the share of a row's width that is read, so paths of notes that it
    takes for 10 MB can be several hundred in memory: all of it in the driver, and several such joins at once.
    """
    _lower(spark, *SMALL_BOUND, SMALL_BYTES)


def _lower(spark: SparkSession, name: str, usual: str, to: int) -> None:
    if spark.conf.get(name, usual) == usual:
        spark.conf.set(name, str(to))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles both sides, whatever size Spark takes them for.

    A side that Spark takes for small goes whole through the driver to all executors. It goes by the size of files, or by
    columns without regard to how long their arrays are, so that side may be many times as large in memory, and several
    such grow with the input in the driver at once.
    """
    return df.hint("merge")


def released(run: Callable) -> Callable:
    """``run`` over a task's batches, and then what it has freed goes back to the system.

    Workers live on, and their allocators keep freed pages, which count beside the JVM's memory in the stages that follow.
    """

    def call(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return call


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Where it names none, a temporary one will do on a local master alone; on a cluster that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="notegraph-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage, and survives lost executors."""
    return _write(df, _noted(df.sparkSession, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared folder, for a job's own files; `cleanup` deletes it, too."""
    return _noted(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")


def _noted(spark: SparkSession, path: str) -> str:
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cleanup(spark: SparkSession) -> int:
    """Deletes every intermediate table that this application's jobs have written, and returns how many there were.

    To be called when the results are written or no longer needed: a result may read such tables until then.
    """
    folders = _written.pop(spark.sparkContext.applicationId, [])
    for path in folders:
        _delete(spark, path)
    return len(folders)


class Scratch:
    """Intermediate tables of one job in the shared folder. What is dropped must not be read by anything unfinished."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, _noted(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
        self.versions: dict[str, int] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Like `materialize`. Once the table is written, an earlier one of that name is deleted."""
        version = self.versions.get(name, 0) + 1
        out = _write(df, f"{self.folder}/{name}-{version}")
        self.drop(name)
        self.versions[name] = version
        return out

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.versions:
                _delete(self.spark, f"{self.folder}/{name}-{self.versions[name]}")

    def close(self) -> None:
        _delete(self.spark, self.folder)
        _written.get(self.spark.sparkContext.applicationId, [self.folder]).remove(self.folder)
