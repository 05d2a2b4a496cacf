"""Folders of the shared file system, through Spark's own Hadoop client."""

from __future__ import annotations

import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Shuffled bytes are deleted with the job that moved them, not when the driver collects its
# garbage. For jobs whose frame is used once.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Frames that carry mail bytes: few rows per Arrow batch, since one row may hold
# a whole archive; and the few kinds of rows of a wave are written side by side,
# without a sort of the bytes. Copies of a mail lie side by side, where zstd finds them.
BLOB_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    **FREE_SHUFFLES,
}


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the queries run inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_batches(spark: SparkSession) -> None:
    """Hand bytes to Python a few MB at a time, unless the session says otherwise: a worker holds a batch in
    several forms at once, and several workers share an executor."""
    for name, value in {
        "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; empty if it is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def delete_tree(spark: SparkSession, path: str, threads: int = 8) -> None:
    """Delete a folder of very many files, the folders two levels below it side by side."""
    inner = [f"{path}/{a}/{b}" for a in children(spark, path) for b in children(spark, f"{path}/{a}")]
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(lambda p: delete(spark, p), inner))
    delete(spark, path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, over one that is there."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Put a finished small file in place, unless one is there already: False then.

    The file is written aside and moved without overwriting, so no reader ever sees half of
    it, and of two writers one wins. Local files are linked, since a local rename overwrites.
    """
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    write_text(spark, aside, text)
    fs, p = _fs(spark, path)
    _, a = _fs(spark, aside)
    jvm = spark._jvm
    try:
        if fs.getUri().getScheme() == "file":
            files = jvm.java.nio.file.Files
            files.createLink(_local(jvm, fs, p), _local(jvm, fs, a))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
            none = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(a, p, none)
        return True
    except Exception:
        if fs.exists(p):
            return False
        raise
    finally:
        fs.delete(a, False)


def _local(jvm, fs, path):
    return jvm.java.io.File(fs.makeQualified(path).toUri().getPath()).toPath()


def modified(spark: SparkSession, path: str) -> int | None:
    """When a file was written, in ms by the clock of its file system; None if it is missing."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the one the cluster names, or
    in a session without one, as in tests, a folder of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="lettermill-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_work_dir(spark: SparkSession, label: str) -> str:
    return f"{work_root(spark)}/lettermill/{label}-{uuid.uuid4().hex[:12]}"


def stored(frame, label: str):
    """The frame as a table in the shared folder: computed once, and read back
    with its size known to the planner."""
    spark, path = frame.sparkSession, new_work_dir(frame.sparkSession, label)
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
