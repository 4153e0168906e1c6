"""Where a job may put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from typing import TYPE_CHECKING

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

if TYPE_CHECKING:
    from pyarrow.fs import FileSystem

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session without the setting gets a folder of its own; on a cluster a
    machine-local folder would not be seen by other executors, so that is refused.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="siftspark-")
    context.setCheckpointDir(root)
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one staged table or stream checkpoint."""
    return f"{shared_dir(spark)}/siftspark/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once under the shared folder and read back: lineage ends there.

    Nothing needs the write's shuffle files after it, so Spark is told to remove them then.
    """
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path, which know every store that Spark can write to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _folder(spark, path)
    return store.exists(where)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table, once nothing depends on it any more."""
    store, where = _folder(spark, path)
    store.delete(where, True)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    store, where = _folder(spark, path)
    if not store.exists(where):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(where))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    store, where = _folder(spark, path)
    stream = store.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear as a whole, unless there is one; whether it was made.

    It is written under another name and then renamed without overwriting. HDFS does this as one
    step; on stores that can't, see to it that one driver publishes at a time.
    """
    jvm, (store, where) = spark._jvm, _folder(spark, path)
    written = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
    stream = store.create(written, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), store.getConf())
    nothing = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(store.makeQualified(written), store.makeQualified(where), nothing)
    except Py4JJavaError as error:
        store.delete(written, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def open_store(uri: str) -> tuple[FileSystem, str]:
    """The file system that Python tasks reach a folder or file with, and the path in it.

    Hadoop's names of object stores stand for the stores' own.
    """
    from pyarrow.fs import FileSystem  # large, and most drivers never need it

    for hadoop in ("s3a://", "s3n://"):
        if uri.startswith(hadoop):
            uri = "s3://" + uri.removeprefix(hadoop)
    return FileSystem.from_uri(uri)
