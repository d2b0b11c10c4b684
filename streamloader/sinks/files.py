"""Small files through Hadoop's file systems, so paths may lie on any of them."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


class AlreadyExists(RuntimeError):
    """A file to be created is there already: someone else wrote it."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return bool(fs.exists(target))


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a whole file under a new name.  Readers see all of it or nothing."""
    folder, name = path.rsplit("/", 1)
    fs, draft = _fs(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    try:
        move_new(spark, draft.toString(), path)
    except AlreadyExists:
        fs.delete(draft, False)
        raise


def move_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that must not exist: the file system replaces nothing."""
    jvm = spark.sparkContext._jvm
    fs, new = _fs(spark, target)
    fs.mkdirs(new.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri(),
        spark.sparkContext._jsc.hadoopConfiguration(),
    )
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context.rename(fs.makeQualified(jvm.org.apache.hadoop.fs.Path(source)), fs.makeQualified(new), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise AlreadyExists(target) from error
        raise


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def empty_folder(spark: SparkSession, path: str) -> None:
    for name in list_names(spark, path):
        delete_folder(spark, f"{path}/{name}")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, `spark.checkpoint.dir`: shared by driver and executors.

    A session without that setting gets a temporary folder, but only where driver and executors are
    one process; on a cluster a machine-local folder would lose data, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="streamloader-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
