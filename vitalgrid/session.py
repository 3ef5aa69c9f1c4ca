"""Session helpers: the shared folder for cut lineage and staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the session names none and driver and executors are one JVM, a folder in the
    warehouse is used. A cluster without the setting is an error, because a
    machine-local folder does not outlive its executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def run_dir(spark: SparkSession) -> str:
    """What this application stages lies below one folder."""
    return f"{shared_dir(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Delete everything this application has staged. Tables that read it are of no
    use afterwards, so a job calls this when its results are written."""
    delete(spark, run_dir(spark))


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """The path as Hadoop knows it, and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


@dataclass(frozen=True)
class Entry:
    """A file or folder in a listing."""

    path: str
    name: str
    is_folder: bool
    length: int
    modified: int  # milliseconds


def list_folder(spark: SparkSession, path: str) -> list[Entry]:
    """What lies in a folder itself, hidden names left out, in order of names; nothing
    where there is no such folder."""
    at, fs = _file_system(spark, path)
    if not fs.exists(at):
        return []
    found = [
        Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime())
        for s in fs.listStatus(at)
    ]
    return sorted((e for e in found if e.name[0] not in "_."), key=lambda e: e.name)


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _file_system(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all in it; nothing if there is none."""
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within one file system."""
    at, fs = _file_system(spark, source)
    if not fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Write a small file so that it is there whole or not at all: under another name
    first, then renamed. False if it is there already and not to be replaced."""
    at, fs = _file_system(spark, path)
    if replace:
        fs.delete(at, False)
    elif fs.exists(at):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
    fs.mkdirs(at.getParent())
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.rename(draft, at):
        return True
    fs.delete(draft, False)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one: of several callers one gets True."""
    at, fs = _file_system(spark, path)
    try:
        out = fs.create(at, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder; meant for small or reused intermediates."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Paths staged within ``staged_alone``, innermost last.
_held: list[list[str]] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once as parquet and read back, so that several consumers share one
    computation, still prune columns, and see a true size."""
    path = new_path(df.sparkSession, name)
    if _held:
        _held[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Stage what ``make`` gives, then delete the tables staged on the way to it."""
    _held.append([])
    try:
        result = staged(make(), name)
    except BaseException:
        _held.pop()
        raise
    *others, path = _held.pop()
    for other in others:
        delete(spark, other)
    if _held:
        _held[-1].append(path)
    return result
