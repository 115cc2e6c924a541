"""Where jobs put the tables that cut their lineage."""

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="fareflow-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


_open: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/fareflow/{label}-{uuid.uuid4().hex}"
    for folders in _open[-1:]:
        folders.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the folders made inside, once the block has written its answer elsewhere."""
    folders: list[str] = []
    _open.append(folders)
    try:
        yield
    finally:
        _open.remove(folders)
        for path in folders:
            remove(spark, path)


def _files(spark: SparkSession, path: str):
    """The path and its file system, as the session's configuration gives it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, files = _files(spark, path)
    return files.exists(hadoop)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    hadoop, files = _files(spark, path)
    return [f.getPath().getName() for f in files.listStatus(hadoop)] if files.exists(hadoop) else []


def remove(spark: SparkSession, path: str) -> None:
    hadoop, files = _files(spark, path)
    files.delete(hadoop, True)


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; the old one goes when the new one is there."""
    target, files = _files(spark, path)
    source, _ = _files(spark, new)
    old, _ = _files(spark, f"{new}-old")
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(source, target):
        files.rename(old, target)
        raise OSError(f"cannot move {new} to {path}")
    files.delete(old, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives lost executors, and its file sizes tell Spark whether it is small
    enough to broadcast.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="fareflow-code-")) / "fareflow.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
