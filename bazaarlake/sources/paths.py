"""Small file-system helpers for any file system Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path, _ = _open(spark, path)
    return fs.exists(hadoop_path)


def files_in(spark: SparkSession, folder: str) -> list[str]:
    """Full names of the plain files directly in a folder, sorted."""
    fs, hadoop_path, _ = _open(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    found = [s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isFile()]
    return sorted(f for f in found if not f.rsplit("/", 1)[1].startswith((".", "_")))


def folders_in(spark: SparkSession, folder: str) -> list[str]:
    fs, hadoop_path, _ = _open(spark, folder)
    found = [s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return sorted(f for f in found if not f.rsplit("/", 1)[1].startswith((".", "_")))


def size_of(spark: SparkSession, folder: str) -> int:
    """Bytes in a folder and below."""
    fs, hadoop_path, _ = _open(spark, folder)
    return fs.getContentSummary(hadoop_path).getLength()


def head(spark: SparkSession, path: str, limit: int) -> bytes:
    """The first ``limit`` bytes of a file."""
    fs, hadoop_path, jvm = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
            jvm.org.apache.commons.io.input.BoundedInputStream(stream, limit)
        ))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A text file as a whole."""
    fs, hadoop_path, jvm = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside the target and renames, so readers see no text or all of it.

    A target that is there already, or a rename that does not happen, is an error.
    """
    fs, hadoop_path, jvm = _open(spark, path)
    if fs.exists(hadoop_path):
        raise FileExistsError(path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}.next")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(aside, hadoop_path):
        fs.delete(aside, False)
        raise FileExistsError(path)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Renames a file; a target that is there already is an error."""
    fs, hadoop_path, jvm = _open(spark, path)
    if not fs.rename(hadoop_path, jvm.org.apache.hadoop.fs.Path(target)):
        raise FileExistsError(target)


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, hadoop_path, _ = _open(spark, folder)
    fs.mkdirs(hadoop_path)
