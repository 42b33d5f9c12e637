"""Small files and folders on any file system that the session reaches, by way of its own file system API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.delete(at, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.deleteOnExit(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text at once, in place of what was there.

    On an object store that is one request, after which readers see the new text, and before the old.
    """
    files, at = _at(spark, path)
    stream = files.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def get(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    if not exists(spark, path):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0].value if rows else ""


def stamp(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files at or below a path: another stamp, other input."""
    files, at = _at(spark, path)
    found, listed = [], files.listFiles(at, True)
    while listed.hasNext():
        status = listed.next()
        found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return "\n".join(sorted(found))
