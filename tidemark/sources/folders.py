"""Files of a folder, through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _open(spark, path)
    return system.exists(where)


def entries(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(full path, bytes, time of change in ms)`` of what lies directly in a folder, by name; none if it isn't there."""
    system, where = _open(spark, path)
    if not system.exists(where):
        return []
    found = [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in system.listStatus(where)]
    return sorted(found)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files under a folder."""
    system, where = _open(spark, path)
    return system.getContentSummary(where).getLength()


def tree(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """``(full path, bytes)`` of every file under a folder; hidden ones are left out."""
    system, where = _open(spark, path)
    found, files = [], system.listFiles(where, True)
    while files.hasNext():
        status = files.next()
        if status.getPath().getName()[0] not in "._":
            found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a whole folder; nothing happens if it isn't there."""
    system, where = _open(spark, path)
    system.delete(where, True)
