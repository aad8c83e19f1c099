"""Folder-level operations on any Hadoop-compatible store (HDFS, S3A, GCS, local).

Used for the few things the DataFrame API does not cover: listing partition
folders (so run days come from metadata, not from scanning data), removing
folders, and existence checks.  Goes through the
session's Hadoop FileSystem via the JVM gateway, the usual PySpark way.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession


def _path_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path_fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder if it is there."""
    p, fs = _path_fs(spark, path)
    fs.delete(p, True)


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of ``root/column=value`` sub-folders, sorted (metadata only)."""
    base, fs = _path_fs(spark, root)
    if not fs.exists(base):
        return []
    prefix = column + "="
    return sorted(st.getPath().getName()[len(prefix):] for st in fs.listStatus(base)
                  if st.isDirectory() and st.getPath().getName().startswith(prefix))


def partition_days(spark: SparkSession, root: str, column: str = "ingestion_date") -> list[str]:
    """Valid ISO-date values of ``root/column=YYYY-MM-DD`` folders, sorted."""
    days = []
    for value in partition_values(spark, root, column):
        try:
            if len(value) == 10 and date.fromisoformat(value):
                days.append(value)
        except ValueError:
            continue
    return days


def _children(fs, path) -> list:
    return [st.getPath() for st in fs.listStatus(path)] if fs.exists(path) else []


def _rename(fs, src, dst) -> None:
    if not fs.rename(src, dst):
        raise OSError(f"could not move {src} to {dst}")


def partition_folders(spark: SparkSession, root: str, column: str) -> list[tuple[str, str, int]]:
    """(path, value, time of change in milliseconds) of the ``root/column=value`` sub-folders."""
    base, fs = _path_fs(spark, root)
    if not fs.exists(base):
        return []
    prefix = column + "="
    return sorted((st.getPath().toString(), st.getPath().getName()[len(prefix):], st.getModificationTime())
                  for st in fs.listStatus(base) if st.isDirectory() and st.getPath().getName().startswith(prefix))


def name_files(spark: SparkSession, folder: str, stem: str, suffix: str) -> None:
    """Rename the data files of one folder to ``stem-<k><suffix>`` (in name order)."""
    base, fs = _path_fs(spark, folder)
    names = sorted(p.getName() for p in _children(fs, base) if p.getName().endswith(suffix))
    for k, name in enumerate(n for n in names if not n.startswith((".", "_"))):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        _rename(fs, path(base, name), path(base, f"{stem}-{k}{suffix}"))


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Create (or replace) one small file."""
    p, fs = _path_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create (or replace) one small text file."""
    write_bytes(spark, path, text.encode("utf-8"))
