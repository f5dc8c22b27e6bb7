"""One way from a path to its storage, for Spark, for the driver and for tasks.

Spark resolves a path without a scheme against its default file system, so the same string must
not mean an executor's own disk. Jobs call :func:`qualified` on the driver and hand full URIs to
their tasks; a task opens them with one client per storage.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

#: Hadoop's names of schemes that Arrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark reads it with, without a slash at the end."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(hadoop_path).toString()
    return uri if uri.endswith(":/") else uri.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(hadoop(target), True)
    if not system.rename(hadoop(source), hadoop(target)):
        raise OSError(f"cannot rename {source} to {target}")


_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$", re.S)


def local_path(path: str) -> str | None:
    """The path on this machine's disk, or None for another storage."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if _URI.match(path) else path


class Clients:
    """File systems of a process, opened once for each scheme and authority."""

    def __init__(self) -> None:
        self.opened: dict[tuple[str, str], object] = {}

    def at(self, path: str) -> tuple[object, str]:
        """File system and path within it."""
        from pyarrow import fs

        own, uri = local_path(path), _URI.match(path)
        if own is not None or uri is None:
            scheme, authority, inner = "file", "", own or path
        else:
            scheme, authority, inner = SCHEMES.get(uri[1], uri[1]), uri[2] or "", uri[3] or "/"
        key = (scheme, authority)
        if key not in self.opened:
            whole = f"{scheme}://{authority}/"
            self.opened[key] = fs.LocalFileSystem() if scheme == "file" else fs.FileSystem.from_uri(whole)[0]
        return self.opened[key], f"{authority}{inner}" if scheme in ("s3", "gs", "gcs") else inner
