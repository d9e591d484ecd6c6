"""File system calls through Hadoop, so that every storage Spark can read works."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def exists(spark: SparkSession, location: str) -> bool:
    files, path = _resolve(spark, location)
    return files.exists(path)


def entries(spark: SparkSession, location: str) -> Iterator[tuple[str, bool]]:
    """(name, whether it is a file) of what lies directly in a folder; nothing if it is missing."""
    files, path = _resolve(spark, location)
    if files.exists(path):
        found = files.listStatusIterator(path)
        while found.hasNext():
            entry = found.next()
            yield entry.getPath().getName(), entry.isFile()


def holds_files(spark: SparkSession, location: str) -> bool:
    """Whether data files lie in the folder itself rather than in partition folders."""
    return any(
        is_file and not name.startswith(("_", ".")) for name, is_file in entries(spark, location)
    )


def footprint(spark: SparkSession, location: str, without: Sequence[str] = ()) -> list[int]:
    """Number and bytes of the files below a folder, but for its subfolders ``without``; zeros if it is missing.

    One call of the file system, whatever the number of files.
    """
    files, path = _resolve(spark, location)
    if not files.exists(path):
        return [0, 0]
    found = files.getContentSummary(path)
    held = [found.getFileCount(), found.getLength()]
    for name in without:
        held = [a - b for a, b in zip(held, footprint(spark, f"{location}/{name}"), strict=True)]
    return held


def write_text(spark: SparkSession, location: str, text: str) -> None:
    """Replace a small file. A reader may see it half written."""
    files, path = _resolve(spark, location)
    out = files.create(path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, location: str) -> str | None:
    """A small file; nothing in it counts if its checksum tells that it was half written."""
    files, path = _resolve(spark, location)
    if not files.exists(path):
        return None
    source = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "ChecksumException":
            raise
        return ""
    finally:
        source.close()


def delete(spark: SparkSession, location: str) -> None:
    """Delete a folder and what is in it."""
    files, path = _resolve(spark, location)
    files.delete(path, True)
