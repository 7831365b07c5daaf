"""Directory listings through the Hadoop file system, so any Spark-readable store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    fs, path = _open(spark, location)
    return fs.exists(path)


def qualified(spark: SparkSession, location: str) -> str:
    """The full path, however it was written."""
    fs, path = _open(spark, location)
    return fs.makeQualified(path).toString()


def remove(spark: SparkSession, location: str) -> None:
    fs, path = _open(spark, location)
    fs.delete(path, True)


def child_names(spark: SparkSession, base: str, dirs_only: bool = False) -> list[str]:
    """Names right below ``base``, sorted."""
    fs, path = _open(spark, base)
    return sorted(
        status.getPath().getName()
        for status in fs.listStatus(path)
        if status.isDirectory() or not dirs_only
    )


def join_path(base: str, *names: str) -> str:
    return "/".join([base.rstrip("/"), *names])


def part_files(spark: SparkSession, location: str) -> list[str]:
    """The file itself, or the files right below a folder that Spark reads, sorted."""
    fs, path = _open(spark, location)
    if not fs.getFileStatus(path).isDirectory():
        return [fs.makeQualified(path).toString()]
    found = [s.getPath() for s in fs.listStatus(path) if not s.isDirectory() and s.getLen() > 0]
    return sorted(p.toString() for p in found if p.getName()[0] not in "._")


def file_ends(spark: SparkSession, location: str, head: int, tail: int) -> tuple[bytes, bytes, bool]:
    """(first bytes, last bytes, whether the first are all there are); a compressed file has no last bytes."""
    fs, path = _open(spark, location)
    codecs = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()
    )
    codec = codecs.getCodec(path)
    size = fs.getFileStatus(path).getLen()
    stream = fs.open(path)
    try:
        if codec is not None:
            first = bytes(codec.createInputStream(stream).readNBytes(head))
            return first, b"", len(first) < head
        first = bytes(stream.readNBytes(head))
        if size <= head:
            return first, first[-tail:], True
        stream.seek(size - tail)
        return first, bytes(stream.readNBytes(tail)), False
    finally:
        stream.close()
