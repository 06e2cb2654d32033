"""Small file-system helpers through Hadoop's FileSystem, so the same code
works on local disk, HDFS and object stores (driver-side metadata calls)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p)
    return path


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isDirectory())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it is missing)."""
    fs, p = _fs_path(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes, overwrite: bool = False) -> None:
    """A small file; an existing one is an error unless it may be replaced."""
    fs, p = _fs_path(spark, path)
    stream = fs.create(p, overwrite)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    write_bytes(spark, path, text.encode("utf-8"), overwrite)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs_path(spark, src)
    return bool(fs.rename(s, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)))


def signature(spark: SparkSession, path: str) -> str:
    """Size and modification time of a file or folder (summed over files)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return "missing"
    st = fs.getFileStatus(p)
    if not st.isDirectory():
        return f"{st.getLen()}:{st.getModificationTime()}"
    summary = fs.getContentSummary(p)
    return f"{summary.getLength()}:{summary.getFileCount()}:{st.getModificationTime()}"
