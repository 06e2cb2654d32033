"""Line sources over files: day files, landing folders, encodings.

Everything returns (file_name, line) DataFrames read by Spark in parallel
splits, each file in the encoding that its mark tells; the driver reads
nothing but names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lossy_utf8

_BOMS = {b"\xff\xfe": "UTF-16LE", b"\xfe\xff": "UTF-16BE"}


def _head_bytes(spark: SparkSession, path: str, n: int = 2) -> bytes:
    """First bytes of a file through the Hadoop file system of the path
    (works for local, HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(p)
    try:
        out = bytearray()
        for _ in range(n):
            b = stream.read()
            if b < 0:
                break
            out.append(b)
        return bytes(out)
    finally:
        stream.close()


def detect_encoding(spark: SparkSession, path: str) -> str:
    """``UTF-16LE``/``UTF-16BE`` when the file starts with a UTF-16 byte-order
    mark, else ``UTF-8`` (also for a folder, whose files may differ: see
    ``encoding_manifest``)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p) or fs.getFileStatus(p).isDirectory():
        return "UTF-8"
    return _BOMS.get(_head_bytes(spark, path), "UTF-8")


def file_name_of(path_col: Column) -> Column:
    """Day-file name from a path (also inside ``file_name=...`` folders)."""
    name = F.regexp_extract(path_col, r"(trading_\d{8}\.log)", 1)
    return F.when(name != "", name).otherwise(F.regexp_extract(path_col, r"([^/]+)$", 1))


#: The columns of Spark's binary file source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, modificationTime) of the files below ``path``; no content is read."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def encoding_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, encoding) of the files below ``path``, by their marks. Tasks
    read two bytes of each; the driver does where pyarrow does not know the store."""
    from .ranges import encodings, store_of

    try:
        for p in [path] if isinstance(path, str) else path:
            store_of(p)
    except (OSError, ValueError, ImportError):  # pyarrow.lib.ArrowInvalid is a ValueError
        rows = [(r["path"], r["length"], _BOMS.get(_head_bytes(spark, r["path"]), "UTF-8")) for r in listed(spark, path).collect()]
        return spark.createDataFrame(rows, "path string, length long, encoding string")
    return encodings(listed(spark, path))


def _named(lines: DataFrame, path: Column) -> DataFrame:
    return lines.select(file_name_of(path).alias("file_name"), "line")


def _utf8_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _named(spark.read.format("text").load(path).withColumn("line", lossy_utf8(F.col("value"))),
                  F.col("_metadata.file_path"))


def read_lines(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """(file_name, line) from a text file or folder. Each file is read in its own
    encoding, by its byte-order mark; ``encoding`` overrides the marks. Files in
    UTF-8 are scanned by the text source; those in UTF-16 range by range, cut at
    code units (``ranges``).

    Lines end where Python's reader ends them (LF, CR LF, lone CR); blank lines
    are kept, invalid sequences and the mark are dropped."""
    from .ranges import read_ranges

    if encoding and encoding.upper() != "UTF-8":
        return _named(read_ranges(listed(spark, path), encoding.upper()), F.col("path"))
    if encoding:
        return _utf8_lines(spark, path)
    found = encoding_manifest(spark, path)
    # names only, as the file index itself holds; most folders have no wide file
    wide = found.where("encoding != 'UTF-8'").select("path", "length").collect()
    if not wide:
        return _utf8_lines(spark, path)
    paths = {r["path"] for r in wide}
    files = spark.createDataFrame([tuple(r) for r in wide], "path string, length long")
    lines = _named(read_ranges(files), F.col("path"))
    rest = [r["path"] for r in listed(spark, path).select("path").collect() if r["path"] not in paths]
    return lines.unionByName(_utf8_lines(spark, rest)) if rest else lines


def read_day_file(spark: SparkSession, path: str) -> DataFrame:
    """One trading day file, in whichever encoding it was written."""
    return read_lines(spark, path)


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Create a landing folder if it is missing, so a stream can start before
    the first file arrives (instead of waiting for it)."""
    from .fs import mkdirs
    return mkdirs(spark, path)


def landing_files(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                  newer_than_ms: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming (path, length) of a landing folder's finished files; no content is
    read. Options as for ``landing_stream``, which reads their lines."""
    ensure_folder(spark, landing_dir)
    r = spark.readStream.format("binaryFile").schema(BINARY_FILE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = r.load(landing_dir).select("path", "length", "modificationTime")
    if newer_than_ms is not None:
        files = files.where(F.col("modificationTime") > F.timestamp_millis(F.lit(newer_than_ms)))
    return files.select("path", "length")


def landing_lines(batch: DataFrame) -> DataFrame:
    """(file_name, line) of one batch of ``landing_files``, by as many tasks as its
    bytes need. Names and lengths are collected, as the source itself holds them, so
    the batch's source is run once."""
    from .ranges import read_ranges

    rows = [tuple(r) for r in batch.select("path", "length").collect()]
    files = batch.sparkSession.createDataFrame(rows, "path string, length long")
    return _named(read_ranges(files), F.col("path"))


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                   newer_than_ms: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming (file_name, line) over a landing folder of finished files.

    The file source remembers which files it has read in its checkpoint,
    so a restart continues where it stopped. ``newer_than_ms`` keeps only
    files modified after that time (the "new lines only" start of a tail; files
    that still grow are ``tail.tail_stream``'s). With ``archive_dir``, files are
    moved there once read, which keeps the listing of each trigger short.

    The stream carries names and lengths; tasks read byte ranges of the files,
    each in its own encoding, as ``read_lines`` does. A ``foreachBatch`` sink takes
    ``landing_files`` and ``landing_lines`` instead, whose tasks go by the size of
    each batch."""
    from .ranges import read_ranges

    return _named(read_ranges(landing_files(spark, landing_dir, max_files_per_trigger, newer_than_ms, archive_dir)),
                  F.col("path"))


def lines_to_envelope(lines: DataFrame, topic: str | Column | None = None, key: Column | None = None) -> DataFrame:
    """Adapt (file_name, line) to the record envelope: value = line bytes,
    topic = the given name or the file stem, no partition/offset."""
    t = F.lit(topic) if isinstance(topic, str) else (topic if topic is not None else
                                                     F.regexp_replace(F.col("file_name"), r"\.[^.]*$", ""))
    return lines.select(
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        F.col("line").cast("binary").alias("value"), t.alias("topic"),
        F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))


def envelope_lines(envelope: DataFrame) -> DataFrame:
    """Envelope -> (topic, partition, offset, line); ``line`` is NULL when the
    value is missing or not valid UTF-8 (such records become rejects)."""
    return envelope.select("topic", "partition", "offset",
                           F.try_validate_utf8(F.col("value").cast("string")).alias("line"),
                           F.col("value").cast("string").alias("raw"))
