"""Lines of byte ranges of text files in UTF-8 or UTF-16, read inside tasks.

A range [start, end) of a file owns the lines that begin in it, so ranges that
cover a file give each line once, whatever their size. UTF-16 is cut at code
units, never at bytes: U+4E0A (byte 0A) or a pair such as U+0A85 U+4E00 (bytes
0A 00 across two characters) does not end a line. Lines end at LF, CR LF or a lone
CR, as Python's text reader has it; malformed sequences are dropped, as its
``errors="ignore"`` does. Bytes beyond ``size`` do not exist for a reader."""

from __future__ import annotations

import io
import pathlib
import re
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 18
#: What one task reads of a file.
RANGE_BYTES = 32 << 20
#: What opening a file costs, in bytes read in the same time (as Spark's own file sources have it).
OPEN_BYTES = 4 << 20
#: The byte-order marks of UTF-16.
MARKS = {b"\xff\xfe": "UTF-16LE", b"\xfe\xff": "UTF-16BE"}


def store_of(uri: str):
    """(file system, path there, what precedes such paths in a URI) for a path or
    an unescaped URI of a store that pyarrow knows."""
    from pyarrow import fs

    m = re.fullmatch(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)", uri, re.DOTALL)
    if not m:
        return fs.LocalFileSystem(), uri, ""
    scheme, host, path = m[1].lower(), m[2] or "", m[3]
    if scheme == "file":
        return fs.LocalFileSystem(), path, "file:"
    known = "s3" if scheme in ("s3a", "s3n") else scheme
    system, base = fs.FileSystem.from_uri(f"{known}://{host}/")
    base = base.rstrip("/")  # the bucket, where the store puts it in the path
    return system, base + path, f"{m[1]}://{host}"[:len(f"{m[1]}://{host}") - len(base)]


def open_read(uri: str):
    """A seekable stream of a file."""
    system, path, _ = store_of(uri)
    return system.open_input_file(path)


def encoding_of(head: bytes) -> str:
    return MARKS.get(head[:2], "UTF-8")


class LineCutter:
    """Line ends in a file of ``size`` bytes; ``encoding`` None goes by its mark."""

    def __init__(self, stream, size: int, encoding: str | None = None):
        self.stream, self.size = stream, size
        head = self._read(0, 2)
        self.encoding = encoding = encoding or encoding_of(head)
        self.first = 2 if encoding == MARKS.get(head) else 0
        self.unit = 1 if encoding == "UTF-8" else 2
        self.kind = {"UTF-8": "u1", "UTF-16LE": "<u2", "UTF-16BE": ">u2"}[encoding]

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(max(0, min(n, self.size - at)))

    def ends(self, data: bytes, final: bool):
        """Offsets in ``data`` just after each newline. A CR at the very end is one
        only if nothing can follow it."""
        import numpy as np

        u = np.frombuffer(data, self.kind, len(data) // self.unit)
        feed, ret = u == 10, u == 13
        before_feed = np.zeros(len(u), bool)
        before_feed[:-1] = feed[1:]
        if len(u) and not final:
            before_feed[-1] = True
        return (np.flatnonzero(feed | (ret & ~before_feed)) + 1) * self.unit

    def line_start(self, at: int) -> int:
        """The first line start at or after ``at``; the size where no line begins there."""
        if at <= self.first:
            return self.first
        pos = at - (at - self.first) % self.unit - self.unit
        while pos < self.size:
            data = self._read(pos, BLOCK)
            final = pos + len(data) >= self.size
            found = self.ends(data, final)
            found = found[pos + found >= at]
            if len(found):
                return int(pos + found[0])
            if final:
                break
            pos += len(data) - self.unit  # a CR at the end is looked at again
        return self.size

    def last_line_end(self, low: int) -> int:
        """The end of the last finished line, ``low`` where none ends after it."""
        high = self.size - (self.size - self.first) % self.unit
        while high > low:
            start = max(low, high - BLOCK)
            start -= (start - low) % self.unit
            data = self._read(start, high - start + self.unit)
            found = self.ends(data, False)
            found = found[start + found <= self.size]
            if len(found):
                return int(start + found[-1])
            high = start
        return low

    def lines(self, start: int, end: int) -> Iterator[list[str]]:
        """Lists of the lines in [start, end), both line starts."""
        held: list[bytes] = []  # of a line that is longer than a block
        while start < end:
            data = self._read(start, min(BLOCK, end - start))
            if not data:
                break
            start += len(data)
            if start < end:
                found = self.ends(data, False)
                if not len(found):
                    held.append(data)
                    continue
                data, rest = data[:found[-1]], data[found[-1]:]
            else:
                rest = b""
            yield self._split(b"".join([*held, data]))
            held = [rest] if rest else []
        if held:
            yield self._split(b"".join(held))

    def _split(self, data: bytes) -> list[str]:
        text = data.decode(self.encoding.lower(), "ignore").replace("\r\n", "\n").replace("\r", "\n")
        if not text:  # malformed bytes at the end of the file are no line
            return []
        return (text[:-1] if text.endswith("\n") else text).split("\n")


def read_range(uri: str, size: int, start: int, end: int, encoding: str | None = None) -> Iterator[list[str]]:
    """Lines that begin in [start, end) of a file of ``size`` bytes."""
    with open_read(uri) as stream:
        cutter = LineCutter(stream, size, encoding)
        yield from cutter.lines(cutter.line_start(start), cutter.line_start(end))


def range_tasks(files: DataFrame, range_bytes: int = RANGE_BYTES) -> int:
    """How many tasks read ``files`` (path, length): about ``range_bytes`` each, and
    no fewer than the cores where there are ranges enough."""
    size = F.col("length").cast("long")
    ranges = F.ceil(size / range_bytes)
    cost = size + F.least(F.lit(OPEN_BYTES), F.lit(range_bytes)) * (ranges > 0).cast("int")
    n, total = files.agg(F.sum(ranges), F.sum(cost)).first()
    return max(1, min(n or 0, files.sparkSession.sparkContext.defaultParallelism), -(-(total or 0) // range_bytes))


def read_ranges(files: DataFrame, encoding: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, line) of whole files, given as (path, length), range by range: a
    large file is read by many tasks. Batch and streaming.

    The shuffle that deals ranges to tasks has a number of partitions. Without one
    adaptive execution goes by its bytes, three short fields a range, and gives one
    task all lines. A stream's sizes are not known when it is planned; it takes the
    session's shuffle partitions (``files.landing_lines`` reads a batch of it by its
    own size)."""
    import pyarrow as pa

    spark = files.sparkSession
    ship_package(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) if files.isStreaming else range_tasks(files, range_bytes)
    size = F.col("length").cast("long")
    ranges = files.where(size > 0).select("path", size.alias("length"), F.explode(
        F.sequence(F.lit(0).cast("long"), size - 1, F.lit(range_bytes).cast("long"))).alias("start"))

    def run(batches):
        for b in batches:
            for path, length, start in zip(*(c.to_pylist() for c in b.columns)):
                for lines in read_range(path, length, start, min(length, start + range_bytes), encoding):
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), pa.array(lines, pa.string())],
                                                     ["path", "line"])

    # in turn, so that no task gets many ranges while others get none
    return ranges.repartition(tasks).mapInArrow(run, "path string, line string")


def encodings(files: DataFrame) -> DataFrame:
    """(path, length, encoding) by the first two bytes of each file, read in tasks."""
    import pyarrow as pa

    ship_package(files.sparkSession)

    def run(batches):
        for b in batches:
            found = []
            for path in b.column(0).to_pylist():
                with open_read(path) as stream:
                    found.append(encoding_of(stream.read(2)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string())], ["path", "length", "encoding"])

    return files.select("path", "length").mapInArrow(run, "path string, length long, encoding string")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application."""
    from ..session import work_path
    from . import fs

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = pathlib.Path(__file__).resolve().parents[2]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted((top / "loglane").rglob("*.py")):
            z.write(p, p.relative_to(top))
    uri = work_path(spark, "packages", f"sources-{app}.zip")
    if not fs.exists(spark, uri):
        fs.write_bytes(spark, uri, data.getvalue())
    spark.sparkContext.addPyFile(uri)
    _SHIPPED.add(app)
