"""A streaming source for files that are still being written.

``tail_stream`` follows every file of a folder (or one file). Its offset is, per
file, the end of the last finished line, so each line is delivered once, in
whichever encoding the file has; the half-written last line waits for its
newline. After a restart the checkpoint's offsets say where to go on.

``start="latest"`` skips what is there at the first start, as a tail does;
``"earliest"`` reads it. A folder that is missing or empty is waited for. A file
that is shorter than its offset was truncated or replaced and is read anew; a
file that is gone is forgotten. Files without a finished line have no offset
yet. The offset has an entry per file: meant for logs that are being written,
with finished ones moved away or read through ``files.landing_stream``."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .ranges import RANGE_BYTES, LineCutter, open_read, ship_package, store_of

FORMAT = "loglane_tail"


def listing(uri: str) -> dict[str, int]:
    """Sizes of the files at ``uri`` (a folder's, or the file's own); names that
    begin with ``_`` or ``.`` are left out, and so are folders inside."""
    from pyarrow import fs

    system, path, before = store_of(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        return {}
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path))
    return {before + f.path: f.size for f in found
            if f.type == fs.FileType.File and not os.path.basename(f.path).startswith(("_", "."))}


class FileRange(InputPartition):
    def __init__(self, path: str, size: int, start: int, end: int):
        self.path, self.size, self.start, self.end = path, size, start, end


class TailReader(DataSourceStreamReader):
    def __init__(self, path: str, start: str, range_bytes: int):
        self.path, self.start, self.range_bytes = path, start, range_bytes
        self._known: dict[str, tuple[int, int]] = {}  # size seen, end of its last finished line

    def _ends(self) -> dict[str, int]:
        now = {}
        for name, size in listing(self.path).items():
            seen = self._known.get(name)
            if not seen or seen[0] != size:
                with open_read(name) as stream:
                    cutter = LineCutter(stream, size)
                    # what was finished stays so, unless the file began anew
                    low = seen[1] if seen and seen[0] <= size else cutter.first
                    seen = (size, cutter.last_line_end(low))
            now[name] = seen
        self._known = now
        return {name: end for name, (_, end) in now.items()}

    def initialOffset(self) -> dict:
        return self._ends() if self.start == "latest" else {}

    def latestOffset(self) -> dict:
        return self._ends()

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        out = []
        for name, stop in sorted(end.items()):
            at = start.get(name, 0)
            at = 0 if at > stop else at
            while at < stop:
                out.append(FileRange(name, stop, at, min(stop, at + self.range_bytes)))
                at += self.range_bytes
        return out

    def read(self, part: FileRange) -> Iterator:
        import pyarrow as pa

        with open_read(part.path) as stream:
            cutter = LineCutter(stream, part.size)
            for lines in cutter.lines(cutter.line_start(part.start), cutter.line_start(part.end)):
                yield pa.RecordBatch.from_arrays([pa.array([part.path] * len(lines)), pa.array(lines, pa.string())],
                                                 ["path", "line"])

    def commit(self, end: dict) -> None:
        """Nothing is kept besides the checkpoint."""

    def stop(self) -> None:
        """Nothing is open between batches."""


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, line string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options["path"], self.options.get("start", "earliest"),
                          int(self.options.get("rangebytes", RANGE_BYTES)))


def tail_stream(spark: SparkSession, path: str, start: str = "earliest", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Streaming (file_name, line) of the finished lines that files gain."""
    from pyspark.sql import functions as F

    from .files import file_name_of

    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, not {start}")
    ship_package(spark)
    spark.dataSource.register(TailSource)
    lines = (spark.readStream.format(FORMAT).option("path", path).option("start", start)
             .option("rangebytes", str(range_bytes)).load())
    return lines.select(file_name_of(F.col("path")).alias("file_name"), "line")
