"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import pathlib
import re
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

#: Bytes of text that one step inside a Python task handles at a time.
STEP_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return work_path(spark, "llm", f"{tag}-{uuid.uuid4().hex[:12]}")


def open_file(uri: str, write: bool = False):
    """A stream of a file in the shared folder, whatever store holds it."""
    from pyarrow import fs

    if ":" in uri.partition("/")[0]:
        known = re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", uri))  # as pyarrow spells them
        system, path = fs.FileSystem.from_uri(known)
    else:
        system, path = fs.LocalFileSystem(), uri
    if write:
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return system.open_output_stream(path)
    return system.open_input_stream(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = pathlib.Path(__file__).resolve().parents[2]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted((top / "loglane").rglob("*.py")):
            z.write(p, p.relative_to(top))
    uri = scratch(spark, "package") + ".zip"
    with open_file(uri, write=True) as out:
        out.write(data.getvalue())
    spark.sparkContext.addPyFile(uri)
    _SHIPPED.add(app)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps neither
    recompute it nor depend on executors that may be lost."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` in each
    (a single longer value stays whole)."""
    import numpy as np

    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        n = batch.num_rows
        if not n:
            continue
        sizes = np.zeros(n, np.int64) if col.nbytes <= max_bytes else _byte_lengths(col)
        ends = np.cumsum(sizes)
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _byte_lengths(col: pa.Array):
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype("int64")


def slice_count(docs: DataFrame, column: str, slice_bytes: int) -> int:
    """How many slices of about ``slice_bytes`` the text column makes."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, -(-int(total) // slice_bytes))


def free_name(columns: list[str], name: str) -> str:
    """``name``, or the first longer one that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_slice(docs: DataFrame, n: int) -> DataFrame:
    """(slice, doc_id, text): each document to one of ``n`` slices by its id and
    text, so an id that many texts share is spread. Text is never null."""
    return docs.select(F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(n)).cast("int").alias("slice"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))


def pack_arrays(*arrays) -> bytes:
    """Numpy arrays as one compressed value (see ``unpack_arrays``)."""
    import numpy as np
    import zstandard

    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *(a.tobytes() for a in arrays)]))


def unpack_arrays(value: bytes) -> list:
    import numpy as np
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 1 + 2 * n)
    out, at = [], head.nbytes
    for code, size in head[1:].reshape(n, 2).tolist():
        out.append(np.frombuffer(raw, np.dtype(chr(code)), size, at))
        at += out[-1].nbytes
    return out


def keyed_table(keys: list[int], others: list[int], values: list[bytes], names: list[str]) -> pa.Table:
    """An Arrow table of (key int, other int, value binary)."""
    return pa.table([pa.array(keys, pa.int32()), pa.array(others, pa.int32()), pa.array(values, pa.binary())], names)
