"""WARC writing and sequential reading.

Writing: each Spark task appends its pages to archives in the shared folder,
one gzip member per record. A page whose payload (the html in UTF-8) equals
that of a page with a smaller id becomes a ``revisit`` record without payload.

Reading: a sequential reader feeds an archive through incremental zlib
decompression, starts a new record at each gzip member, frames the block by
its Content-Length and verifies block and payload digests. It holds one record
at a time, so memory does not grow with the archive.

Defined results: null html is an empty payload; payloads under
``MIN_REVISIT_BYTES`` are always responses; rows that repeat the smallest
page_id of a group are all responses; a null page_id counts as larger than any
other and, in a group of null ids only, every row is a response; null urls
give records without a target. Extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import open_file, read_table, scratch, ship_package, stored

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
RECORD_DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that does not frame or whose digests do not agree."""


def _member(kind: str, block: bytes, fields: list[tuple[str, str]]) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {RECORD_DATE}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
            *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def _http(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    part = (urn or "").rpartition(":")[2].rstrip(">")
    return int(part) if part not in ("", "null") else None


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit where ``refers_to`` is set."""
    fields = [("WARC-Record-ID", page_urn(page_id)), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is None:
        return _member("response", _http(len(payload)) + payload, fields)
    fields += [("WARC-Refers-To", page_urn(refers_to)), ("WARC-Profile", PROFILE)]
    return _member("revisit", _http(len(payload)), fields)


def members(stream) -> Iterator[bytes]:
    """Uncompressed gzip members of a stream, one at a time."""
    z, out, fed = zlib.decompressobj(31), bytearray(), False
    data = stream.read(CHUNK)
    while data:
        try:
            out += z.decompress(data)
        except zlib.error as e:
            raise WarcError(f"bad gzip member: {e}") from None
        fed = True
        data = z.unused_data
        if z.eof:
            yield bytes(out)
            z, out, fed = zlib.decompressobj(31), bytearray(), False
        data = data or stream.read(CHUNK)
    if fed:
        raise WarcError("the last gzip member is cut off")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block, framed and verified."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not fields.get("content-length", "").isdecimal():
        raise WarcError("no usable Content-Length")
    n = int(fields["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise WarcError("the block does not end where its length says")
    if fields.get("warc-block-digest") != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise WarcError("block digest differs")
    return fields, block


def read_records(stream) -> Iterator[dict]:
    """Page records of an archive in order: page_id, url, record_type,
    refers_to, payload (None for revisits), payload_bytes, payload_digest."""
    for raw in members(stream):
        fields, block = parse_record(raw)
        if fields["warc-type"] not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n")
                    if x.lower().startswith(b"content-length:"))
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        response = fields["warc-type"] == "response"
        if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise WarcError("payload differs from its length or digest")
        yield {"page_id": page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
               "record_type": fields["warc-type"],
               "refers_to": page_of(fields.get("warc-refers-to")),
               "payload": payload if response else None, "payload_bytes": size,
               "payload_digest": digest}


def mark_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is set for pages
    whose payload a page with a smaller id has.

    Only groups of equal payloads with several ids take part in the join; they
    are narrow rows, written first so that their size is known to the planner."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                     F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    groups = (p.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and first_id is not null").select("digest", "first_id"))
    p = p.join(stored(groups, "warc-groups"), "digest", "left")
    later = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return p.select("page_id", "url", "payload", "digest",
                    F.when(later, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page under ``folder``; the manifest (archive, records)
    lists the archives of the task attempts that counted."""

    ship_package(pages.sparkSession)

    def write(batches):
        from pyspark import TaskContext

        t = TaskContext.get()
        names, counts, out, size = [], [], None, 0
        info = _member("warcinfo", b"format: WARC File Format 1.1\r\n",
                       [("WARC-Record-ID", "<urn:page:null>"), ("Content-Type", "application/warc-fields")])
        for b in batches:
            cols = [b.column(i) for i in range(5)]
            for i in range(b.num_rows):
                if out is None:
                    names.append(f"{folder}/part-{t.partitionId():05d}-{t.taskAttemptId()}-{len(names):04d}.warc.gz")
                    counts.append(0)
                    out, size = open_file(names[-1], write=True), 0
                    out.write(info)
                record = page_record(*(c[i].as_py() for c in cols))
                out.write(record)
                counts[-1] += 1
                size += len(record)
                if size >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())],
                                         ["archive", "records"])

    manifest = mark_revisits(pages).mapInArrow(write, "archive string, records long")
    return stored(manifest, "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives that ``manifest`` lists, an archive at a time in each task."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    ddl = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    if with_payload:
        names, types, ddl = [*names, "payload"], [*types, pa.binary()], ddl + ", payload binary"

    ship_package(manifest.sparkSession)

    def read(batches):
        for b in batches:
            for archive, expected in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen, rows, size = 0, [], 0
                with open_file(archive) as stream:
                    for r in read_records(stream):
                        rows.append(r)
                        seen += 1
                        size += len(r["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)
                if seen != expected:
                    raise WarcError(f"{archive} holds {seen} records, not {expected}")

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, types)], names)

    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(read, ddl)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(read_table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return read_archives(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


#: The same rows from the page table itself.
SQL = {"op8_warc": """
with p as (
  select page_id, url, encode(coalesce(html, '')) as payload, sha256(coalesce(html, '')) as d
  from pages),
f as (
  select d, min(page_id) as first_id from p where octet_length(payload) >= 100 group by d having count(*) > 1)
select p.page_id, octet_length(p.payload)::bigint as payload_bytes, p.d as payload_digest,
       case when f.first_id is not null and p.page_id is distinct from f.first_id then 'revisit' else 'response' end as record_type,
       case when f.first_id is not null and p.page_id is distinct from f.first_id then f.first_id end as refers_to,
       p.url
from p left join f on p.d = f.d"""}
