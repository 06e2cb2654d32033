"""Byte-range reading in three encodings, mixed folders, and files that grow."""

import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglane.sources import files, ranges
from loglane.sources.tail import listing, tail_stream
from loglane.streaming import ingest

MARKS = {"UTF-8": b"", "UTF-16LE": b"\xff\xfe", "UTF-16BE": b"\xfe\xff"}
#: Characters with a byte 0A or 0D, and pairs whose bytes hold a newline's across two characters.
AWKWARD = "a北上અ一Āਅ\r\nč\U0001f60a é"


def as_python_reads(data: bytes, encoding: str) -> list[str]:
    text = io.TextIOWrapper(io.BytesIO(data), encoding=encoding.lower(), errors="ignore", newline=None).read()
    lines = text.split("\n")
    return lines[:-1] if lines[-1] == "" else lines


def cut(data: bytes, encoding: str | None, starts: list[int]) -> list[str]:
    edges = sorted({0, len(data), *(s for s in starts if s < len(data))})
    out = []
    for a, b in zip(edges, edges[1:]):
        c = ranges.LineCutter(io.BytesIO(data), len(data), encoding)
        for part in c.lines(c.line_start(a), c.line_start(b)):
            out += part
    return out


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(sorted(MARKS)), st.text(AWKWARD, max_size=60), st.lists(st.integers(0, 200), max_size=6),
       st.sampled_from([6, 10, 1 << 18]), st.booleans())
def test_ranges_give_each_line_once(encoding, text, starts, block, torn):
    """Whatever the ranges and blocks, the lines are those of Python's reader."""
    body = text.encode(encoding) + (b"\xd8" if torn else b"")
    data, old = MARKS[encoding] + body, ranges.BLOCK
    ranges.BLOCK = block
    try:
        assert cut(data, None, starts) == as_python_reads(body, encoding)
    finally:
        ranges.BLOCK = old


@settings(max_examples=100, deadline=None)
@given(st.sampled_from(sorted(MARKS)), st.text(AWKWARD, min_size=1, max_size=60), st.integers(0, 140), st.sampled_from([6, 1 << 18]))
def test_the_last_finished_line_ends_at_a_newline(encoding, text, size, block):
    data, old = MARKS[encoding] + text.encode(encoding), ranges.BLOCK
    size = min(size, len(data))
    ranges.BLOCK = block
    try:
        c = ranges.LineCutter(io.BytesIO(data), size)
        end = c.last_line_end(c.first)
    finally:
        ranges.BLOCK = old
    if c.encoding != encoding:  # less than the mark is there
        return
    whole = data[c.first:end].decode(encoding)
    held = data[end:size - (size - c.first) % c.unit].decode(encoding, "ignore")
    assert whole == "" or whole[-1] in "\r\n"
    assert "\n" not in held and "\r" not in held[:-1]


def test_store_paths():
    assert ranges.store_of("/a b/c")[1:] == ("/a b/c", "")
    assert ranges.store_of("file:/a b/c")[1:] == ("/a b/c", "file:")
    assert ranges.store_of("file:///a%20b/c")[1:] == ("/a%20b/c", "file:")
    with pytest.raises((ValueError, OSError)):
        ranges.store_of("nosuchstore://host/path")


def _folder(tmp_dir, lines):
    folder = os.path.join(tmp_dir, "logs with space")
    os.makedirs(folder)
    for i, (encoding, mark) in enumerate(MARKS.items()):
        with open(os.path.join(folder, f"trading_2026031{i}.log"), "wb") as fh:
            fh.write(mark + "\n".join(lines).encode(encoding))
    open(os.path.join(folder, "trading_20260319.log"), "wb").close()
    return folder, sorted((f"trading_2026031{i}.log", x) for i in range(3) for x in lines)


def test_mixed_folder_in_small_ranges(spark, tmp_dir):
    r = random.Random(1)
    lines = ["".join(r.choice(AWKWARD.replace("\r", "").replace("\n", "")) for _ in range(r.randint(0, 40))) + "." for _ in range(200)]
    folder, want = _folder(tmp_dir, lines)
    found = {os.path.basename(x["path"]): x["encoding"] for x in files.encoding_manifest(spark, folder).collect()}
    assert found == {f"trading_2026031{i}.log": e for i, e in enumerate(MARKS)}  # Spark lists no empty files
    assert sorted(map(tuple, files.read_lines(spark, folder).collect())) == want
    small = ranges.read_ranges(files.listed(spark, folder), range_bytes=64)
    got = small.select(files.file_name_of(F.col("path")), "line").collect()
    assert sorted(map(tuple, got)) == want
    wide = files.read_lines(spark, os.path.join(folder, "trading_20260311.log"))
    assert [x["line"] for x in wide.collect()] == lines
    named = files.read_lines(spark, os.path.join(folder, "trading_20260312.log"), "utf-16be")
    assert [x["line"] for x in named.collect()] == lines


def test_manifest_without_a_known_store(spark, tmp_dir, monkeypatch):
    folder, want = _folder(tmp_dir, ["北上", "b"])
    monkeypatch.setattr(ranges, "store_of", lambda uri: (_ for _ in ()).throw(ValueError(uri)))
    found = {x["encoding"] for x in files.encoding_manifest(spark, folder).collect()}
    assert found == set(MARKS)


def _follow(spark, logs, tmp_dir, name, start="earliest", range_bytes=64):
    out = os.path.join(tmp_dir, name)
    q = ingest.start(tail_stream(spark, logs, start, range_bytes), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/n={n}"),
                     os.path.join(tmp_dir, name + "-ck"))
    q.awaitTermination()
    return sorted((r["file_name"], r["line"]) for r in spark.read.parquet(out).collect()) if os.path.exists(out) else []


def test_growing_files_give_each_line_once(spark, tmp_dir):
    """Append, restart, append: also the half-written line, in every encoding."""
    logs = os.path.join(tmp_dir, "logs")
    os.makedirs(logs)
    parts = ["eins 北上\nzwei\nhal", "f line\n\ndrei\r", "\nvier\nlast"]
    for step, part in enumerate(parts):
        for i, (encoding, mark) in enumerate(MARKS.items()):
            with open(os.path.join(logs, f"trading_2026031{i}.log"), "ab") as fh:
                fh.write((mark if step == 0 else b"") + part.encode(encoding))
        got = _follow(spark, logs, tmp_dir, "all")
        done = "".join(parts[:step + 1]).replace("\r\n", "\n")
        held = ["eins 北上", "zwei"] if step == 0 else ["eins 北上", "zwei", "half line", ""] if step == 1 else done.split("\n")[:-1]
        assert got == sorted((f"trading_2026031{i}.log", x) for i in range(3) for x in held)
    assert _follow(spark, logs, tmp_dir, "all") == got  # nothing new, nothing twice
    with open(os.path.join(logs, "trading_20260310.log"), "wb") as fh:
        fh.write(b"anew\n")  # truncated and begun again
    assert set(_follow(spark, logs, tmp_dir, "all")) - set(got) == {("trading_20260310.log", "anew")}


def test_tail_starts_at_the_end(spark, tmp_dir):
    logs = os.path.join(tmp_dir, "app.log")
    assert listing(logs) == {}
    with open(logs, "w") as fh:
        fh.write("old\nhal")
    assert _follow(spark, logs, tmp_dir, "new", "latest") == []
    with open(logs, "a") as fh:
        fh.write("f\nnew\n")
    assert _follow(spark, logs, tmp_dir, "new", "latest") == [("app.log", "half"), ("app.log", "new")]
    with pytest.raises(ValueError):
        tail_stream(spark, logs, "middle")


def test_a_missing_folder_is_waited_for(spark, tmp_dir):
    logs = os.path.join(tmp_dir, "later")
    assert _follow(spark, logs, tmp_dir, "w") == []
    os.makedirs(logs)
    with open(os.path.join(logs, "trading_20260318.log"), "w") as fh:
        fh.write("a\n")
    assert _follow(spark, logs, tmp_dir, "w") == [("trading_20260318.log", "a")]


def _readers(lines):
    return {r[0] for r in lines.select(F.spark_partition_id()).distinct().collect()}


def test_ranges_are_not_merged_into_one_task(spark, tmp_dir):
    """Adaptive execution sees three short fields a range and would give one task all lines."""
    folder, want = _folder(tmp_dir, ["北上 ab"] * 200)
    listed = files.listed(spark, folder)
    read = ranges.read_ranges(listed, range_bytes=64)
    assert read.count() == len(want)
    assert len(_readers(read)) > 4
    total = sum(r["length"] for r in listed.collect())
    assert ranges.range_tasks(listed, 64) >= total // 64  # by bytes, however many cores there are
    assert ranges.range_tasks(listed) == 3  # a range each: no more tasks than ranges
    assert ranges.range_tasks(listed.where("length < 0")) == 1


def test_a_folder_of_wide_files_is_read_by_several_tasks(spark, tmp_dir):
    for i in range(6):
        with open(os.path.join(tmp_dir, f"trading_2026031{i}.log"), "wb") as fh:
            fh.write(MARKS["UTF-16LE"] + "北上\n".encode("utf-16le") * 50)
    lines = files.read_lines(spark, tmp_dir)
    assert lines.count() == 300 and len(_readers(lines)) > 1
