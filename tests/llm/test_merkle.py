import hashlib
import zlib
from collections import Counter

import pytest

from loglane.llm import merkle

from .helpers import documents, frame

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, more=0) -> str:
    i, text, lang, source, n = row
    return h(*map(field, (i, source, lang, n if n is None else n + more, text)))


def grown(nodes: list[str], k: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Top of the tree over ``nodes`` and, for each, what stands before and after it."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i:i + k] for i in range(0, len(nodes), k)]
        for j, i in enumerate(at):
            run, s = runs[i // k], i % k
            paths[j].append(("".join(run[:s]), "".join(run[s + 1:])))
        nodes, at = [h(*r) for r in runs], [i // k for i in at]
    return nodes[0], paths


def stated(rows, k=2) -> list[tuple]:
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((own, *grown([leaf_of(r) for r in own], k)))
    root, above = grown([t[1] for t in trees], k)
    out = []
    for (own, sub, paths), up in zip(trees, above):
        for r, path in zip(own, paths):
            path = path + up
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            top = leaf_of(r, int(bad))
            for before, after in path:
                top = h(before, top, after)
            out.append((r[0], leaf_of(r), sub, root, h(*(x for p in path for x in p)), top, top == root))
    return out


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_equals_a_plain_statement(spark, arity):
    rows = documents()
    langs = ["en", None, "de", "", "ü", "zz"]
    rows = [(i, t, langs[j % 6] if j < 24 else "one " + str(j), None if j % 5 == 0 else "src", n) for j, (i, t, _, _, n) in enumerate(rows)]
    rows += [(200 + i, f"text {i}", "en", "s", i) for i in range(37)]
    df = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = Counter(stated(rows, arity))
    assert rows_of(merkle.manifest(df, arity)) == want
    assert not all(r[-1] for r in want) and any(r[-1] for r in want)


def test_small_trees_and_nulls(spark):
    assert merkle.manifest(frame(spark, [])).count() == 0
    for rows in ([(1, "a", "en", "s", 1)], [(None, None, None, None, None)], [(2, "x", "en", "s", None), (3, "", "de", "", 0)],
                 [(14, "t", "en", "s", None)] * 3):
        assert rows_of(merkle.manifest(frame(spark, rows))) == Counter(stated(rows))


def test_clashing_extra_columns(spark):
    rows = [(i, f"t{i}", "ab"[i % 2], "s", i) for i in range(9)]
    df = frame(spark, rows)
    extra = ["tree", "idx", "h", "slot", "sib", "path", "salt", "part", "n", "leaf", "root", "depth", "other", "place"]
    for c in extra:
        df = df.selectExpr("*", f"'x' as {c}")
    assert rows_of(merkle.manifest(df)) == Counter(stated(rows))


def test_a_hot_row_spreads_over_partitions(spark):
    """A third of the rows equal: no partition of the numbering holds twice its share."""
    rows = [(5, "same", "en", "s", 4)] * 1200 + [(i, f"t{i}", "en", "s", 4) for i in range(1200)]
    df = frame(spark, rows).select(
        merkle.F.lit("=en").alias("tree"), "doc_id", merkle.leaf_digest().alias("h"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = merkle.numbered(df, ["doc_id", "h"], "hot")
        parts = got.groupBy(merkle.F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sorted(r["idx"] for r in got.select("idx").collect()) == list(range(2400))
    assert max(r["count"] for r in parts) < 1000
