"""Merkle manifest of a dataset by sibling-shift self-joins.

Every document is a leaf: the SHA-256 of its fields, each `-` if null, else its
UTF-8 length in bytes, a colon and its value. The leaves of a language, in
order, form a tree: runs of ``arity`` consecutive nodes become the digest of
their digests (as lower-case hex, concatenated) until one is left. The roots of
the languages, in order of their names, form a tree in the same way, whose top
is the root of the dataset.

* Numbering: leaves are range-partitioned by (language, id, digest), counted per
  partition and language, and numbered within their partition from the prefix sum of
  the counts. Equal leaves are spread by a salt, so no partition
  grows with a hot language, id or row.
* Up: at every level each node is equijoined with its siblings by computed
  index (index XOR 1 for pairs, slot offsets within the run otherwise). Nodes
  of slot zero, which then hold the whole run, emit the parents.
* Down: a node's path is its own siblings followed by the path of its
  parent, joined by index from the top level to the leaves.
* Folding: a leaf and its path give the root again, with built-in functions.

Each level is a written table, so neither lineage nor memory grows with the
depth, and a lost executor costs its tasks. Digests travel as 32 bytes.

Defined results: order is by doc_id, null first, then by leaf digest; equal rows
are leaves of their own, in any order (their leaves are equal, their proofs
differ by place). A null lang is a language of its own, before all others.
Null text is `-`, empty text `0:`. An empty table gives an empty result. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, stored

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = 7
#: Levels that one job goes down.
STRIDE = 6


def field_text(value: Column) -> Column:
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated parts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_digest(fields: list[str] = FIELDS, **changed: Column) -> Column:
    return digest(*(field_text(changed.get(c, F.col(c))) for c in fields))


def numbered(rows: DataFrame, order: list[str], tag: str) -> DataFrame:
    """``rows`` with ``idx``, the place of each within its ``tree`` by ``order``
    (nulls first), and ``n``, how many its tree has."""
    salted = rows.withColumn("salt", F.xxhash64(*order, F.monotonically_increasing_id()))
    parted = stored(salted.repartitionByRange("tree", *order, "salt").withColumn("part", F.spark_partition_id())
                    .drop("salt"), f"{tag}-rows")
    # a row per partition and tree that has rows there
    counts = parted.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n_here"))
    by_tree = Window.partitionBy("tree")
    before = F.sum("n_here").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(counts.select("tree", "part", F.coalesce(before, F.lit(0)).alias("first"),
                                  F.sum("n_here").over(by_tree).alias("n")), f"{tag}-starts")
    place = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    placed = (parted.withColumn("place", place).join(starts, ["tree", "part"])
              .withColumn("idx", F.col("first") + F.col("place") - 1).drop("part", "place", "first"))
    return stored(placed, f"{tag}-numbered")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (tree, idx, h and others) with ``slot``, the place in the run, and
    ``sib``, the digests of the run's other nodes in order (empty for a node alone)."""
    node = nodes.select(F.col("tree").alias("o_tree"), F.col("idx").alias("o_idx"), F.col("h").alias("o_h"))
    out = nodes.withColumn("slot", (F.col("idx") % arity).cast("int"))
    found = []
    for shift in range(1, arity):
        there = (F.col("slot") + shift) % arity
        other = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - F.col("slot") + there
        out = (out.withColumn("want", other)
               .join(node, (F.col("tree") == F.col("o_tree")) & (F.col("want") == F.col("o_idx")), "left")
               .drop("o_tree", "o_idx", "want").withColumnRenamed("o_h", f"h{shift}"))
        found.append(F.struct(there.alias("slot"), F.coalesce(F.col(f"h{shift}"), F.lit(b"")).alias("h")))
    sib = found[0]["h"] if arity == 2 else F.aggregate(
        F.sort_array(F.array(*found)), F.lit(b""), lambda a, s: F.concat(a, s["h"]))
    return out.select(*nodes.columns, "slot", sib.alias("sib"))


def build_up(nodes: DataFrame, arity: int, tag: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees, leaves first, and their tops (tree, depth, h).

    ``nodes``: tree, n (nodes of the tree at this level), idx, h; further
    columns stay on the first level. A level holds the trees of several nodes."""
    levels: list[DataFrame] = []
    tops = nodes.where("n = 1").select("tree", F.lit(0).alias("depth"), "h")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level = stored(with_siblings(nodes.where("n > 1"), arity), f"{tag}-level{len(levels)}")
        levels.append(level)
        most = -(-most // arity)
        nodes = level.where("slot = 0").select(
            "tree", F.ceil(F.col("n") / arity).alias("n"), F.floor(F.col("idx") / arity).alias("idx"),
            digest(hexed(F.col("h")), hexed(F.col("sib"))).alias("h"))
        tops = tops.union(nodes.where("n = 1").select("tree", F.lit(len(levels)).alias("depth"), "h"))
    return levels, stored(tops, f"{tag}-tops")


def path_down(levels: list[DataFrame], lone: DataFrame, tops: DataFrame, arity: int, tag: str) -> DataFrame:
    """The leaves with ``path``: a step per level, their own first, then those
    that ``tops`` (tree, depth, path) has beyond the tree. A step is a byte for the
    slot and the siblings. ``lone``: leaves of trees of one leaf."""
    above = None
    step = F.concat(F.unhex(F.lpad(F.hex("slot"), 2, "0")), F.col("sib"))
    for i in range(len(levels) - 1, -1, -1):
        top = tops.where(F.col("depth") == i + 1).select("tree", F.lit(0).cast("long").alias("idx"), "path")
        above = top if above is None else above.union(top)
        up = above.select(F.col("tree").alias("u_tree"), F.col("idx").alias("u_idx"), F.col("path").alias("u_path"))
        found = levels[i].join(up, (F.col("tree") == F.col("u_tree")) & (F.floor(F.col("idx") / arity) == F.col("u_idx")))
        keep = ["tree", "idx"] if i else [c for c in levels[0].columns if c not in ("slot", "sib")]
        above = found.select(*keep, F.concat(F.array(step), F.col("u_path")).alias("path"))
        if i % STRIDE == 0:
            above = stored(above, f"{tag}-path{i}")
    alone = lone.join(tops.where("depth = 0").select("tree", "path"), "tree")
    return alone if above is None else above.unionByName(alone)


def fold(h: Column, path: Column) -> Column:
    """The digest at the end of ``path`` from the node ``h``."""
    def up(acc: Column, step: Column) -> Column:
        cut = F.conv(F.hex(F.substring(step, 1, 1)), 16, 10).cast("int") * 32
        sib = F.substring(step, 2, 1 << 20)
        return digest(hexed(F.substring(sib, F.lit(1), cut)), hexed(acc),
                      hexed(F.substring(sib, cut + 1, F.lit(1 << 20))))

    return F.aggregate(path, h, up)


def manifest(docs: DataFrame, arity: int = 2) -> DataFrame:
    """Leaf, subroot, root, proof and folded root of every row of documents
    (``fold`` checks a tampered leaf where ``TAMPERED`` divides the id's CRC)."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    leaves = docs.select(
        # a language's tree by a name that is never null and sorts as the language does
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest().alias("h"), F.when(crc % TAMPERED == 0, leaf_digest(n_chars=more)).alias("other"))
    nodes = numbered(leaves, ["doc_id", "h"], "merkle")
    levels, tops = build_up(nodes, arity, "merkle")

    names = numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "depth", "h"), ["name"], "merkle-top")
    top_levels, root = build_up(names, arity, "merkle-top")
    done = root.select("tree", "depth", F.array().cast("array<binary>").alias("path"))
    langs = stored(path_down(top_levels, names.where("n = 1"), done, arity, "merkle-top")
                   .select(F.col("name").alias("tree"), "depth", "path", F.col("h").alias("subroot"))
                   .join(root.select(F.col("h").alias("root")), F.lit(True)), "merkle-langs")  # root: one row

    found = path_down(levels, nodes.where("n = 1"), langs.select("tree", "depth", "path"), arity, "merkle")
    siblings = F.array_join(F.transform("path", lambda s: hexed(F.substring(s, 2, 1 << 20))), "")
    out = (found.join(langs.select("tree", "subroot", "root"), "tree")
           .withColumn("folded", fold(F.coalesce("other", "h"), F.col("path"))))
    return out.select("doc_id", hexed(F.col("h")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
                      hexed(F.col("root")).alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
                      hexed(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents").select(*FIELDS))


def _tree_sql(name: str, leaves: str) -> str:
    """CTEs: the nodes of the trees over ``leaves`` (tree, idx, n, h, ...), their
    depths, tops, and the path of every leaf as a list of slot and sibling."""
    return f"""
{name}_nodes(tree, level, idx, n, h) as (
  select tree, 0, idx, n, h from {leaves}
  union all
  select tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' order by idx))
  from {name}_nodes where n > 1 group by tree, level, idx // 2, n),
{name}_tops as (select tree, level as depth, h as top from {name}_nodes where n = 1),
{name}_steps as (
  select l.tree, l.idx, s.level, (l.idx >> s.level) & 1 as slot, xor(l.idx >> s.level, 1) as want
  from {leaves} l join {name}_tops t using (tree), unnest(range(t.depth)) s(level)),
{name}_paths as (
  select s.tree, s.idx, list(s.slot || coalesce(n.h, '') order by s.level) as path
  from {name}_steps s left join {name}_nodes n on n.tree = s.tree and n.level = s.level and n.idx = s.want
  group by all)"""


#: The same rows level by level in SQL (CRC-32 by its byte table).
SQL = {"op12_merkle": f"""
with recursive
bits(i, c, k) as (
  select i, i, 0 from range(256) r(i)
  union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
crc_table as (select list(c order by i) as t from bits where k = 8),
docs as (
  select doc_id, source, lang, n_chars, text, coalesce('=' || lang, '') as tree,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''),
               lambda ch: ascii(ch)::bigint)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) as crc
  from documents, crc_table),
hashed as (
  select doc_id, tree, crc, {{leaf}} as h, {{other}} as other from docs),
leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, h) - 1 as idx,
         count(*) over (partition by tree) as n from hashed),
{_tree_sql("doc", "leaves")},
langs as (
  select '' as tree, tree as name, top as h, row_number() over (order by tree) - 1 as idx, count(*) over () as n from doc_tops),
{_tree_sql("lang", "langs")},
found as (
  select l.doc_id, l.h as leaf, g.h as subroot, r.top as root,
         list_concat(coalesce(p.path, []), coalesce(q.path, [])) as path,
         case when l.crc % 7 = 0 then l.other else l.h end as start
  from leaves l join langs g on g.name = l.tree cross join lang_tops r
  left join doc_paths p on p.tree = l.tree and p.idx = l.idx
  left join lang_paths q on q.idx = g.idx),
folded as (
  select *, list_reduce(list_prepend(start, path), lambda a, s:
    sha256(case when s[1] = '0' then a || s[2:] else s[2:] || a end)) as folded_root from found)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) as proof_sha256,
       folded_root, folded_root = root as verified
from folded""".replace("{leaf}", "sha256(" + " || ".join(
    f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')" for c in FIELDS) + ")").replace(
    "{other}", "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')"
        for c in ["doc_id", "source", "lang", "(n_chars + 1)", "text"]) + ")")}
