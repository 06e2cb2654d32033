"""Similarity join of documents on sets of five-word shingles (Jaccard >= 0.75).

Two documents link when 100 * intersection >= 75 * union of their sets; the
result is each document's connected component. All work is exact but for
64-bit hashes standing for shingles.

The method is a count-vector R-tree (``count_rtree``): shingles are hashed
into groups, group counts are points, the sum of coordinate minima bounds the
overlap, and pairs that survive are verified on whole sets. One tree over all
documents would compare nearly all of them: in a tree of n leaves only about
log2(n) coordinates are split, too few to prune among documents of one size.
So documents first meet in blocks that lose no link, and each block has trees:

1. All texts are read once for each document's set size, set hash, and a count
   sketch (fixed size) of all shingles, which never counts too few documents.
2. The order of shingles is: not frequent by the sketch first, then by hash. A
   document of n shingles shows its first n // 4 + 1; two documents that link
   share one of these. A document with a frequent line shows rarer shingles.
   A shown shingle that the sketch gives more than ``HOLDERS`` holders (a large
   group of near copies) is split: holders fall into chunks of about that many
   or fewer by a hash, and each pair of chunks is a shingle of its own, so all
   pairs still meet. A group of h holders thus travels about h / HOLDERS times.
3. Holders of a shown shingle form a block named by the smallest holder (and the
   chunk pair); equal names merge, so every linked pair is in a common block.
4. A block gets its members' points; trees leave clusters of members whose
   bounds allow 0.75. A cluster is named by its smallest id and the chunk pair.
5. A cluster gets its members' whole sets, and again trees choose the pairs to
   verify; pairs already joined are skipped, so no group emits all its pairs.
   In 4 and 5 what is split makes a part of its own, of two chunks.
6. Spark joins the links by star contraction to components.

Texts travel in slices of about ``SLICE_BYTES`` (a hash of id and text); equal sets
in a slice are one member. One shuffle of the texts serves steps 2, 4 and 5.

Defined results: null or empty texts have no shingles and link with nothing;
repeated rows and exact copies share a component; a row without doc_id gets
the component of equal sets that have ids (else null) and links no others;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (keyed_table, pack_arrays, pieces, read_table, ship_package, slice_count, stored, unpack_arrays,
                     with_slice)
from .components import component_labels
from .count_rtree import counts, similar_components
from .textbytes import U64, mix, shingle_sets

SLICE_BYTES = 2 << 20
STEP_TEXTS = 1 << 20
SKETCH = 1 << 20
SKETCH_PARTS = 32
MIN_FREQUENT = 256
HOLDERS = 1 << 14


def steps(texts: list[bytes], limit: int = STEP_TEXTS):
    """(start, stop) of runs of texts of about ``limit`` bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def all_sets(texts: list[bytes]) -> list[np.ndarray]:
    out = []
    for a, b in steps(texts):
        h, at = shingle_sets(texts[a:b])
        out += [h[at[i]:at[i + 1]] for i in range(b - a)]
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two sums over a set's hashes, as signed longs."""
    a, b = s.sum(dtype=U64), mix(s ^ U64(0x5BD1E995)).sum(dtype=U64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def sketch_place(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> U64(44)).astype(np.int64)  # 20 bits: SKETCH places


def prefix(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The shown shingles: len // 4 + 1, in the common order. ``s`` ascends."""
    n = len(s) // 4 + 1
    rare = ~frequent[sketch_place(s)]
    return np.concatenate([s[rare], s[~rare]])[:n]


def set_statistics(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, a, b) of documents, and rows (part, sketch) of the
    sketch of all shingles, written once."""
    names = ["doc_id", "n", "a", "b", "part", "sketch"]

    def run(batches):
        sketch = np.zeros(SKETCH, np.int64)
        for batch in pieces(batches, "text"):
            sets = all_sets([t.encode() if t else b"" for t in batch.column(1).to_pylist()])
            keys = [set_key(s) for s in sets]
            for s in sets:  # equal sets may lie in several slices, so each counts
                np.add.at(sketch, sketch_place(s), 1)
            m = len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(SKETCH_PARTS, pa.int64())] * 4
            + [pa.array(range(SKETCH_PARTS), pa.int32()),
               pa.array([pack_arrays(p) for p in sketch.reshape(SKETCH_PARTS, -1)], pa.binary())], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(run, "doc_id long, n long, a long, b long, part int, sketch binary"), "ngram-sets")


def frequent_places(statistics: DataFrame) -> bytes:
    """Of each sketch place the binary logarithm of its count, rounded up, and
    whether it is frequent; packed, of fixed size."""
    shown = statistics.where("part is null and n > 0").agg(F.sum(F.expr("n div 4 + 1"))).first()[0] or 0
    least = max(MIN_FREQUENT, 32 * shown // SKETCH)

    def add(key, table):
        total = sum(unpack_arrays(x)[0] for x in table.column("sketch").to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "levels": pa.array([levels(total).tobytes()], pa.binary()),
                         "often": pa.array([(total >= least).tobytes()], pa.binary())})

    def levels(total):
        return np.ceil(np.log2(np.maximum(total, 1))).astype(np.uint8)

    rows = (statistics.where("part is not null").select("part", "sketch").groupBy("part")
            .applyInArrow(add, "part int, levels binary, often binary").orderBy("part").collect())
    found = [np.frombuffer(b"".join(bytes(r[c]) for r in rows), t) for c, t in (("levels", np.uint8), ("often", bool))]
    return pack_arrays(*(x if len(x) else np.zeros(SKETCH, x.dtype) for x in found))


def split_shown(token: np.ndarray, member: np.ndarray, doc: np.ndarray, level: np.ndarray, holders: int):
    """(token, member, pair) with the tokens of many holders split by pairs of
    chunks; pair is 0 for tokens that are not split."""
    chunks = np.left_shift(1, np.maximum(level[sketch_place(token)].astype(np.int64) - (holders.bit_length() - 1), 0))
    whole = chunks == 1
    tokens, members, pairs = [token[whole]], [member[whole]], [np.zeros(int(whole.sum()), np.int64)]
    for n in np.unique(chunks[~whole]).tolist():
        at = np.flatnonzero(chunks == n)
        own = (mix(doc[member[at]].astype(U64)) % U64(n)).astype(np.int64)
        for other in range(n):  # those of one chunk meet in any of its pairs
            i = np.flatnonzero(own != other)
            low, high = np.minimum(own[i], other), np.maximum(own[i], other)
            pair = (n * n + low * n + high).astype(np.int64)
            tokens.append(mix(token[at[i]] ^ mix(pair.astype(U64))))
            members.append(member[at[i]])
            pairs.append(pair)
    return np.concatenate(tokens), np.concatenate(members), np.concatenate(pairs)


def members_of(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Distinct texts of a slice with their smallest doc_id, in an order that
    does not depend on how the rows arrived."""
    rows = sorted(zip(table.column("doc_id").to_pylist(), (t.encode() for t in table.column("text").to_pylist())))
    first: dict[bytes, int] = {}
    for doc, text in rows:
        first.setdefault(text, doc)
    return np.array(list(first.values()), np.int64), list(first)


def by_part(part: np.ndarray, n: int):
    """(part, places) for each part that occurs."""
    order = np.argsort(part, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=n))])
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        yield p, order[cuts[p]:cuts[p + 1]]


def by_sparse_part(part: np.ndarray):
    """``by_part`` for numbers of any size."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(part[order[a]]), order[a:b]


def part_of(names: np.ndarray, n: int) -> np.ndarray:
    return (mix(names.astype(U64)) % U64(n)).astype(np.int64)


def group_part(names: np.ndarray, pair: np.ndarray, n: int) -> np.ndarray:
    """``part_of``, but a part of its own for each group of a chunk pair."""
    own = n + (mix(names.astype(U64)) % U64((1 << 31) - n)).astype(np.int64)
    return np.where(pair > 0, own, part_of(names, n))


def paired(name: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Names of groups, with the chunk pair mixed in where there is one."""
    return np.where(pair > 0, mix(name.astype(U64) ^ mix(pair.astype(U64))).astype(np.int64), name)


def ragged(values: np.ndarray, lens: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(lens)[:-1]) if len(lens) else []


KEYED = "slice int, other int, value binary"
KEYED_NAMES = ["slice", "other", "value"]
PART = "part int, other int, value binary"
PART_NAMES = ["part", "other", "value"]


def similar_links(docs: DataFrame, frequent: bytes, slice_bytes: int = SLICE_BYTES, holders: int = HOLDERS) -> DataFrame:
    """Links (a, b) between doc_ids that connect each component."""
    return link_steps(docs, frequent, slice_bytes, holders)[-1]


def link_steps(docs: DataFrame, frequent: bytes, slice_bytes: int, holders: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the parts of steps 4 and 5 receive, and the links."""
    some = docs.where("doc_id is not null")
    n = slice_count(some, "text", slice_bytes)
    texts = with_slice(some, n).where("text != ''")

    def show(key, table):
        """Shown shingles of a slice, dealt to parts by the shingle."""
        s, (level, often) = key[0].as_py(), unpack_arrays(frequent)
        doc, texts_here = members_of(table)
        shown = [prefix(x, often) if len(x) else x for x in all_sets(texts_here)]
        if not shown:
            return keyed_table([], [], [], PART_NAMES)
        token = np.concatenate(shown)
        member = np.repeat(np.arange(len(shown)), [len(x) for x in shown])
        token, member, pair = split_shown(token, member, doc, level, holders)
        keys, values = [], []
        for p, at in by_part(part_of(token, n), n):
            keys.append(p)
            values.append(pack_arrays(token[at], member[at].astype(np.uint32), pair[at]))
        return keyed_table(keys, [s] * len(keys), values, PART_NAMES)

    def blocks(key, table):
        """Holders of each shingle that has several, with the block's name."""
        p, token, holder, pair = key[0].as_py(), [], [], []
        for s, value in zip(table.column("other").to_pylist(), table.column("value").to_pylist()):
            t, m, c = unpack_arrays(value)
            token.append(t)
            holder.append((s << 32) | m.astype(np.int64))
            pair.append(c)
        token, holder, pair = (np.concatenate(x) for x in (token, holder, pair))
        order = np.lexsort((holder, token))
        token, holder, pair = token[order], holder[order], pair[order]
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        size = np.diff(np.append(start, len(token)))
        several = np.repeat(size > 1, size)
        name = paired(holder[start], pair[start])
        pairs = np.unique(np.stack([holder[several], np.repeat(name, size)[several], pair[several]]), axis=1)
        keys, values = [], []
        for s, at in by_part(pairs[0] >> 32, n):
            keys.append(s)
            values.append(pack_arrays((pairs[0][at] & 0xFFFFFFFF).astype(np.uint32), pairs[1][at], pairs[2][at]))
        return keyed_table(keys, [p] * len(keys), values, KEYED_NAMES)

    def send(key, left, right, what):
        """A slice's members to the parts of the groups they are wanted in."""
        s, wanted = key[0].as_py(), [unpack_arrays(x) for x in right.column("value").to_pylist()]
        if not wanted:
            return keyed_table([], [], [], PART_NAMES)
        member, group, pair = (np.concatenate([w[i] for w in wanted]).astype(np.int64) for i in range(3))
        member, group, pair = np.unique(np.stack([member, group, pair]), axis=1)
        doc, text = members_of(left)
        used, member = np.unique(member, return_inverse=True)
        sets = all_sets([text[i] for i in used.tolist()])
        doc = doc[used]
        sent = [what(x) for x in sets]
        keys, values = [], []
        for p, at in by_sparse_part(group_part(group, pair, n)):
            own, place = np.unique(member[at], return_inverse=True)
            parts = [sent[i] for i in own.tolist()]
            keys.append(p)
            values.append(pack_arrays(doc[own], used[own], np.array([len(sets[i]) for i in own.tolist()], np.int64),
                                      np.array([len(x) for x in parts], np.int64), np.concatenate(parts),
                                      place.astype(np.int64), group[at], pair[at]))
        return keyed_table(keys, [s] * len(keys), values, PART_NAMES)

    def send_points(key, left, right):
        return send(key, left, right, lambda x: counts(x).astype(np.uint16))

    def send_sets(key, left, right):
        return send(key, left, right, lambda x: x)

    def groups(table):
        """(doc, slice, member, size, value) of all members, and the places and chunk pair of each group."""
        doc, where, member, size, value, place, group, pair, base = [], [], [], [], [], [], [], [], 0
        for s, packed in zip(table.column("other").to_pylist(), table.column("value").to_pylist()):
            d, m, k, lens, flat, at, g, c = unpack_arrays(packed)
            doc.append(d)
            where.append(np.full(len(d), s))
            member.append(m)
            size.append(k)
            value += ragged(flat, lens)
            place.append(at + base)
            group.append(g)
            pair.append(c)
            base += len(d)
        columns = [np.concatenate(x) for x in (doc, where, member, size)]
        place, group, pair = (np.concatenate(x) for x in (place, group, pair))
        order = np.lexsort((columns[0][place], group))
        place, group, pair = place[order], group[order], pair[order]
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        return *columns, value, [(place[a:b], pair[a:b]) for a, b in zip(cuts[:-1], cuts[1:]) if b - a > 1]

    def clusters(key, table):
        """Members that the trees leave together, by slice: (member, cluster)."""
        doc, where, member, size, value, found = groups(table)
        at, name, pair = [], [], []
        for g, c in found:
            label = similar_components(size[g], [value[i] for i in g.tolist()])
            several = np.bincount(label, minlength=len(g))[label] > 1
            least = np.full(len(g), np.iinfo(np.int64).max)
            np.minimum.at(least, label, doc[g])
            at.append(g[several])
            name.append(paired(least[label], c)[several])
            pair.append(c[several])
        keys, values = [], []
        if at:
            at, name, pair = (np.concatenate(x) for x in (at, name, pair))
            for s, i in by_part(where[at], n):
                keys.append(s)
                values.append(pack_arrays(member[at[i]], name[i], pair[i]))
        return keyed_table(keys, [key[0].as_py()] * len(keys), values, KEYED_NAMES)

    def verified(key, table):
        doc, _, _, size, value, found = groups(table)
        a, b = [], []
        for g, _ in found:
            sets = [value[i] for i in g.tolist()]

            def alike(i, j, sets=sets):
                both = np.concatenate([sets[i], sets[j]])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                return 100 * same >= 75 * (len(both) - same)

            label = similar_components(size[g], [counts(x) for x in sets], alike)
            least = np.full(len(g), np.iinfo(np.int64).max)
            np.minimum.at(least, label, doc[g])
            b.append(least[label])
            a.append(doc[g])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
        keep = a != b
        return pa.table({"a": pa.array(a[keep]), "b": pa.array(b[keep])})

    shown = texts.groupBy("slice").applyInArrow(show, PART)
    wanted = shown.groupBy("part").applyInArrow(blocks, KEYED)
    points = texts.groupBy("slice").cogroup(wanted.groupBy("slice")).applyInArrow(send_points, PART)
    near = points.groupBy("part").applyInArrow(clusters, KEYED)
    sets = texts.groupBy("slice").cogroup(near.groupBy("slice")).applyInArrow(send_sets, PART)
    return points, sets, sets.groupBy("part").applyInArrow(verified, "a long, b long")


def similar_documents(docs: DataFrame, slice_bytes: int = SLICE_BYTES, holders: int = HOLDERS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    ship_package(docs.sparkSession)
    statistics = set_statistics(docs)
    links = stored(similar_links(docs, frequent_places(statistics), slice_bytes, holders), "ngram-links")
    labels = component_labels(links)
    rows = statistics.where("part is null").select("doc_id", "n", "a", "b")
    worded = rows.where("n > 0")
    first = worded.groupBy("n", "a", "b").agg(F.min("doc_id").alias("first_id"))
    first = first.join(labels, F.col("first_id") == F.col("node"), "left")
    first = first.select("n", "a", "b", F.coalesce("label", "first_id").alias("component_id"))
    some = worded.join(first, ["n", "a", "b"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.union(none)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
