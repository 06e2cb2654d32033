"""Approximate nearest neighbours by multiprobe p-stable hashing.

Index: ``TABLES`` hash tables; in each, ``HASHES`` functions floor((a.x + b) / w)
with Gaussian a (2-stable) name the bucket of a normalised vector. Every vector
is in every table.

Search: a query visits its own bucket and ``PROBES`` - 1 perturbed ones. A
perturbation moves some hash values by one; perturbation sets are visited in
the order of the expected squared distances to the crossed boundaries, ranked
by closeness to the query (the estimate needs no look at the data). Candidates
of a bucket are compared exactly, in double precision, where the bucket is;
only each part's best go on and are merged over the tables. A query with too
few candidates is searched exactly, in blocks of queries against all rows.

Equal vectors are one entry of the index with their smallest ids, as many as a
result can hold, so a vector that a third of all rows share is one entry, and
equal queries are searched once. Buckets are dealt to parts by name; a bucket
of a large table is split by id (``BUCKET_ROWS``), and queries visit each split.

Defined results: null, empty and zero vectors, and vectors with null or
non-finite components, take no part; vectors of different lengths never meet;
rows of one vec_id count once for equal vectors, and rows with the query's own
id are never its neighbours; ties go to smaller ids; a null vec_id takes no
part; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import pack_arrays, read_table, scratch, ship_package, stored, unpack_arrays
from .ngram_join import by_part, part_of
from .textbytes import mix

TABLES, HASHES, WIDTH, PROBES = 8, 6, 1.5, 144
BUCKET_ROWS = 50_000
PART_BYTES = 8 << 20
STEP_ROWS = 4096
QUERY_BLOCK = 512
#: What sums of products in another order may differ by, for unit vectors.
ROUNDING = 1e-9


@lru_cache(maxsize=8)
def hash_functions(dim: int, tables: int, hashes: int, width: float):
    rng = np.random.default_rng([dim, tables, hashes, 11])
    return rng.normal(size=(dim, tables * hashes)), rng.uniform(0, width, tables * hashes)


@lru_cache(maxsize=8)
def perturbations(hashes: int, probes: int) -> tuple:
    """Sets of boundary ranks (1 = nearest of the 2 * hashes boundaries), best
    first by expected squared distance; a set never crosses both boundaries of
    one hash value, which hold ranks j and 2 * hashes + 1 - j."""
    m = hashes
    cost = [0.0]
    for j in range(1, 2 * m + 1):
        k = 2 * m + 1 - j
        cost.append(j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m
                    else 1 - k / (m + 1) + k * (k + 1) / (4 * (m + 1) * (m + 2)))
    out, heap = [()], [(cost[1], (1,))]
    while heap and len(out) < probes:
        _, s = heapq.heappop(heap)
        if not any(2 * m + 1 - j in s for j in s):
            out.append(s)
        if s[-1] < 2 * m:
            shifted, grown = (*s[:-1], s[-1] + 1), (*s, s[-1] + 1)
            heapq.heappush(heap, (sum(cost[j] for j in shifted), shifted))
            heapq.heappush(heap, (sum(cost[j] for j in grown), grown))
    return tuple(out)


def bucket_names(cells: np.ndarray, table, dim: int) -> np.ndarray:
    """A 64-bit name of (dim, table, cells); the last axis holds the cells."""
    h = np.full(cells.shape[:-1], dim, np.uint64) + (np.uint64(1000003) * np.asarray(table).astype(np.uint64))
    for k in range(cells.shape[-1]):
        h = mix(h ^ cells[..., k].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h


def projected(x: np.ndarray, tables: int, hashes: int, width: float) -> np.ndarray:
    a, b = hash_functions(x.shape[1], tables, hashes, width)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return ((unit @ a + b) / width).reshape(len(x), tables, hashes)


def own_buckets(x, tables, hashes, width) -> np.ndarray:
    cells = np.floor(projected(x, tables, hashes, width))
    return bucket_names(cells, np.arange(tables), x.shape[1])


def visited_buckets(x, tables, hashes, width, probes) -> np.ndarray:
    """(rows, tables, probes) bucket names in visiting order."""
    p = projected(x, tables, hashes, width)
    cells = np.floor(p)
    below = p - cells
    distance = np.concatenate([below, 1 - below], axis=2)  # to the lower, to the upper boundary
    order = np.argsort(distance, axis=2, kind="stable")
    out = []
    for s in perturbations(hashes, probes):
        moved = cells.copy()
        for j in s:
            at = order[:, :, j - 1:j]
            k = at % hashes
            np.put_along_axis(moved, k, np.take_along_axis(moved, k, 2) + np.where(at < hashes, -1.0, 1.0), 2)
        out.append(bucket_names(moved, np.arange(tables), x.shape[1]))
    return np.stack(out, axis=2)


def usable_vectors(rows: DataFrame) -> tuple[str, DataFrame]:
    """The type of the components, and (vec_id, vec, key) of the rows that take
    part: the vector's bytes and their digest."""
    element = rows.schema["embedding"].dataType.elementType
    dtype = "float32" if isinstance(element, FloatType) else "float64"
    values = F.col("embedding").cast(f"array<{'float' if dtype == 'float32' else 'double'}>")

    def clean(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP_ROWS):
                part = b.slice(at, STEP_ROWS)
                kept, vecs = [], []
                for i, v in enumerate(part.column(1)):
                    if not v.is_valid or v.values.null_count or not len(v.values):
                        continue
                    x = v.values.to_numpy().astype(dtype) + 0.0  # one zero
                    if np.isfinite(x).all() and x.any():
                        kept.append(i)
                        vecs.append(x.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(kept, pa.int32())), pa.array(vecs, pa.binary())], ["vec_id", "vec"])

    usable = (rows.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("e"))
              .mapInArrow(clean, "vec_id long, vec binary"))
    return dtype, usable.withColumn("key", F.sha2("vec", 256))


def index_classes(usable: DataFrame, ids_kept: int) -> DataFrame:
    """(key, cid, ids, vec) of distinct vectors. The rank keeps only the
    smallest ids of each vector before the shuffle."""
    w = Window.partitionBy("key").orderBy("vec_id")
    few = usable.withColumn("r", F.dense_rank().over(w)).where(F.col("r") <= ids_kept)
    return few.groupBy("key").agg(F.min("vec_id").alias("cid"), F.sort_array(F.collect_set("vec_id")).alias("ids"),
                                  F.first("vec").alias("vec"))


def _stacked(batch, column: int, dtype: str):
    """(rows, matrix) for each vector length in a batch."""
    vecs = batch.column(column).to_pylist()
    lens = np.array([len(v) for v in vecs])
    for n in np.unique(lens).tolist():
        rows = np.flatnonzero(lens == n)
        yield rows, np.frombuffer(b"".join([vecs[i] for i in rows]), dtype).reshape(len(rows), -1)


def nearest(rows: DataFrame, is_query, k: int = 5, tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH,
            probes: int = PROBES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found by cosine.
    ``rows`` has vec_id and embedding; ``is_query`` is a condition on vec_id."""
    spark = rows.sparkSession
    ship_package(spark)
    dtype, usable = usable_vectors(rows)
    usable = stored(usable, "ann-vectors")
    queries = usable.where(is_query).select(F.col("vec_id").alias("query_id"), "key").distinct()
    classes = index_classes(usable, k + 1).join(queries.select("key").distinct().withColumn("asked", F.lit(True)), "key", "left")
    classes = stored(classes, "ann-classes")
    n = classes.count()
    parts = max(1, -(-n * tables * (64 + len(classes.select("vec").first()["vec"]) if n else 0) // PART_BYTES))

    def deal(batches):
        """Entries and visits as blobs for each part; a bucket's entries over
        several splits by id, and its visits to all of them."""
        for b in batches:
            for at in range(0, b.num_rows, STEP_ROWS):
                part = b.slice(at, STEP_ROWS)
                cid = part.column(0).to_numpy()
                asked = part.column(2).fill_null(False).to_numpy(zero_copy_only=False)
                for which, x in _stacked(part, 1, dtype):
                    names = own_buckets(x.astype(np.float64), tables, hashes, width)
                    split = mix(cid[which].astype(np.uint64)) % np.uint64(splits)
                    names = mix(names + split[:, None]) if splits > 1 else names
                    yield from blobs(0, names, cid[which], x)
                    q = np.flatnonzero(asked[which])
                    for a in range(0, len(q), 128):
                        own = q[a:a + 128]
                        seen = visited_buckets(x[own].astype(np.float64), tables, hashes, width, probes).reshape(len(own), -1)
                        if splits > 1:
                            seen = np.concatenate([mix(seen + np.uint64(s)) for s in range(splits)], axis=1)
                        yield from blobs(1, seen, cid[which][own], x[own])

    def blobs(kind, names, cid, x):
        row = np.repeat(np.arange(len(names)), names.shape[1])
        flat = names.ravel()
        keys, values = [], []
        for p, at in by_part(part_of(flat, parts), parts):
            used, place = np.unique(row[at], return_inverse=True)
            keys.append(p)
            values.append(pack_arrays(flat[at], place.astype(np.int64), cid[used], x[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([kind] * len(keys), pa.int32()),
                                          pa.array(values, pa.binary())], ["part", "kind", "value"])

    def visit(key, table):
        """Exact scores in the visited buckets of a part; per query the best."""
        sides = {0: {}, 1: {}}
        for kind, value in zip(table.column("kind").to_pylist(), table.column("value").to_pylist()):
            name, place, cid, flat = unpack_arrays(value)
            dim = len(flat) // len(cid)
            sides[kind].setdefault(dim, []).append((name, cid[place], place, cid, flat.reshape(-1, dim)))
        found = []
        for dim, asked in sides[1].items():
            entries = sides[0].get(dim)
            if not entries:
                continue
            en, ec, ex = _gathered(entries)
            qn, qc, qx = _gathered(asked)
            found += _scored(en, ec, ex, qn, qc, qx, k + 1)
        q, c, s = (np.concatenate([f[i] for f in found]) if found else np.empty(0, t)
                   for i, t in enumerate((np.int64, np.int64, np.float64)))
        q, c, s = _best(q, c, s, k + 1)
        return pa.table({"q": pa.array(q, pa.int64()), "cid": pa.array(c, pa.int64()), "score": pa.array(s, pa.float64())})

    splits = 1
    while n > bucket_rows * 8 * splits:  # a bucket may hold much more than its share
        splits *= 2
    dealt = classes.select("cid", "vec", "asked").mapInArrow(deal, "part int, kind int, value binary")
    hits = dealt.groupBy("part").applyInArrow(visit, "q long, cid long, score double")
    hits = stored(hits.groupBy("q", "cid").agg(F.max("score").alias("score")), "ann-hits")
    ids = classes.select("cid", "ids")

    def ranked(hits: DataFrame) -> DataFrame:
        best = Window.partitionBy("q").orderBy(F.desc("score"), "cid")
        top = hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
        options = top.join(ids, "cid").select("q", "score", F.explode("ids").alias("vec_id"))
        asked = queries.join(classes.select("key", F.col("cid").alias("q")), "key").select("query_id", "q")
        pairs = asked.join(options, "q").where("vec_id != query_id")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        out = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "q")

    result = stored(ranked(hits), "ann-result")
    total = usable.select("vec_id").distinct().count()
    have = result.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    lacking = (queries.join(have, "query_id", "left").where(F.coalesce("n", F.lit(0)) < min(k, total - 1))
               .join(classes.select("key", "cid", "vec"), "key").select("cid", "vec").distinct())
    lacking = stored(lacking, "ann-lacking")
    if lacking.isEmpty():
        return result.drop("q")
    exact = exact_hits(classes, lacking, dtype, k + 1)
    rest = result.join(lacking.select(F.col("cid").alias("q")), "q", "left_anti")
    return rest.drop("q").unionByName(ranked(exact).drop("q"))


def _gathered(side: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, id, row of vector) of all blobs, by name, and the vectors."""
    base, rows, vecs = 0, [], []
    for _, _, place, cid, x in side:
        rows.append(place + base)
        vecs.append(x)
        base += len(cid)
    name = np.concatenate([s[0] for s in side])
    order = np.argsort(name, kind="stable")
    return name[order], np.concatenate([s[1] for s in side])[order], (np.concatenate(rows)[order], np.concatenate(vecs))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of row pairs in double precision, the same for a pair wherever it is met."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _scored(en, ec, ex, qn, qc, qx, keep: int) -> list:
    erow, evec = ex
    qrow, qvec = qx
    unit_e = evec / np.linalg.norm(evec.astype(np.float64), axis=1, keepdims=True)
    unit_q = qvec / np.linalg.norm(qvec.astype(np.float64), axis=1, keepdims=True)
    both = np.intersect1d(en, qn)
    out = []
    bounds = zip(*(np.searchsorted(v, both, side).tolist() for v, side in ((en, "left"), (en, "right"), (qn, "left"), (qn, "right"))))
    for e0, e1, q0, q1 in bounds:
        for a in range(e0, e1, 8192):
            stop = min(e1, a + 8192)
            s = unit_q[qrow[q0:q1]] @ unit_e[erow[a:stop]].T
            # all that reach the keep-th score but for rounding: ties are ranked by id later
            m = min(keep, s.shape[1])
            least = np.partition(s, s.shape[1] - m, axis=1)[:, s.shape[1] - m]
            qi, ei = np.nonzero(s >= (least - ROUNDING)[:, None])
            qi, ei = q0 + qi, a + ei
            out.append((qc[qi], ec[ei], qrow[qi], erow[ei]))
    if not out:
        return []
    q, c, qr, er = (np.concatenate(x) for x in zip(*out))
    pair = np.unique(np.stack([q, c]), axis=1, return_index=True)[1]
    score = np.concatenate([_exact(qvec[qr[p]], evec[er[p]]) for p in np.array_split(pair, max(1, len(pair) // 65536 + 1))])
    return [(q[pair], c[pair], score)]


def _best(q, c, s, keep: int):
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    start = np.flatnonzero(np.diff(q, prepend=q[:1] - 1))
    place = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    few = place < keep
    return q[few], c[few], s[few]


def exact_hits(classes: DataFrame, asked: DataFrame, dtype: str, keep: int) -> DataFrame:
    """(q, cid, score): the nearest classes of each asked class by comparison
    with all, a block of ``QUERY_BLOCK`` queries at a time."""
    spark = classes.sparkSession
    path = scratch(spark, "ann-exact")
    block: list = []

    def flush():
        mine = list(block)
        block.clear()

        def run(batches):
            for b in batches:
                cid = b.column(0).to_numpy()
                for which, x in _stacked(b, 1, dtype):
                    own = [(q, v) for q, v in mine if len(v) == x[0].nbytes]
                    if not own:
                        continue
                    qx = np.stack([np.frombuffer(v, dtype) for _, v in own])
                    for i, (q, _) in enumerate(own):
                        best = _best(np.full(len(x), q), cid[which], _exact(np.broadcast_to(qx[i], x.shape), x), keep)
                        yield pa.RecordBatch.from_arrays([pa.array(best[0], pa.int64()), pa.array(best[1], pa.int64()),
                                                          pa.array(best[2], pa.float64())], ["q", "cid", "score"])

        classes.select("cid", "vec").mapInArrow(run, "q long, cid long, score double").write.mode("append").parquet(path)

    for r in asked.toLocalIterator():
        block.append((r["cid"], bytes(r["vec"])))
        if len(block) >= QUERY_BLOCK:
            flush()
    if block:
        flush()
    return spark.read.parquet(path)


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, F.col("vec_id") % 50 == 0)
