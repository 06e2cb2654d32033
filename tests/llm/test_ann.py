import random

import numpy as np
from pyspark.sql import functions as F

from loglane.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score int"


def vectors(n=400, dim=16):
    r = np.random.default_rng(1)
    x = r.normal(size=(n, dim)).astype(np.float32)
    if n > 200:
        x[100:130] = x[0]  # a common vector
        x[200] = 2 * x[50]
    return x


def table(spark, x, more=()):
    return spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)] + list(more), SCHEMA)


def brute(x, ids, q, k=5):
    x = x.astype(np.float64)
    s = x @ x[q] / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[q]))
    order = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-round(s[i], 12), ids[i]))
    return [(ids[i], s[i]) for i in order[:k]]


def test_recall_scores_and_ties(spark):
    x = vectors()
    bad = [(1000, None, 0), (1050, [], 0), (1100, [0.0] * 16, 0), (1150, [float("nan")] * 16, 0), (1200, [None] + [1.0] * 15, 0),
           (1250, [float("inf")] * 16, 0), (None, [1.0] * 16, 0), (1300, [1.0, 2.0], 0), (3, x[3].tolist(), 0)]
    got = {}
    for r in ann.nearest(table(spark, x, bad), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in range(400) if i % 50 == 0}
    hits = total = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        want = brute(x, list(range(400)), q)
        hits += len({i for i, _ in want} & {i for _, i, _ in rows})
        total += 5
        for _, i, s in rows:
            a, b = x[q].astype(float), x[i].astype(float)
            assert abs(s - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) < 1e-12
    assert hits >= 0.9 * total
    assert [i for _, i, _ in got[0]] == [100, 101, 102, 103, 104]
    assert [i for _, i, _ in got[100]] == [0, 101, 102, 103, 104]


def test_few_candidates_and_empty(spark):
    x = vectors(4, 8)
    x[1:] = -x[0] + np.eye(4, 8, dtype=np.float32)[1:4]
    got = ann.nearest(table(spark, x), F.col("vec_id") == 0, probes=1).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [i for i, _ in brute(x, list(range(4)), 0)]
    assert ann.nearest(table(spark, x[:0]), F.col("vec_id") == 0).count() == 0


def test_probing_order_and_validity():
    sets = ann.perturbations(6, 100)
    assert sets[0] == () and sets[1] == (1,) and len(set(sets)) == 100
    assert not any(13 - j in s for s in sets for j in s)


def test_own_bucket_is_visited_first_and_splits_lose_nothing(spark):
    x = vectors(64, 12).astype(float)
    own = ann.own_buckets(x, 4, 5, 1.5)
    assert (ann.visited_buckets(x, 4, 5, 1.5, 10)[:, :, 0] == own).all()
    a = ann.nearest(table(spark, vectors()), F.col("vec_id") % 50 == 0)
    b = ann.nearest(table(spark, vectors()), F.col("vec_id") % 50 == 0, bucket_rows=8)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(a) == key(b)


def test_ties_between_equal_scores(spark):
    r = random.Random(0)
    rows = [(i, [float(r.choice((-1, 1))), 1.0, 0.0, 0.0], 0) for i in range(60)]
    got = sorted((x["rank"], x["vec_id"]) for x in ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect())
    same = [i for i, v, _ in rows[1:] if v == rows[0][1]][:5]
    assert [v for _, v in got] == same
