import math

import numpy as np
import pytest

from loglane.llm import whitening as wh

SF = "/root/testdata/sf0.001"


def stated(rows, top=16):
    """Every value of the contract from a dense eigenvalue routine."""
    def good(v):
        return v and all(c is not None and math.isfinite(c) for c in v)

    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if good(v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    y = np.array([[n * x[j] - s[j] for j in range(d)] for x in fit], float) / n
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:top], v[:, ::-1][:, :top]
    out = {}
    for i, x in kept:
        c = [n * x[j] - s[j] for j in range(d)]
        out.setdefault(i, []).append((n, sum(k * k for k in c), (np.array(c, float) / n) @ v, e, float(np.trace(cov))))
    return out


def compare(got, want, top):
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert by.keys() == want.keys()
    signs = {}
    for i, copies in want.items():
        n, dev, proj, e, trace = copies[0]
        assert sorted(by[i]) == list(range(1, min(top, len(e)) + 1))
        for k, rows in by[i].items():
            assert len(rows) == len(copies)
            for r in rows:
                assert r["n"] == n and r["deviation"] == dev and r["identity_error"] <= 1e-4
                assert r["explained"] == pytest.approx(e[k - 1] / trace, rel=1e-4)
                if e[k - 1] > 1e-9 * trace:
                    z = proj[k - 1] / math.sqrt(e[k - 1])
                    sign = signs.setdefault(k, 1 if abs(r["whitened"] - z) <= abs(r["whitened"] + z) or abs(z) < 1e-6 else -1)
                    assert r["whitened"] == pytest.approx(sign * z, abs=1e-7)
                else:
                    assert r["whitened"] is None


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_registered_query_equals_a_dense_routine(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = wh.op13_whitening(spark, SF).collect()
    want = stated(rows)
    top = {k: max(want, key=lambda i: abs(want[i][0][2][k])) for k in range(16)}
    sign = {}
    for r in got:  # a sign per component, read off the row where it shows best
        k = r["component"] - 1
        if r["vec_id"] == top[k]:
            sign[k] = math.copysign(1, r["whitened"] * want[top[k]][0][2][k])
    assert len(got) == 16 * len(rows)
    for r in got:
        n, dev, proj, e, trace = want[r["vec_id"]][0]
        k = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, dev) and r["identity_error"] < 1e-9
        assert r["whitened"] == pytest.approx(sign[k] * proj[k] / math.sqrt(e[k]), abs=1e-8)
        assert r["explained"] == pytest.approx(e[k] / trace, rel=1e-9)


def test_awkward_rows(spark):
    r = np.random.default_rng(3)
    good = [(i, r.normal(size=5).tolist()) for i in range(30)]
    rows = good + [(3, good[3][1])] * 40 + [(90, good[4][1]), (100, None), (101, []), (102, [1.0, None, 2.0, 0.0, 0.0]),
                                             (103, [math.nan] * 5), (104, [math.inf, 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (None, good[5][1])]
    w = wh.fit_whitening(table(spark, rows))
    got = wh.whiten(table(spark, rows), w).collect()
    compare(got, stated([x for x in rows if x[0] != 105]), 16)
    assert {x["n"] for x in got} == {30}


def test_null_spaces_and_tiny_tables(spark):
    flat = [(i, [float(i % 7), 2.0 * (i % 7), 0.5, float(i % 3)]) for i in range(50)]  # rank 2
    got = wh.whiten(table(spark, flat), wh.fit_whitening(table(spark, flat))).collect()
    compare(got, stated(flat), 16)
    assert {x["component"] for x in got if x["whitened"] is None} == {3, 4}
    one = [(1, [0.25, 0.5]), (2, [0.25, 0.5])]
    got = wh.whiten(table(spark, one), wh.fit_whitening(table(spark, one))).collect()
    assert len(got) == 4 and all(x["whitened"] is None and x["deviation"] == 0 and x["identity_error"] == 0 for x in got)
    for none in ([], [(1, None)]):
        assert wh.fit_whitening(table(spark, none)) is None


def test_sums_stay_exact(spark):
    big = spark.createDataFrame([(1, [1e13, -1e13]), (2, [1e13 + 1, 0.5]), (3, [-1e13, 3.0]), (4, [1e15, 0.0])],
                                "vec_id long, embedding array<double>")
    w = wh.fit_whitening(big)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in ([1e13, -1e13], [1e13 + 1, 0.5], [-1e13, 3.0])]
    assert (w.n, w.sums) == (3, [sum(v[j] for v in x) for j in (0, 1)])  # 64e15 is out of range
    got = {r["vec_id"]: r["deviation"] for r in wh.whiten(big, w).collect()}
    assert got.keys() == {1, 2, 3} and set(got.values()) == {None}


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["random", "equal", "graded", "two values", "one value", "diagonal"])
def test_components_of_matrices(n, kind):
    r = np.random.default_rng(n)
    q, _ = np.linalg.qr(r.standard_normal((n, n)))
    e = {"random": r.random(n), "equal": np.ones(n), "graded": 10.0 ** -np.arange(n).clip(0, 18), "two values": 1.0 + (np.arange(n) % 2),
         "one value": np.eye(n)[0], "diagonal": r.random(n)}[kind]
    a = np.diag(e) if kind == "diagonal" else (q * e) @ q.T
    a = (a + a.T) / 2
    values, v = wh.spectral_components(a, 16)
    assert np.allclose(values, np.sort(e)[::-1][:16], atol=1e-13)
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-13) and np.allclose(a @ v, v * values, atol=1e-12)


def test_polar_factor_is_orthogonal():
    a = np.random.default_rng(1).standard_normal((20, 20))
    a = a + a.T
    u = wh.polar_factor(a)
    assert np.allclose(u @ u, np.eye(20), atol=1e-12) and np.linalg.eigvalsh(u @ a).min() > 0
