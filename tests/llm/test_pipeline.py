import os
import subprocess
import sys

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__
from loglane.llm import queries

from .helpers import SCHEMA, documents, frame, prose

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_copies", "repeats", "packing"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_gives_the_same_rows(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = queries.REGISTRY[name](spark, SF)
    cur = db.execute(queries.SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(got.columns)
    want = sorted((tuple(dict(zip(cols, r))[c] for c in sorted(cols)) for r in cur.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in sorted(cols)) for r in got.collect()), key=str) == want


@pytest.mark.parametrize("name", [n for n in queries.REGISTRY if n not in queries.SQL])
def test_query_covers_its_table(spark, name):
    from pyspark.sql import functions as F

    df = queries.REGISTRY[name](spark, SF)
    table = {"op2_ann": "embeddings", "op4_html_text": "pages", "op9_url_filter": "pages",
             "op13_whitening": "embeddings"}.get(name, "documents")
    key = {"embeddings": "vec_id", "pages": "page_id"}.get(table, "doc_id")
    ids = spark.read.parquet(f"{SF}/{table}.parquet").select(F.col(key).alias("i"))
    if name == "op2_ann":
        ids, key = ids.where("i % 50 = 0"), "query_id"
    assert {r[0] for r in df.select(key).distinct().collect()} == {r[0] for r in ids.collect()}


def run_stages(spark, docs, sf_dir, tmp):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        out[name] = docs
    return out


def test_stages_on_awkward_rows(spark, tmp_dir):
    rows = documents() + [(200 + i, prose(200 + i, 90), "en", "s", 1) for i in range(8)]
    df = frame(spark, rows)
    out = run_stages(spark, df, SF, tmp_dir)
    for name in ("toxicity", "quality", "near_copies", "repeats"):
        assert out[name].columns == df.columns
    for name in ("quality", "near_copies", "repeats"):
        assert out[name].where("n_chars != length(text)").count() == 0
    ids = [r["doc_id"] for r in out["near_copies"].select("doc_id").collect() if r["doc_id"] is not None]
    assert sorted(ids) == sorted([*set(ids), 22]) and {200, 207, 1, 10, 11, 12} <= set(ids) and not {2, 3, 5, 6, 23} & set(ids)
    text = {r["doc_id"]: r["text"] for r in out["repeats"].collect()}
    assert prose(2, 30)[:50] in text[10] and prose(2, 30)[:50] not in text[11]
    assert out["packing"].agg({"length": "max"}).first()[0] <= 1024


def test_near_copies_by_rows_not_by_ids(spark):
    """Different texts of one id stay, near copies without ids go, clean rows stay."""
    a, b = prose(1, 120), prose(2, 120)
    near = a.replace(a.split()[40], "changed")
    rows = [(7, a), (7, b), (7, a), (3, near), (None, near), (None, a), (None, prose(3, 90)), (None, prose(3, 90)), (9, None), (None, ""), (None, None)]
    for extra in ([], [(50, prose(5, 80))]):
        df = frame(spark, [(i, t, "en", "s", 0) for i, t in rows + extra]).selectExpr("*", "'r' as row_id")
        got = corpus_pipeline.drop_near_copies(spark, df, SF)
        assert got.columns == df.columns
        kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
        texts = [t for _, t in kept]
        assert (3, near) in kept and texts.count(near) == 1 and texts.count(a) == 0  # the smallest id of the group
        assert texts.count(b) == 1 and texts.count(prose(3, 90)) == 1
        assert texts.count(None) == 2 and texts.count("") == 1  # these link with nothing


def test_stages_on_an_empty_table(spark, tmp_dir):
    out = run_stages(spark, frame(spark, []), SF, tmp_dir)
    assert all(df.count() == 0 for df in out.values())


def test_extra_and_clashing_columns_pass_through(spark, tmp_dir):
    rows = [(i, prose(i, 80), "en", "s", 0, "a", "b") for i in range(4)]
    df = frame(spark, rows, SCHEMA + ", kept string, score string")
    for c in ("score_in", "Predicted", "predicted_in", "w", "w_", "_w", "_r", "row_id", "row", "t"):
        df = df.selectExpr("*", f"'{c}' as {c}")
    out = run_stages(spark, df, SF, tmp_dir)
    assert out["repeats"].columns == df.columns
    assert {(r["kept"], r["score"], r["score_in"], r["Predicted"], r["w"], r["row"]) for r in out["repeats"].collect()} == {
        ("a", "b", "score_in", "Predicted", "w", "row")}


def test_library_imports_without_the_subpackage(tmp_path):
    """The entry module still works when the subpackage's folders are absent."""
    import shutil

    shutil.copytree(f"{ROOT}/loglane", tmp_path / "loglane", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), len(e.queries()) > 20)"
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(p for p in sys.path if p and not p.startswith(ROOT))}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.stdout.split() == ["0", "True"], out.stderr
