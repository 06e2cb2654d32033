"""A third of the rows on one id or one row: how work is dealt, and equal scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglane.llm import ann, common, packing, quality, suffix_dedup, toxicity, url_filter

from .helpers import frame, prose


def shares(df, column):
    n = [r["count"] for r in df.groupBy(column).count().collect()]
    return max(n) / (sum(n) / len(n))


def test_equal_pieces_are_dealt_to_all_shards(spark):
    df = spark.createDataFrame([(7, "same text")] * 4000, "doc_id long, text string").repartition(8)
    got = packing.pack_documents(df, shard_docs=500)
    assert shares(got.withColumn("shard", F.shiftright("sequence_id", 32)), "shard") < 1.5
    placed = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got.collect())
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(placed, placed[1:])) and len(placed) == 4000


def test_an_id_of_many_texts_is_dealt_to_all_slices(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("doc_id"),
                                  F.concat(F.lit("text "), "id").alias("text"))
    assert shares(common.with_slice(df, 16), "slice") < 1.3


def test_repeats_of_shared_ids_in_small_slices(spark):
    """Rows that share an id never remove from each other, in whichever slices they lie."""
    shared = prose(1, 30)
    rows = [(5, prose(10 + i, 20) + shared) for i in range(12)] + [(9, shared + prose(50, 20)), (None, prose(51, 20) + shared)]
    df = frame(spark, [(i, t, "", "", 0) for i, t in rows])
    got = suffix_dedup.remove_repeats(df, slice_bytes=300).collect()
    assert {(r["doc_id"], r["n_removed"] > 0) for r in got} == {(5, False), (9, True), (None, True)}


def test_equal_scores_of_distinct_vectors_rank_by_id(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=8).astype("float32")
    rows = [(0, base.tolist())] + [(i, (base * 2.0 ** (i % 20 - 10)).tolist()) for i in range(1, 41)]
    rows += [(100 + i, r.normal(size=8).astype("float32").tolist()) for i in range(40)]
    r.shuffle(rows)
    df = spark.createDataFrame([(int(i), v) for i, v in rows], "vec_id long, embedding array<float>")
    for probes in (4, ann.PROBES):
        got = ann.nearest(df, F.col("vec_id") == 0, probes=probes).orderBy("rank").collect()
        assert [x["vec_id"] for x in got] == [1, 2, 3, 4, 5]


def test_a_labelled_id_that_repeats_is_one_row_of_the_sample(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 4).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.createDataFrame([(4, 1), (4, 1), (5, 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels)
    assert rows.count() == docs.where(~toxicity.held_out()).select("doc_id").distinct().count()


def test_a_sentence_with_a_phrase_is_no_boilerplate(spark):
    article = prose(1, 200).replace("\n", " ") + " The privacy policy of the firm was debated for hours. " + prose(2, 200).replace("\n", " ")
    rows = [(1, article), (2, prose(3, 60) + "\nRead our privacy policy.")]
    got = {r["doc_id"]: r for r in quality.line_clean(frame(spark, [(i, t, "", "", 0) for i, t in rows])).collect()}
    assert got[1]["kept"] and got[1]["clean_text"] == article
    assert got[2]["kept"] and "privacy" not in got[2]["clean_text"]


def test_entropy_counts_every_character(spark):
    from math import log2

    texts = ["", "a", "aa", "ab", "aAbB%%==", "日本日本x", "/" * 50 + "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", url_filter._entropy(F.col("t")).alias("e"))
    for r in df.collect():
        n = len(r["t"])
        want = sum(-r["t"].count(c) / n * log2(r["t"].count(c) / n) for c in set(r["t"]))
        assert r["e"] == pytest.approx(want, abs=1e-12)


def test_suffixes_do_not_share_statistics(spark):
    """An unlabelled domain keeps the neutral rate, however many labelled ones there are."""
    rows = [(i, f"http://d{i}.bad/x", "block") for i in range(1500)] + [(2000 + i, f"http://d{i}.good/x", "allow") for i in range(1500)]
    rows += [(9000 + i, f"http://d{i}.{'bad' if i % 2 else 'good'}/y", None) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    for c in ("y", "v", "p", "r", "q", "f_len", "k_host", "k_host_rate", "row", "_p"):
        df = df.withColumn(c, F.lit(c))
    got = url_filter.gbt_verdicts(url_filter.with_host_path(df), "verdict").where("verdict is null").collect()
    assert all(r["model_verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in got)
    assert all(r["p"] == "p" and r["f_len"] == "f_len" for r in got)


def test_host_path_and_rule_in_sql(spark):
    """The explicit part of the filter as DuckDB states it, over the whole table."""
    import duckdb

    sf = "/root/testdata/sf0.001"
    want = duckdb.sql(f"""
      with u as (select page_id, coalesce(case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end, '') as rest
                 from '{sf}/pages.parquet'),
      p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_replace(regexp_extract(rest, '^[^?#]*'), '^[^/]*', '') as path from u),
      r(kind, h, s) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                               ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
      select page_id, host, path, (select h || s from r where (host = h or ends_with(host, '.' || h)) and starts_with(path, s)
                                   order by length(h || s) desc limit 1) as rule from p""").fetchall()
    got = url_filter.op9_url_filter(spark, sf).select("page_id", "host", "path", "rule").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_placement_equals_trying_every_open_bin():
    """Longest first, each to the bin after which the squared counts per gap sum to least."""
    r = np.random.default_rng(8)
    for size, n in ((10, 60), (32, 200), (100, 150)):
        lengths = r.integers(1, size + 1, n)
        sequence, offset = packing.pack(lengths, size)
        bins: dict[int, int] = {}  # bin: gap
        for i in np.argsort(-lengths, kind="stable").tolist():
            s = int(lengths[i])

            def squares(b):
                gaps = [g for k, g in bins.items() if k != b] + [bins[b] - s]
                return sum(gaps.count(g) ** 2 for g in set(gaps) - {0})

            fit = [b for b, g in bins.items() if g >= s]
            if fit:
                best = min(squares(b) for b in fit)
                assert int(sequence[i]) in fit and squares(int(sequence[i])) == best
            else:
                assert int(sequence[i]) not in bins
                bins[int(sequence[i])] = size
            b = int(sequence[i])
            assert offset[i] == size - bins[b]
            bins[b] -= s


def test_very_long_urls(spark):
    rows = [(1, "http://a.com/" + "x/é%" * 60_000, ), (2, "http://b.net/es/" + "?" * 100_000), (3, "http://" + "h." * 50_000 + "net/fr/")]
    got = {x["page_id"]: x for x in url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [got[i]["verdict"] for i in (1, 2, 3)] == ["allow", "block", "block"]
