import random
import re
from collections import Counter

import numpy as np

from loglane.llm import quality, toxicity

from .helpers import SCHEMA, WORD, documents, frame, prose


def measured(text):
    t = text or ""
    w = WORD.findall(t)
    win = Counter(zip(w, w[1:], w[2:]))
    cover = {p for i in range(len(w) - 2) if win[w[i], w[i + 1], w[i + 2]] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))


def test_measures_equal_a_plain_statement(spark):
    extra = [(100, "a b c a b c a b", "", "", 0), (101, "x y z " * 40, "", "", 0), (102, "\n".join(["one line"] * 5) + "\n\n \n", "", "", 0),
             (103, "a b c d e", "", "", 0), (104, "#*$ %&| <>", "", "", 0)]
    rows = documents() + extra
    df = frame(spark, rows, SCHEMA.replace("lang", "kept").replace("source", "n_words"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = Counter((r["doc_id"], *(r[n] for n in names), r["base_failed"]) for r in quality.line_clean(df).collect())
    want = Counter()
    for i, t, *_ in rows:
        m = measured(t)
        want[i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]] += 1
    assert got == want
    assert quality.line_clean(frame(spark, [])).count() == 0


def test_lines_are_cleaned_first(spark):
    good = prose(1, 96)
    menu = "Home | News | Sport | Contact"
    rows = [(1, good), (2, f"{menu}\n{good}\nAll rights reserved."), (3, "\n".join(f"{w}%%% {w}*** {w}###" for w in good.split())),
            (4, "\n".join([menu] * 3 + [f"Item {i} | Item {i + 1} | Item {i + 2}" for i in range(40)] + good.split("\n")[:2]))]
    got = {r["doc_id"]: r for r in quality.line_clean(frame(spark, [(i, t, "", "", 0) for i, t in rows])).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert got[1]["clean_text"] == got[2]["clean_text"] == good


def training_table(n=600, seed=3):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = prose(i + 10, 40).split()
        toxic = i % 7 == 0
        if toxic:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(["vilething", "grubber", "zorkest" + r.choice("abcdef") + "x"]))
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_rows_are_judged_well(spark):
    docs, labels = training_table()
    d = frame(spark, docs + [(9000, None, "", "", 0), (9001, "", "", "", 0), (None, "vilething grubber zorkestax", "", "", 0)])
    y = spark.createDataFrame(labels + [(5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(d, y)
    got = {r["doc_id"]: r for r in toxicity.score_documents(d.withColumnRenamed("source", "score"), model).collect()}
    held = [i for i in range(600) if __import__("zlib").crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i]["predicted"] == labels[i][2] for i in held]) >= 0.97
    assert got[9000]["score"] == got[9001]["score"] < 0.3 and got[None]["predicted"] == 1
    assert {"vilething", "grubber"} <= set(model.terms) and "zork*" in model.terms
    assert model.scorer()("nothing here") == model.scorer()(None)


def test_without_labels(spark):
    d = frame(spark)
    y = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.score_documents(d, toxicity.fit(d, y)).collect()
    assert len(out) == len(documents()) and {r["predicted"] for r in out} == {0}
    assert toxicity.score_documents(frame(spark, []), toxicity.fit(frame(spark, []), y)).count() == 0


def test_label_model_discounts_correlated_voters():
    r = np.random.default_rng(1)
    y = (r.random(4000) < 0.2).astype(int)
    strong = (r.random(4000) < np.where(y, 0.7, 0.02)).astype(float)
    weak = (r.random(4000) < np.where(y, 0.5, 0.1)).astype(float)
    votes = np.stack([strong, weak, weak, weak], axis=1)
    p, (a, b), weight = toxicity.label_model(votes, np.where(r.random(4000) < 0.3, y, -1))
    assert weight[0] > 1.5 * weight[1]
    assert a[0] / b[0] > a[1] / b[1]
    assert p[y == 1].mean() > 2 * p[y == 0].mean()
    assert abs(p.mean() - y.mean()) < 0.08  # neither label wins by drift


def test_patterns_compile():
    assert all(re.search(p, s) for p, s in zip(toxicity.PATTERNS, ["you are an idiot", "shut up"]))
