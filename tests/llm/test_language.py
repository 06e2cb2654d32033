import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from loglane.llm import cross_parsing as cp

from .helpers import documents, frame, prose

SF = "/root/testdata/sf0.01"


def counted(data: bytes, sample: bytes) -> int:
    """Phrases by trying every length, window by window."""
    n = 0
    for at in range(0, len(data), cp.WINDOW):
        part, i = data[at:at + cp.WINDOW], 0
        while i < len(part):
            k = 1
            while i + k < len(part) and part[i:i + k + 1] in sample:
                k += 1
            i += k
            n += 1
    return n


@settings(max_examples=40, deadline=None)
@given(st.text("abc d", max_size=40).map(str.encode), st.lists(st.text("abcdé ", max_size=60).map(str.encode), max_size=6))
def test_phrases_equal_trying_every_length(sample, texts):
    found = cp.Automaton(sample)
    windows, owner = cp.windows_of(texts)
    got = np.zeros(len(texts), int)
    np.add.at(got, owner, found.phrases(windows))
    assert got.tolist() == [counted(t, sample) for t in texts]


def test_long_texts_are_parsed_whole():
    sample, text = prose(1, 300).encode(), cp.normalised(prose(2, 1500) + " ß" * 700 + prose(1, 300))
    assert len(text) > 5 * cp.WINDOW
    model = cp.Model({"a": sample, "b": prose(3, 300).encode()})
    cost = model.parsers()[0][2]
    assert model.bits([text, b"", b"x"])[0, 0] == counted(text, sample) * cost
    lot, cp.LOT_BYTES = cp.LOT_BYTES, 2 * cp.WINDOW
    try:
        assert model.bits([text, text])[1, 0] == counted(text, sample) * cost
    finally:
        cp.LOT_BYTES = lot


def test_held_out_rows_of_the_table(spark):
    rows = {r["doc_id"]: r for r in cp.op11_language(spark, SF).collect()}
    want = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == want.keys()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in want[i]["text"] or ""))
    judged = [rows[i]["lang_pred"] == want[i]["lang"] for i in rows if rows[i]["held_out"] and rows[i]["lang_pred"] != "und"]
    assert np.mean(judged) > 0.98


def test_labels_of_held_out_rows_and_other_columns_are_not_read(spark):
    rows = [(i, f"{w} {w}x text" * 5, lang, "s", 1) for lang, w in (("aa", "kolo"), ("bb", "pimi")) for i in range(lang == "bb", 80, 2)]
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    lied = [(i, t, "zz" if held(i) else lang, "other", 9) for i, t, lang, *_ in rows]
    got = [{(r["doc_id"], r["lang_pred"], r["score"]) for r in cp.predict(frame(spark, x), cp.fit(frame(spark, x))).collect()}
           for x in (rows, lied)]
    assert got[0] == got[1] and {x[1] for x in got[0]} == {"aa", "bb"}


def test_awkward_rows(spark):
    rows = [(i, t, "x" if i and i % 2 else "y", s, n) for i, t, _, s, n in documents()]
    rows += [(50, "123 #!", "x", None, None), (51, None, None, None, None), (52, "word", None, None, 1), (53, "漢字かな", "z", "", 4)]
    df = frame(spark, rows, "doc_id long, text string, lang string, score string, lang_pred int")
    model = cp.fit(df)
    got = cp.predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (5, 6, 9, 50, 51))
    assert by[1]["lang_pred"] == by[2]["lang_pred"] and by[1]["score"] == by[2]["score"]
    assert by[52]["lang_pred"] in {"x", "y", "z"}
    empty = frame(spark, [])
    assert cp.predict(empty, cp.fit(empty)).count() == 0
    nothing = cp.predict(df, cp.Model({})).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_the_sample_is_bounded(spark):
    hot = prose(1, 200)
    rows = [(7, hot, "aa", "", 0)] * 300 + [(8, prose(i, 60), "aa", "", 0) for i in range(300)] + [
        (1000 + i, prose(i, 40), f"l{i % 30:02}", "", 0) for i in range(300)]
    model = cp.fit(frame(spark, rows), sample_bytes=2048, total_bytes=20_000, max_languages=20)
    assert len(model.samples) == 20 and "aa" in model.samples
    assert sum(len(s) for s in model.samples.values()) <= 20_000 + 20 * cp.PIECE_BYTES
    pieces = [p for p in model.samples["aa"].split(cp.GAP)]
    assert len(pieces) == len(set(pieces))
