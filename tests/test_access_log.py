"""Golden vectors for the trading-line parsers (FIXTURES §3.1)."""

import pytest

from loglane.operators import access_log as al

H = "XA\t4\t3\t00:00:00.028\t49.206.98.46\t'11820785': login ("
P = ", cid: d0ccc64, point: Gate North 1, ping: 20.56 ms, geo: "
PT = "point: Gate North 1"

VECTORS = {
    "A1": (H + "Client iPhone build 5545" + P + "IN, Chennai, Atria)",
           ("d0ccc64", "Client iPhone", PT, "no"), ("d0ccc64", "Client iPhone", PT, "no")),
    "A2": (H + "Client iPhone build 5545, investor" + P + "IN, Chennai, Atria)",
           ("unknown", "Client iPhone", "cid: d0ccc64", "yes"), ("d0ccc64", "Client iPhone", PT, "yes")),
    "A3": (H + "Client build 5660" + P + "IN, Chennai, Atria)",
           ("d0ccc64", "Client", PT, "no"), ("d0ccc64", "Client", PT, "no")),
    "A4": ("cid: only", ("unknown", "unknown", "Unknown", "no"), ("only", None, None, "no")),
    "A5": (H + "Client iPhone build 5545" + P + "GB, London, investor Bank)",
           ("d0ccc64", "Client iPhone", PT, "yes"), ("d0ccc64", "Client iPhone", PT, "no")),
    "A6": (H + "Client X" + P + "IN)", ("d0ccc64", "Client X", PT, "no"), ("d0ccc64", "Client X", PT, "no")),
    "A7": (H + "Client iPhone build 5545" + P + "DE, Border Telecom)",
           ("d0ccc64", "Client iPhone", PT, "no"), ("d0ccc64", "Client iPhone", PT, "no")),
}


def _lines(spark, items):
    return spark.createDataFrame([(k, "trading_20260318.log", v) for k, v in items], "id string, file_name string, line string")


def test_strict_vectors(spark):
    df = _lines(spark, [(k, v[0]) for k, v in VECTORS.items()])
    out = {r["id"]: r for r in al.parse_strict(df, keep=["id"]).collect()}
    for k, (_, strict, _) in VECTORS.items():
        r = out[k]
        assert (r["cid"], r["device"], r["server"], r["investor"]) == strict, k
        assert r["flag"] == "pending" and str(r["log_date"]) == "2026-03-18"
        if k != "A4":
            assert (r["log_time"], r["ip"], r["login"]) == ("00:00:00.028", "49.206.98.46", "11820785")
        else:
            assert (r["log_time"], r["ip"], r["login"]) == ("Unknown", "Unknown", "Unknown")


def test_labelled_vectors(spark):
    df = _lines(spark, [(k, v[0]) for k, v in VECTORS.items()])
    out = {r["id"]: r for r in al.parse_labelled(df, keep=["id"]).collect()}
    for k, (_, _, lab) in VECTORS.items():
        r = out[k]
        assert (r["cid"], r["device"], r["server"], r["investor"]) == lab, k


def test_empty_line_strict_like_a4(spark):
    df = _lines(spark, [("e", "")])
    r = al.parse_strict(df, keep=["id"]).first()
    assert (r["log_time"], r["ip"], r["login"], r["cid"], r["device"], r["server"]) == (
        "Unknown", "Unknown", "Unknown", "unknown", "unknown", "Unknown")


def test_cid_filter_and_key(spark):
    rows = [("a", "  " + VECTORS["A1"][0] + " \t"), ("b", "XA\t4\t3\tt\tip\t'9': logout (X)"),
            ("c", "cid: only"), ("d", "XA\t4\t3\tt\tip\t'': login (cid: z")]
    df = al.cid_filter(_lines(spark, rows))
    got = {r["id"]: (r["line"], r["key"]) for r in df.select("id", "line", al.login_key("line").alias("key")).collect()}
    assert set(got) == {"a", "c", "d"}
    assert got["a"] == (VECTORS["A1"][0], "11820785")
    assert got["c"][1] is None and got["d"][1] is None


def test_length_rejects(spark):
    long_dev = H + "Client " + "Q" * 120 + " build 1" + P + "IN)"
    df = _lines(spark, [("ok", VECTORS["A1"][0]), ("long", long_dev)])
    valid, rej = al.split_by_length(al.parse_strict(df, keep=["id"]))
    assert [r["id"] for r in valid.collect()] == ["ok"]
    r = rej.first()
    assert r["id"] == "long" and r["reason"] == "device longer than 100"


def test_strict_reads_the_parts_a_line_was_built_from(spark):
    """Lines are joined from drawn parts; the parse must give the parts back."""
    pytest.importorskip("hypothesis")
    from hypothesis import given, settings, strategies as st

    word = st.text("abcxyz0189", min_size=1, max_size=6)
    part = st.fixed_dictionaries({
        "time": word, "ip": word, "login": st.one_of(st.just(""), word), "device": word, "build": st.booleans(),
        "investor": st.booleans(), "cid": word, "point": st.one_of(st.none(), word),
        "geo": st.lists(word, max_size=3), "pad": st.sampled_from(["", " ", "  "])})

    def line(p):
        head = f"{p['device']} build 7" if p["build"] else p["device"]
        pieces = [f"Q\t4\t3\t{p['time']}\t{p['ip']}\t'{p['login']}': login ({head}"]
        pieces += [" investor"] * p["investor"] + [f" cid: {p['cid']}"]
        if p["point"] is not None:
            pieces += [f" point: {p['point']}{p['pad']}", *p["geo"]]
        return ",".join(pieces)

    def want(p):
        rest = [f"cid: {p['cid']}"] + ([f"point: {p['point']}"] if p["point"] is not None else [])
        shifted = ["investor", *rest] if p["investor"] else rest
        cid = "unknown" if p["investor"] else p["cid"]
        server = shifted[1] if len(shifted) > 1 else "Unknown"
        return (p["time"], p["ip"], p["login"], cid, p["device"], server, "yes" if p["investor"] else "no")

    @settings(max_examples=1, deadline=None)
    @given(st.lists(part, min_size=20, max_size=60))
    def check(batch):
        df = spark.createDataFrame([(i, "trading_20260318.log", line(p)) for i, p in enumerate(batch)],
                                   "id int, file_name string, line string")
        got = {r["id"]: tuple(r[c] for c in ("log_time", "ip", "login", "cid", "device", "server", "investor"))
               for r in al.parse_strict(df, keep=["id"]).collect()}
        for i, p in enumerate(batch):
            assert got[i] == want(p), line(p)

    for _ in range(5):
        check()


def test_valid_plus_rejects_is_cid_lines(spark):
    from loglane.plans.queries import day_lines
    kept = al.cid_filter(day_lines(spark, "/root/testdata/sf0.001"))
    valid, rej = al.split_by_length(al.parse_strict(kept))
    assert valid.count() + rej.count() == kept.count() > 0


def test_labelled_matches_python_regex(spark):
    pytest.importorskip("hypothesis")
    import re

    from hypothesis import given, settings, strategies as st

    pieces = st.sampled_from(["'7': login (", "Client X", " build 5", ", investor", ", cid: ab", ", point: P 1",
                              ", geo: a, b", ")", "\t", " ", "cid: ", "point: ", ",", "(", "'"])
    lines = st.lists(pieces, max_size=12).map("".join)

    def py(line):
        def ex(p):
            m = re.search(p, line)
            return m.group(1) if m else None
        return (ex(al.LABEL_LOGIN), ex(al.LABEL_CID), ex(al.LABEL_DEVICE), ex(al.LABEL_POINT),
                "yes" if re.search(al.LABEL_INVESTOR, line) else "no")

    @settings(max_examples=1, deadline=None)
    @given(st.lists(lines, min_size=30, max_size=60))
    def check(batch):
        df = spark.createDataFrame([(i, "trading_20260318.log", s) for i, s in enumerate(batch)],
                                   "id int, file_name string, line string")
        got = {r["id"]: (r["login"], r["cid"], r["device"], r["server"], r["investor"])
               for r in al.parse_labelled(df, keep=["id"]).collect()}
        for i, s in enumerate(batch):
            assert got[i] == py(s), repr(s)

    for _ in range(4):
        check()
