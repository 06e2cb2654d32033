import gzip
import hashlib
import io
import random
import time

import pytest
from pyspark.sql import functions as F

from loglane.llm import html_text, url_filter, warc

PAGES = "page_id long, url string, html string, host string"


def page(title, body, menu="Home"):
    return (f"<html><head><title>{title}</title><script>var a='<p>no</p>';</script></head><body><nav><a href='/'>{menu}</a></nav>"
            f"<article><h1>{title}</h1>{body}</article><footer>&copy; x</footer></body></html>")


# --- main text -------------------------------------------------------------------


def text_of(html, neighbour=None):
    return html_text.main_text(html_text.lines_of(html), html_text.lines_of(neighbour) if neighbour else None)


def test_article_without_surroundings():
    body = ("<p>First  &amp;\n second</p><div class='ad'>Buy</div><aside>Side</aside><p>Third<br>line</p>"
            "<section id=comments><article><p>Nice!</p></article></section><form><p>Mail</p></form>")
    assert text_of(page("T", body)) == "T\n\nFirst & second\n\nThird line"


def test_shared_lines_go_outside_a_marked_article():
    a = "<body><div>Site name</div><p>Text of a.</p><p>More of a.</p><div>About us</div></body>"
    b = "<body><div>Site name</div><p>Text of b.</p><div>About us</div></body>"
    assert text_of(a, b) == "Text of a.\n\nMore of a."
    assert text_of(a) == "Site name\n\nText of a.\n\nMore of a.\n\nAbout us"


def test_marked_article_keeps_shared_lines():
    assert text_of(page("A", "<p>Same.</p><p>Own.</p>"), page("B", "<p>Same.</p>")) == "A\n\nSame.\n\nOwn."


def test_broken_markup():
    assert text_of(None) == "" and text_of("") == "" and text_of("<p") == ""
    assert text_of("<div class=menu><ul><li>x<article><p>In<b>side</p>") == "Inside"
    assert text_of("<!-- open <p>x</p>") == ""
    assert text_of("plain &lt;b&gt; text") == "plain <b> text"
    assert text_of("<p>a < b</p>") == "a < b"


def test_alignment_is_a_longest_common_subsequence():
    r = random.Random(1)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for _ in range(500):
        a, b = ([r.choice("abcd") for _ in range(r.randint(0, 14))] for _ in range(2))
        got = [a[i] for i in sorted(html_text.common_lines(a, b))]
        rest = iter(b)
        assert len(got) == longest(a, b) and all(x in rest for x in got)


def test_extract_pairs_pages_of_a_host(spark):
    def plain(text):
        return f"<body><div>Menu of site</div><p>{text}</p><div>Imprint</div></body>"

    rows = [(1, "http://a.org/x/1", plain("one"), "h"), (2, "http://a.org/x/2", plain("two"), "h"),
            (3, "http://b.org/x/1", plain("three"), "h"), (4, None, None, "h"), (5, "http://a.org/x/3", "", "h"),
            (6, "http://c.org/", plain("same"), "h"), (6, "http://c.org/", plain("same"), "h")]
    df = spark.createDataFrame(rows, PAGES).coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {(r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract_text(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    whole = "Menu of site\n\n{}\n\nImprint"
    assert got == {(1, "one", 3), (2, "two", 3), (3, whole.format("three"), len(whole.format("three"))),
                   (4, "", 0), (5, "", 0), (6, whole.format("same"), len(whole.format("same")))}
    assert html_text.extract_text(spark.createDataFrame([], PAGES)).count() == 0


def test_equal_and_crawled_again_pages_are_passed_over(spark):
    def plain(text):
        return f"<body><div>Menu of site</div><p>{text}</p><div>Imprint</div></body>"

    crawled = [f"A long article that was crawled again and again, {'word ' * 60}.</p><p>Seen {i} times" for i in range(4)]
    rows = [(0, "http://a.org/a", plain("zero"), "h"), (9, "http://a.org/z", plain("nine"), "h")]
    rows += [(i, f"http://a.org/x?q={i}", plain("equal"), "h") for i in range(1, 6)]
    rows += [(20 + i, f"http://a.org/y?q={i}", plain(t), "h") for i, t in enumerate(crawled)]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r["page_id"]: r["text"] for r in html_text.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == {0: "zero", 9: "nine", **{i: "equal" for i in range(1, 6)},
                   **{20 + i: f"A long article that was crawled again and again, {'word ' * 60}".strip()
                      + f" .\n\nSeen {i} times" for i in range(4)}}


def paired(rows):
    """Texts by looking through all pages of a host, as the module states it."""
    name = lambda r: (host_path(r[1])[0].encode(), host_path(r[1])[1].encode(), hashlib.md5((r[2] or "").encode()).digest())
    pages = {name(r): html_text.lines_of(r[2]) for r in rows}
    order, out = sorted(pages), {}

    def tells(a, b):
        x, y = ([t for t, _ in pages[k]] for k in (a, b))
        return pages[a] != pages[b] and (a[1] != b[1] or not html_text.near_copies(x, y))

    for i, a in enumerate(order):
        near = []
        for beside in (order[:i][::-1], order[i + 1:]):
            beside = [b for b in beside if b[0] == a[0]]
            same = [b for b in beside if b[1] == a[1]][:html_text.NEAR]
            near += [b for b in same + [b for b in beside if b[1] != a[1]][:1] if tells(a, b)][:1]
        best = max(near, key=lambda b: html_text.shared_parts(a[1].decode(), b[1].decode()), default=None)
        out[a] = html_text.main_text(pages[a], pages[best] if best else None)
    return sorted((r[0], r[1], out[name(r)]) for r in rows)


def host_path(url):
    head, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    rest = rest.split("#")[0].split("?")[0]
    host, slash, path = rest.partition("/")
    return host.lower(), slash + path


def site(r, n=260):
    """Pages of few hosts and paths, with templates, crawls, copies and a hot page."""
    rows = []
    for i in range(n):
        host, path = f"h{r.randrange(4)}.org", f"/{r.choice('ab')}/{r.randrange(12)}"
        body = r.choice(["equal", f"text {i}", "crawled " * 30 + f"</p><p>{i % 5}"])
        menu = f"<div>Menu of {host}</div>" if r.random() < 0.8 else ""
        rows.append((i, f"http://{host}{path}?q={i}", f"<body>{menu}<p>{body}</p><div>Imprint</div></body>", "h"))
    hot = [(1000 + i, "http://h1.org/a/3", "<body><div>Menu of h1.org</div><p>hot</p></body>", "h") for i in range(130)]
    path = [(2000 + i, "http://h2.org/one/path", f"<body><div>Menu of h2.org</div><p>{'long ' * 40}</p><p>{i}</p></body>", "h") for i in range(60)]
    return rows + hot + path


@pytest.mark.parametrize("tasks", ["1", "8", "40"])
def test_pairs_are_the_same_however_pages_are_dealt(spark, tasks):
    rows = site(random.Random(5))
    want = paired(rows)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.createDataFrame(rows, PAGES).repartition(int(tasks))
        for part_bytes, hot in ((1 << 24, 1000), (1500, 20)):
            got = html_text.extract_text(df, part_bytes, hot).collect()
            assert sorted((x["page_id"], x["url"], x["text"]) for x in got) == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_no_part_holds_the_copies_of_a_hot_page(spark):
    rows = site(random.Random(6))
    parts = html_text.plan_parts(html_text.named_rows(spark.createDataFrame(rows, PAGES)), 1500, 20)
    assert len(parts.hot) == 1 and len(parts.starts) > 10 and parts.starts == sorted(parts.starts)
    assert max(len(v) for v in parts.also.values()) <= len(parts.starts)


def test_extra_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "http://a.org/1", "<p>x</p>", "h")], PAGES)
    for c in ("part", "path", "key", "own", "text", "tree", "idx", "size", "n_rows", "_p"):
        df = df.withColumn(c, F.lit("z"))
    assert [tuple(r) for r in html_text.extract_text(df).collect()] == [(1, "http://a.org/1", "x", 1)]


@pytest.mark.parametrize("text", ["<p ", "</div>", "<div>", "<script ", "</script", "<a href='", '<a b="', "<!-", "<nav><article>", "<div class=ad>",
                                  "<div><nav></div><main>", "<![", "& ", "<span class=menu>"])
@pytest.mark.parametrize("end", ["", ">", "'>", "</p>"])
def test_very_long_broken_pages_are_linear(text, end):
    started = time.process_time()
    html_text.lines_of(text * (250_000 // len(text)) + end)
    assert time.process_time() - started < 4  # about 0.3 s; a quadratic parser takes many minutes


def test_alignment_of_long_pages_needs_little_memory():
    r = random.Random(7)
    a, b = ([f"{side}{i}" if r.random() < 0.5 else f"s{i}" for i in range(6000)] for side in "ab")
    got = html_text.common_lines(a, b)
    assert got == {i for i in range(6000) if a[i] == b[i]}


# --- WARC ------------------------------------------------------------------------


def digest(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


def test_round_trip(spark, tmp_dir):
    long = "ü" * 400_000
    same = "s" * 100
    rows = [(3, "http://x/1", same, "h"), (1, "http://x/2", same, "h"), (None, "http://x/3", same, "h"),
            (1, "http://x/2", same, "h"), (4, None, None, "h"), (5, "http://x/\r\n4", "", "h"), (6, "u", "s" * 99, "h"),
            (7, "u", "s" * 99, "h"), (8, "u", long, "h"), (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n", "h")]
    df = spark.createDataFrame(rows, PAGES).withColumnRenamed("host", "digest")
    manifest = warc.write_archives(df, tmp_dir + "/w", archive_bytes=200)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in warc.read_archives(manifest).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), digest(t),
                    "revisit" if t == same and i != 1 else "response", 1 if t == same and i != 1 else None)
                   for i, _, t, _ in rows), key=str)
    assert got == want
    assert manifest.count() > 1


def test_empty_pages(spark, tmp_dir):
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], PAGES), tmp_dir + "/w")).count() == 0


def test_reader_rejects_damage():
    good = warc.page_record(1, "http://x/", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    two = good + warc.page_record(2, None, b"", hashlib.sha256(b"").hexdigest(), None)
    assert [r["page_id"] for r in warc.read_records(io.BytesIO(two))] == [1, 2]
    assert gzip.decompress(good).startswith(b"WARC/1.1\r\n")
    raw = gzip.decompress(good)
    for bad in (raw.replace(b"payload", b"PAYLOAD"), raw[:-2], raw.replace(b"Content-Length: 7", b"Content-Length: 8")):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(gzip.compress(bad))))
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(good[:-4])))


# --- urls --------------------------------------------------------------------------


def test_host_path_and_rules(spark):
    urls = ["http://WWW.Example.com/en/x?q#f", "http://example.com/de/", "http://notexample.com", "http://a.net/es/1",
            "http://net/fr/", "http://x.org?y=/en/", None, "no scheme", "http://a.com:80/x", "HTTP://Q.NET/ES/"]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.with_rule(url_filter.with_host_path(df)).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(len(urls))] == [
        ("www.example.com", "/en/x", "www.example.com/en/"), ("example.com", "/de/", "com/"), ("notexample.com", "", None),
        ("a.net", "/es/1", "net/es/"), ("net", "/fr/", "net/fr/"), ("x.org", "", None), ("", "", None), ("", "", None),
        ("a.com:80", "/x", None), ("q.net", "/ES/", None)]


def test_trees_learn_labelled_urls(spark):
    r = random.Random(2)
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        host = f"{'cheap' + str(r.randrange(10 ** 6)) if bad else r.choice(['news', 'blog', 'shop'])}.{'zz' if bad else 'org'}"
        rows.append((i, f"http://{host}/{'a/' * r.randint(0, 2)}{i}", ("block" if bad else "allow") if i < 400 else None, bad))
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string, bad boolean")
    out = url_filter.gbt_verdicts(url_filter.with_host_path(df), "verdict").where("page_id >= 400").collect()
    assert sum((x["model_verdict"] == "block") == x["bad"] for x in out) >= 0.95 * len(out)
    assert set(df.columns) < set(out[0].asDict())


def test_filter_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "http://a.org/"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.url_filter(df).collect()} == {"allow"}
    only = spark.createDataFrame([(1, "http://a.net/es/"), (2, "http://a.org/")], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.url_filter(only).collect()} == {"block"}
    assert url_filter.url_filter(df.where("false").withColumn("rule", F.lit(1))).count() == 0
