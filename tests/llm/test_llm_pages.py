"""URL filter, WARC and page differencing."""

import base64
import gzip
import hashlib
import io
import random
import re
import time

import numpy as np
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from sievekit.llm.html_extract import common_lines, lines_of, main_text
from sievekit.llm.queries import URL_RULES
from sievekit.llm.urlfilter import judge_urls
from sievekit.llm.warc import Damaged, archive_folder, check_revisits, read_records, read_warc, record, round_trip, write_warc

PAGES = "page_id long, url string, html string"


def canonical(url):
    return f'<html><head><LINK href="{url}" rel=canonical></head>x</html>'


def refresh(url):
    return f'<meta http-equiv="Refresh" content="0; url={url}">'


URLS = [
    (1, "http://A.example.com/en/1", ""), (2, "http://www.example.com/en/1?x", ""), (3, "https://x.org/a", canonical("http://b.example.com/en/9")),
    (4, "http://x.org/b", canonical("/a")), (5, "http://y.net/fr/1", ""), (6, "http://y.net/de/1", refresh("../q")),
    (7, "http://z.org/1", refresh("http://y.net/fr/1")), (8, "http://ok.com/1", canonical("http://y.net/fr/1")), (9, None, None),
    (10, "no scheme", "<p>"), (11, "http://ncom/", ""), (12, "http://a.com", ""), (13, "HTTP://a.COM/?q#f", ""),
    (14, "http://notexample.com/en/1", ""), (15, "http://x.org/a#frag", ""), (15, "http://x.org/a#frag", ""), (16, "//a.b/c", "")]
VERDICTS = {
    1: ("a.example.com", "/en/1", "example.com/en/", "block", "rule"), 2: ("www.example.com", "/en/1", "www.example.com/en/", "allow", "rule"),
    3: ("x.org", "/a", None, "block", "alias"), 4: ("x.org", "/b", None, "block", "alias"), 5: ("y.net", "/fr/1", "net/fr/", "block", "rule"),
    6: ("y.net", "/de/1", None, "allow", "default"), 7: ("z.org", "/1", None, "block", "alias"), 8: ("ok.com", "/1", "com/", "allow", "rule"),
    9: ("", "", None, "allow", "default"), 10: ("", "", None, "allow", "default"), 11: ("ncom", "/", None, "allow", "default"),
    12: ("a.com", "", None, "allow", "default"), 13: ("a.com", "/", "com/", "allow", "rule"), 14: ("notexample.com", "/en/1", "com/", "allow", "rule"),
    15: ("x.org", "/a", None, "block", "alias"), 16: ("", "", None, "allow", "default")}


@pytest.mark.parametrize("joined", [False, True])
def test_url_verdicts(spark, joined, monkeypatch):
    if joined:
        monkeypatch.setattr("sievekit.llm.urlfilter.MAX_INLINE_RULES", 0)
    df = spark.createDataFrame(URLS, PAGES).withColumn("host", F.lit("x")).withColumn("rule", F.lit(1))
    got = judge_urls(df, URL_RULES).collect()
    assert len(got) == len(URLS)
    assert {r[0]: tuple(r)[1:] for r in got} == VERDICTS


def test_url_sql_on_rows_with_links(spark, tmp_dir):
    """The query and its SQL on canonical and refresh links, with escaped ampersands and chains."""
    import duckdb

    from sievekit.llm.queries import ORACLE_SQL, op2_url_redirect_filter

    rows = URLS + [(20, "http://amp.org/1", canonical("http://amp.org/q?a=1&amp;b=2")), (21, "http://amp.org/q?a=1&b=2", refresh("https://w.net/es/x")),
                   (22, "http://chain.org/1", canonical("http://chain.org/2")), (23, "http://chain.org/2", canonical("/3")),
                   (24, "http://chain.org/3", refresh("//v.net/fr/z?x&amp;y")), (25, "http://far.org/a/b", canonical("c")), (26, "http://far.org/a/c", "")]
    spark.createDataFrame(rows, PAGES).coalesce(1).write.parquet(f"{tmp_dir}/pages.parquet")
    got = op2_url_redirect_filter(spark, tmp_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_dir}/pages.parquet/*.parquet')")
    found = con.execute(ORACLE_SQL["op2_url_redirect_filter"])
    names = [d[0] for d in found.description]
    want = sorted((tuple(r) for r in found.fetchall()), key=str)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == want
    verdicts = {r["page_id"]: r["verdict"] for r in got.collect()}
    assert [verdicts[i] for i in (20, 21, 22, 23, 24, 25, 26)] == ["block"] * 5 + ["allow"] * 2


def test_url_edges_given_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://q.org/1", None), (2, "http://q.org/2", None)], PAGES)
    edges = spark.createDataFrame([("http://q.org/1", "https://r.net/es/")], "src string, dst string")
    assert {r["page_id"]: r["verdict"] for r in judge_urls(df, URL_RULES, edges=edges).collect()} == {1: "block", 2: "allow"}
    assert judge_urls(spark.createDataFrame([], PAGES), URL_RULES).collect() == []


# ------------------------------------------------------------ WARC

HTML = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, None), (4, "x", ""), (5, "u\r\nEvil: 1", "ünï\r\n\r\nWARC/1.1"),
        (6, "http://c/", "z" * 700_000), (7, "http://c/", "z" * 700_000), (1, "http://b/", "same"), (None, "http://d/", "same"), (None, "", "own")]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_round_trip(spark):
    df = spark.createDataFrame(HTML, PAGES).withColumn("record_type", F.lit(1)).repartition(3)
    first = {}
    for i, _, t in HTML:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    want = sorted(((i, len((t or "").encode()), sha(t), "response" if first.get(t or "") in (None, i) else "revisit",
                    None if first.get(t or "") in (None, i) else first[t or ""]) for i, _, t in HTML), key=str)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in round_trip(df).collect()), key=str)
    assert got == want
    assert round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_archives_are_plain_gzip_and_carry_payloads(spark):
    df = spark.createDataFrame(HTML, PAGES)
    folder = archive_folder(df)
    manifest = write_warc(df, folder, archive_bytes=500)
    assert manifest.count() > 1 and sum(r["records"] for r in manifest.collect()) == len(HTML)
    files, _ = pyarrow.fs.FileSystem.from_uri(folder)
    for r in manifest.collect():
        data = files.open_input_stream(r["archive"], compression=None).read()
        assert len(data) == r["bytes"]
        assert gzip.decompress(data).count(b"WARC-Type: ") == r["records"]
    back = read_warc(manifest, folder, with_payload=True).filter("record_type = 'response'").collect()
    assert sorted(bytes(r["payload"]).decode() for r in back) == sorted(["same", "same", "", "ünï\r\n\r\nWARC/1.1", "z" * 700_000, "own"])


def test_revisits_are_checked_against_their_responses(spark):
    rows = [(1, "d1", "response", None), (2, "d1", "revisit", 1), (3, "d2", "response", None), (4, "d2", "revisit", 3)]
    schema = "page_id long, payload_digest string, record_type string, refers_to long"
    check_revisits(spark.createDataFrame(rows, schema))
    for wrong in ((5, "d1", "revisit", 3), (5, "d1", "revisit", 9), (5, None, "revisit", 1)):
        with pytest.raises(Damaged):
            check_revisits(spark.createDataFrame([*rows, wrong], schema))


def test_damage_is_found():
    good = record(1, "u", b"payload", None) + record(2, "u", b"payload", 1)
    assert [r["record_type"] for r in read_records(io.BytesIO(good))] == ["response", "revisit"]
    assert list(read_records(io.BytesIO(b""))) == []
    text = gzip.decompress(record(1, "u", b"payload", None))
    for bad in (good[:-3], good[: len(good) // 2], b"no gzip", gzip.compress(text.replace(b"payload\r\n", b"pAyload\r\n")),
                gzip.compress(text.replace(b"Content-Length: ", b"Content-Size: ", 1)), gzip.compress(text + b"more"),
                gzip.compress(text[:-4] + b"xxxx")):
        with pytest.raises(Damaged):
            list(read_records(io.BytesIO(bad)))
    changed = text[: text.rindex(b"Content-Length: 94")] if b"Content-Length: 94" in text else text
    with pytest.raises(Damaged):
        list(read_records(io.BytesIO(gzip.compress(changed[:-20]))))


# ------------------------------------------------------------ page differencing

TEMPLATE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now</div>%s
<div class="cookie-notice">We use cookies</div><form><p>Sign up</p><input name=q></form><aside>Side</aside>
<section class="comments"><article><p>reader says</p></article></section><footer>&copy; me</footer></body></html>"""


def test_article_stays_and_the_rest_goes(spark):
    body = "<article><h1>Title &amp; more</h1><p><b>First  line.<br><p>Second\n line &lt;x&gt;.</p><!-- no --><div class=share>Share</div></article>"
    rows = [(1, "http://h/a/1", TEMPLATE % body), (2, "http://h/a/2", TEMPLATE % body), (3, "http://other/1", TEMPLATE % body),
            (4, "http://h/a/3", None), (5, None, ""), (6, "http://h/a/4", (TEMPLATE % body)[:-60]), (1, "http://h/a/1", TEMPLATE % body)]
    df = spark.createDataFrame(rows, PAGES).withColumn("lines", F.lit(1)).withColumn("text", F.lit("x"))
    want = "Title & more\nFirst line.\nSecond line <x>."
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in main_text(df).collect()]
    assert sorted(got) == sorted((i, "" if i in (4, 5) else want, 0 if i in (4, 5) else len(want)) for i, _, _ in rows)
    assert main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_shared_lines_go_without_article(spark):
    page = "<body><div>Welcome to the site</div><div><p>own %d one</p><p>own %d two</p></div><div>All rights reserved</div></body>"
    rows = [(i, f"http://h/x/{i}", page % (i, i)) for i in range(1, 8)] + [(9, "http://lone/", page % (9, 9))]
    for host_pages in (5000, 3):
        got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGES), host_pages=host_pages).collect()}
        if host_pages == 5000:
            assert all(got[i] == f"own {i} one\nown {i} two" for i in range(1, 8))
        assert got[9].startswith("Welcome") and all(f"own {i} two" in got[i] for i in got)


def test_copies_are_compared_with_other_pages(spark):
    page = "<body><div>Welcome to the site</div><div><p>own %d one</p><p>own %d two</p></div><div>All rights reserved</div></body>"
    rows = [(i, f"http://h/x/{i // 3 if i < 9 else i}", page % (n, n)) for i, n in enumerate([1, 1, 1, 1, 2, 2, 3, 3, 3, 4])]
    rows += [(0, rows[0][1], rows[0][2]), (20, "http://same/1", page % (9, 9)), (21, "http://same/2", page % (9, 9))]
    got = {(r["page_id"], r["text"]) for r in main_text(spark.createDataFrame(rows, PAGES)).collect()}
    want = {(i, f"own {n} one\nown {n} two") for i, n in enumerate([1, 1, 1, 1, 2, 2, 3, 3, 3, 4])}
    whole = "Welcome to the site\nown 9 one\nown 9 two\nAll rights reserved"
    assert got == want | {(20, whole), (21, whole)}


def test_neighbours_do_not_depend_on_the_size_of_a_host(spark):
    """Lines that only the pages of one folder share go, however finely a host is cut."""
    page = "<body><div>folder %d</div><p>own %d</p><div>series %d</div></body>"
    rows = [(i, f"http://h/f{i // 4:02}/{i % 4}", page % (i // 4, i, i // 4)) for i in range(80)]
    rows += [(100 + i, "http://h/f05/3x", page % (5, 99, 5)) for i in range(9)] + [rows[3], rows[3], (None, None, "<p>x"), (7, "http://k/", "<p>y")]
    df = spark.createDataFrame(rows, PAGES)
    results = [sorted(map(str, main_text(df, host_pages=n).collect())) for n in (5000, 30, 7, 1)]
    assert results[0] == results[1] == results[2] == results[3] and len(results[0]) == len(rows)
    got = {r["page_id"]: r["text"] for r in main_text(df, host_pages=7).collect()}
    assert all(got[i] == f"own {i}" for i in range(80) if i != 7)


def test_text_after_the_last_tag():
    assert lines_of("Prices: 3 < 5 today & 7 <8") == [("Prices: 3 < 5 today & 7 <8", False, False)]
    assert lines_of("<p>a</p>1 < 2 <b unfinished") == [("a", False, False), ("1 < 2", False, False)]


def test_common_lines_is_a_longest_one():
    rnd = random.Random(2)
    for _ in range(300):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(12))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        at = common_lines(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
        assert len(at) == best[-1, -1] and sorted(set(at)) == list(at)
        rest = iter(b)
        assert all(a[i] in rest for i in at)


def test_broken_html():
    assert lines_of("<div class=ad>x<article><p>body") == [("x", False, True), ("body", True, False)]
    assert lines_of("plain <b>text</b>") == [("plain text", False, False)]
    assert lines_of("<p>a<script>never ends") == [("a", False, False)]
    assert lines_of("<nav>a<nav>b</nav>c</nav><p>d") == [("a", False, True), ("b", False, True), ("c", False, True), ("d", False, False)]


# ------------------------------------------------------------ what differencing decides

def test_inline_elements_formulas_and_classes_of_content_stay():
    kept = ('<article><p class="related-work">Related work is discussed here.</p><p>We <span class="skip">skip</span> nothing, '
            '<b class="share">share</b> all</p><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold</p><noscript>No scripts needed</noscript> '
            '<object data="a">An object</object><section id="comment-on-method"><p>A comment on method</p></section>'
            '<div class="related-links">Go there</div><div class="social share-bar">Share</div></article>')
    assert [x for x, own, off in lines_of(kept) if own and not off] == [
        "Related work is discussed here.", "We skip nothing, share all", "Let x=2 hold", "No scripts needed An object", "A comment on method"]
    assert [x for x, _, off in lines_of(kept) if off] == ["Go there", "Share"]


def test_regions_with_the_same_paths_go_though_their_words_differ(spark):
    """No article, no names: menus, adverts and footers of other words on every page."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows, want = [], {}
    for i in range(60):
        menu = "".join(f"<li>{word()}</li>" for _ in range(5))
        body = [" ".join(word() for _ in range(rnd.randint(8, 60))) for _ in range(rnd.randint(3, 9))]
        html = (f"<body><div><ul>{menu}</ul></div><div>{word()} {word()} buy</div><div><h1>{body[0]}</h1>" + "".join(f"<p>{x}" for x in body[1:])
                + f"</div><div><p>{word()} {word()}</p></div></body>")
        rows.append((i, f"http://h/{i:03}", html))
        want[i] = "\n".join(body)
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(want[i] in got[i] for i in got)  # nothing of the body is lost
    assert sum(got[i] == want[i] for i in got) >= 0.9 * len(got)


def test_long_pages_of_one_repeated_line_are_aligned_quickly():
    for n in (400, 5000):
        a = np.array([k if k % 2 else 0 for k in range(1, 2 * n, 1)][:n], dtype=np.int64)
        b = np.array([-k if k % 2 else 0 for k in range(1, 2 * n, 1)][:n], dtype=np.int64)
        began = time.perf_counter()
        at = common_lines(a, b)
        assert len(at) == (a == 0).sum() and time.perf_counter() - began < 1


def test_large_tables_are_aligned_in_halves(monkeypatch):
    import sievekit.llm.html_extract as module

    rnd = random.Random(3)
    for _ in range(60):
        a, b = (np.array([rnd.randrange(7) for _ in range(rnd.randrange(40))], dtype=np.int64) for _ in range(2))
        monkeypatch.setattr(module, "BITS", 1 << 28)
        whole = common_lines(a, b)
        monkeypatch.setattr(module, "BITS", 20)
        parts = common_lines(a, b)
        assert len(whole) == len(parts) and sorted(set(parts.tolist())) == parts.tolist()
        rest = iter(b.tolist())
        assert all(a[i] in rest for i in parts)


def brute_text(pages):
    """The whole query by definition: neighbours by plain scan, alignments by plain tables."""
    from sievekit.llm.html_extract import LINE_WORDS, SMALLER, placed_lines, regions_of

    def common(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    parsed = []
    for i, url, html in pages:
        found = placed_lines(html)
        host, path = ("", "") if not url or "://" not in url else re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        parsed.append((host.lower(), path, i, [x[0] for x in found], found, regions_of(found)))
    out = {}
    for host, path, i, lines, found, (of, paths) in parsed:
        near = sorted((p for p in parsed if p[0] == host), key=lambda p: (p[1], p[2]))
        me = next(k for k, p in enumerate(near) if p[2] == i)
        before = next((p for p in reversed(near[:me]) if p[3] != lines), None)
        after = next((p for p in near[me + 1 :] if p[3] != lines), None)
        others = [p for p in (before, after) if p]
        out[i] = (lines, found, of, paths, others, common, LINE_WORDS, SMALLER)
    return out


def test_query_against_brute_force(spark):
    """Own lines stay, lines of a longest common subsequence go, on the pages as they are."""
    pages = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    pages += [(10_000 + k, f"http://brute/{k:02}", f"<body><div>Welcome</div><div><p>own {k} a<p>own {k} b<p>own {k % 3} c</div><div>Bye</div></body>") for k in range(12)]
    got = {r["page_id"]: r for r in main_text(spark.createDataFrame(pages, PAGES)).collect()}
    for i, (lines, found, _, _, others, common, *_) in brute_text(pages).items():
        inside = [x for x, own, off, *_ in found if own]
        text = got[i]["text"].split("\n") if got[i]["text"] else []
        if inside:
            assert text == inside  # the page says what its article is, and nothing else is left
        else:
            least = max((common([x[0] for x in found], p[3]) for p in others), default=0)
            assert got[i]["shared_lines"] >= least
            assert all(x in lines for x in text) and all(not any(x in p[3] for p in others) or lines.count(x) > 1 for x in text)
