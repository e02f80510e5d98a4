import hashlib
import re

import pytest
from helpers import rows, table

from scorewatch.llm import main_text, warc
from scorewatch.llm.catalog import queries


def test_article_of_every_page(spark):
    """Against the article element of the test pages, its blocks cut by hand."""
    import html
    import re

    got = {r["page_id"]: r for r in rows(queries()["op10_main_text"](spark, "/root/testdata/sf0.01"))}
    pages = table("pages", "/root/testdata/sf0.01")
    assert len(got) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"<(?:/?p|/?h1|br)>", body)]
        assert got[p["page_id"]]["text"] == "\n".join(b for b in blocks if b)
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])


PAGE = """<html><head><title>t</title><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><div class="menu"><a href=x>Home</a> <a href=y>News</a></div>
<div id="cookie-notice">We use cookies and you should accept them all, said the long notice that nobody reads.</div>
<div class=content><h2>A title</h2><p>The first paragraph is long enough to be the main text &amp; it goes
on.</p><p>Short.</p><p>A second <a href=z>linked</a> paragraph that also has enough words to count as such.</p></div>
<form><p>Enter your name</p><input></form><div class="comments"><p>A comment that is long enough to look like text.</p></div>
<footer>&copy; all rights</footer></body></html>"""


def test_pages_without_article():
    assert main_text.main_text(PAGE) == (
        "A title\nThe first paragraph is long enough to be the main text & it goes on.\nShort.\n"
        "A second linked paragraph that also has enough words to count as such."
    )


@pytest.mark.parametrize("page", [None, "", "<p", "<a href='x", "<!-- x", "<script>x", "</p></p>", "<nav>a"])
def test_broken_pages(page):
    assert main_text.main_text(page) == ""


def test_more_markup():
    assert main_text.main_text("plain &lt;b&gt; text") == "plain <b> text"
    assert main_text.main_text("<article>a<b>b</b>&nbsp;c<aside>x</aside><p>d</article><p>e") == "ab c\nd"
    long = "<div>" * 50_000 + "x" + "<p>word " * 50_000
    assert main_text.main_text(long).count("\n") == 50_000


SCHEMA = "page_id long, url string, html string, payload_bytes string"


def test_transactions(spark):
    big, tricky = "é" * 600, "x" * 1000 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n"
    data = [
        (1, "http://a/1", big, "c"),
        (2, "http://a/2", big, "c"),
        (7, None, big, "c"),
        (7, None, big, "c"),
        (3, "http://a/\r\n3", tricky, None),
        (4, "u", "short", None),
        (5, "u", "short", None),
        (6, "u", None, None),
        (None, "u", big, None),
        (8, "u", "y" * 300_000, None),
    ]
    got = sorted((tuple(r) for r in warc.round_trip(spark.createDataFrame(data, SCHEMA)).collect()), key=str)
    sha = lambda s: hashlib.sha1((s or "").encode()).hexdigest()
    want = []
    for page, _, text, _ in data:
        again = text == big and page != 7
        want.append((page, len((text or "").encode()), sha(text), "revisit" if again else "response", 7 if again else None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nested_captures(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x" * 2000), (2, "http://b", "x" * 2000)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=10)
    found = warc.read_records(spark, str(tmp_path / "w"))
    assert found.count() == 6
    one, two = sorted(warc.assemble(found).collect(), key=lambda r: r["metadata"]["fields"]["page-id"])
    assert (one["kind"], two["kind"]) == ("revisit", "response")
    assert one["refers_to"] == two["record_id"] and one["refers_to_page"] == 2
    assert one["request"]["target_uri"] == "http://a" and two["response"]["payload_bytes"] == 2000
    assert bytes(two["response"]["payload"]) == b"x" * 2000 and one["response"]["payload"] is None
    assert two["response"]["first_line"] == "HTTP/1.1 200 OK" and two["response"]["http"]["content-length"] == "2000"
    assert one["request"]["first_line"] == "GET http://a HTTP/1.1" and one["response"]["http"]["content-type"].startswith("text/html")


def test_pages_are_read_back(spark, tmp_path):
    """Every page, revisits resolved, with the html that was written."""
    tricky = "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\x00 " * 60
    own = [(-1, "http://a/b c", tricky), (-2, None, tricky), (-3, "u", ""), (-4, "u", "x" * 3000), (-5, "u", "x" * 3000)]
    data = own + [(p["page_id"], p["url"], p["html"]) for p in table("pages", "/root/testdata/sf0.001")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    got = warc.resolved(warc.assemble(warc.read_records(spark, str(tmp_path / "w"))))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(data, key=str)


def test_a_query_without_payloads_reads_none(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x" * 2000)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    found = warc.stored(warc.read_records(spark, str(tmp_path / "w")), "records")
    plan = warc.assemble(found.drop("payload"))._jdf.queryExecution().executedPlan()
    assert "payload_digest#" in plan.toString() and not re.search(r"\bpayload#", plan.toString())


def test_article_tags_taken_out():
    """The distribution alone, on every test page without its article tags, and with the article cut by a list of links."""
    import re

    links = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(5))
    for p in table("pages", "/root/testdata/sf0.01"):
        want = main_text.main_text(p["html"])
        assert main_text.main_text(re.sub("</?article>", "", p["html"])) == want
        cut = p["html"].replace("<article>", '<div class="text">').replace("</article>", f"</div><ul>{links}</ul>")
        assert main_text.main_text(cut) == want
    assert want


def test_every_stretch_of_the_container():
    links = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(5))
    long, small = "<p>" + "long words of the main text " * 6 + "</p>", "<p>its smaller half</p>"
    page = f"<body><p>beside</p><ul>{links}</ul><div>{long}<p><a href=x>wholly a link</a></p>{long}<ul>{links}</ul>{small}</div></body>"
    text = main_text.main_text(page)
    assert text.split("\n")[1::2] == ["wholly a link", "its smaller half"] and "link 0" not in text and "beside" not in text


def test_article_is_a_weight():
    long = "words of the main text " * 40
    assert main_text.main_text(f"<div><p>{long}</p></div><article>Teaser</article>") == long.strip()
    assert main_text.main_text(f"<p>{'beside ' * 20}</p><article><h1>{'a b ' * 10}</h1><p>x</p></article>") == ("a b " * 10).strip() + "\nx"


@pytest.mark.parametrize(
    "inside, want",
    [
        ('<h2 id="related-work">Related work</h2><p>a</p>', "Related work\na"),
        ('<section id="search"><p>a</p></section>', "a"),
        ('<p id="social-impact">a</p>', "a"),
        ('<div class="entry-header"><h1>T</h1></div><p>a</p>', "T\na"),
        ('<p>one <span class="ad-hoc">two</span> three</p>', "one two three"),
        ('<p>one <span hidden>two</span> three</p>', "one three"),
        ('<p title="a hidden gem" data-id="search">a</p>', "a"),
        ('<p class="notice">x<p>a<p>b', "a\nb"),
        ('<p class="notice">x <b>y<p>a</p>', "a"),
        ('<ul><li class="ad">x<li>a<li>b</ul>', "a\nb"),
        ('<table><tr><td class="ad">x<td>a<tr><td>b</table>', "a\nb"),
        ('<div><div class="share">x<span>y</div></div><p>a</p>', "a"),
        ('<section><div class="share">x<p>y</section><p>a</p>', "a"),
        ('<div class="related-posts"><p>x</p></div><div id="comments"><div>x</div>x</div><p>a</p>', "a"),
        ('<p>a</p><div class="share">x', "a"),
    ],
)
def test_names_and_omitted_end_tags(inside, want):
    assert main_text.main_text(f"<body><article>{inside}</article><p>after</p></body>") == want


BESIDE = ["comments-section", "user-comments", "post-comments", "reader-comments", "comment-respond", "comment-thread",
          "comment-body", "related-articles", "related-stories", "ad-slot", "ad-unit", "main-nav", "post-navigation",
          "footer-widgets", "search-form", "site-header", "social-media-links", "sidebarRight", "newsletter-signup"]
KEPT = ["entry-header", "related-work", "ad-hoc", "social-impact", "search-results-of-a-study", "has-sidebar", "comments-open", "notice-of-motion"]


@pytest.mark.parametrize("around", ["<main>{}</main>", "<article>{}</article>", "<main><article>{}</article></main>"])
def test_named_blocks_inside_the_text(around):
    for name in BESIDE:
        page = around.format(f'<h1>T</h1><p>one</p><div class="{name}"><p>words of others, long enough to be text</p></div><p>two</p>')
        assert main_text.main_text(page) == "T\none\ntwo", name
    page = around.format('<p>one</p><div id="disqus_thread"><p>words</p></div><p>two</p>')
    assert main_text.main_text(page) == "one\ntwo"
    for name in KEPT:
        page = around.format(f'<p>one</p><div class="{name}"><p>of the text</p></div><p>two</p>')
        assert main_text.main_text(page) == "one\nof the text\ntwo", name


@pytest.mark.parametrize("drawing", ['<svg class="i"/>', "<svg><path d='x'/>x</svg>", "<math/>", "<svg>x<p>y</svg >", '<svg a="/>"/>'])
def test_drawings(drawing):
    page = f"<article><p>first paragraph</p>{drawing}<p>second one</p><p>third</p></article>"
    assert main_text.main_text(page) == "first paragraph\nsecond one\nthird"


def test_article_inside_main():
    long = "words of the article " * 10
    page = f"<main><h1>Title</h1><p>by someone</p><article><p>{long}</p></article><div><p>more to read here</p></div></main>"
    assert main_text.main_text(page) == f"Title\n{long.strip()}"
    page = f"<main><h1>Title</h1><p>{long}</p><div><article><p>a short reply</p></article></div></main>"
    assert main_text.main_text(page) == f"Title\n{long.strip()}\na short reply"


def test_generated_pages_with_named_blocks():
    """The articles of the test pages inside a main element, between blocks of every listed name."""
    for i, p in enumerate(table("pages", "/root/testdata/sf0.01")):
        want = main_text.main_text(p["html"])
        name = BESIDE[i % len(BESIDE)]
        other = f'<div class="x {name}"><p>Words of a block that is no part of the text, but long enough to look like it.</p></div>'
        page = p["html"].replace("<article>", f"<main>{other}<article>").replace("</article>", f"{other}</article>{other}</main>")
        assert main_text.main_text(page) == want, name
        assert main_text.main_text(re.sub("</?article>", "", page)) == want, name
