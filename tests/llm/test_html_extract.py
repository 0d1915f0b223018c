import html
from html.parser import HTMLParser

import pytest

from ledgerlens.llm import html_extract as op


def text(source, paths=None):
    return op.Page(source).text(paths)


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("plain  words\n here", "plain words here"),
    ("<p>a<p>b", "a\nb"), ("<p>a <b>b</b><i>c</i></p>d", "a bc\nd"), ("x<br>y", "x\ny"),
    ("<p>1 &lt; 2 &amp;&amp; caf&eacute;&nbsp;&#x41; &copy &unknown;</p>", "1 < 2 && café A © &unknown;"),
    ("<script>var t='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
    ("<script>never closed <p>no", ""), ("<p>cut tag <b", "cut tag"), ("a < b and c > d", "a < b and c > d"),
    ("<p title=it's>quote's</p><p title='a>b'>ok</p>", "quote's\nok"), ("<textarea><p>no</p></textarea><p>yes", "yes"),
    ("<head><title>no</title><body><p>yes", "yes"), ("<ul><li>a<li>b</ul>", "a\nb"), ("</div></p>x", "x"),
    ("<div><span class=ad>no</span>yes</div>", "yes"), ("<p hidden>no</p><p style='display: none'>no</p><p>yes", "yes"),
    ("<P CLASS='Share-Bar'>no</P><P>YES</P>", "YES"), ("<table><tr><td>a<td>b</table>", "a\nb"),
    ("<p>" + "deep " * 3 + "<div>" * 500 + "x", "deep deep deep\nx"),
])
def test_blocks(source, want):
    assert text(source) == want


BODY = "".join(f"<p>Sentence {k} of the article, long enough to matter.</p>" for k in range(6))
LINES = "\n".join(f"Sentence {k} of the article, long enough to matter." for k in range(6))


@pytest.mark.parametrize("source", [
    f"<body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><main><h1>Title</h1>{BODY}</main><footer>foot</footer>",
    f"<div class=top-menu><a>x</a></div><div id=cookie-notice>We use cookies</div><div class='post-12 post'><h1>Title</h1><div>{BODY}</div>"
    "<div class=comments><p>First!</p></div><form><p>Name</p></form></div><div class=sidebar><p>More to read here</p></div>",
    f"<article><header><h1>Title</h1></header>{BODY}<aside>no</aside><section id=comments><article><p>I disagree</p></article></section></article>",
    f"<div><div class=content><h1>Title</h1>{BODY}</div><div class=links><a href=1>{'Another page ' * 3}</a><a href=2>{'Third page ' * 3}</a></div></div>",
])
def test_article_shapes(source):
    assert text(source) == "Title\n" + LINES


APPENDIX = "<p>The appendix has a few more sentences.</p>"


@pytest.mark.parametrize("source, want", [
    (f"<article><div class=body>{BODY}</div><section class=appendix>{APPENDIX}</section></article>", f"{LINES}\nThe appendix has a few more sentences."),
    (f"<article><div class=body>{BODY}</div><div class=more>{APPENDIX}</div></article>", f"{LINES}\nThe appendix has a few more sentences."),
    (f"<body><div class=post><div class=body>{BODY}</div><section>{APPENDIX}</section></div><div class=extra>Other words.</div>", f"{LINES}\nThe appendix has a few more sentences."),
    (f"<div class='content-sidebar-wrap'><div>{BODY}</div></div>", LINES),
    (f"<body class='layout no-sidebar'><div class='layout no-sidebar'>{BODY}</div>", LINES),
    (f"<div class='post has-banner'>{BODY}</div>", LINES),
    (f"<form action=x><div>{BODY}</div><input name=q></form>", LINES),
    (f"<form><h1>Title</h1><div>{BODY}</div><div class=comments><p>First!</p></div></form><div class=note>Small print.</div>", f"Title\n{LINES}"),
    (f"<article>{BODY}<p class='market-share'>Its market share grew.</p><div class='related-work'><p>Others wrote of it.</p></div></article>",
     f"{LINES}\nIts market share grew.\nOthers wrote of it."),
    (f"<article>{BODY}</article><div id=comments>{'<p>I disagree with every word of it, and at length.</p>' * 40}</div>", LINES),
    (f"<div class=widget><article>{BODY}</article></div><div class='sidebar-left'><p>More to read.</p></div>", LINES),
    ("<div class=sidebar><p>Nothing else is here.</p></div>", "Nothing else is here."),
    ("<div class=comments><p>Only remarks.</p></div>", "Only remarks."),
    (f"<article>{BODY}<form><p>Your name</p></form><div class='share-bar'>Share it</div></article>", LINES),
])
def test_whole_articles(source, want):
    assert text(source) == want


def test_long_page():
    many = "".join(f"<p>Sentence {k} of the long article &amp; more.</p>" for k in range(50_000))
    got = text(f"<nav><a>x</a></nav><article>{many}</article><footer>foot</footer>")
    assert got.count("\n") == 49_999 and got.endswith("Sentence 49999 of the long article & more.")


def test_paths_are_general():
    page = op.Page("<div class='post-17 entry b2a9'><section class=x>t</section></div>")
    assert page.path[1:] == [">div.b.entry.post", ">div.b.entry.post>section.x"]


def test_hosts_agree(spark):
    good = f"<div class=story>{BODY}</div><div class=extra><p>Other words.</p></div>"
    odd = f"<div class=story><p>Short.</p></div><div class=extra><p>{'Other words of some length. ' * 40}</p></div>"
    none = "<section><p>No such container here.</p></section>"
    rows = [(k, "http://A.example/x", good) for k in range(5)] + [(10, "http://a.example/y", odd), (11, "http://a.example/z", none),
            (12, "http://b.example/", odd), (13, None, None), (14, None, ""), (None, "not a url", "<p>x"), (10, "http://a.example/y", odd)]
    pages = spark.createDataFrame([(h, u, i, "q") for i, u, h in rows], "html string, url string, page_id long, page_host string").repartition(3)
    got = {}
    for r in op.extracted(pages).collect():
        got.setdefault((r.page_id, r.url), []).append((r.text, r.n_chars))
    assert got[0, "http://A.example/x"] == [(LINES, len(LINES))]
    assert got[10, "http://a.example/y"] == [("Short.", 6)] * 2  # the host's path, not the page's
    assert got[11, "http://a.example/z"] == [("No such container here.", 23)]
    assert got[12, "http://b.example/"][0][0].startswith("Other words")
    assert got[13, None] == [("", 0)] and got[None, "not a url"] == [("x", 1)]
    kept = op.extract(pages)
    assert kept.columns == [*pages.columns, "main_text"] and kept.count() == len(rows)
    assert op.extracted(pages.limit(0)).count() == 0


class Article(HTMLParser):
    """A plain reading of the article element, by the standard parser."""

    def __init__(self):
        super().__init__()
        self.blocks, self.inside = [""], False

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag not in ("b", "i", "a"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag not in ("b", "i", "a"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_query_on_pages(spark):
    from ledgerlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    want = {}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        parser = Article()
        parser.feed(r.html or "")
        parser.close()
        want[r.page_id] = "\n".join(t for b in parser.blocks if (t := " ".join(b.split())))
    got = {r.page_id: r.text for r in QUERIES["op3_html_extract"](spark, sf).collect()}
    assert got == want


def test_unescape_is_the_standard_one():
    assert text("&amp;lt; &am &quot;") == " ".join(html.unescape("&amp;lt; &am &quot;").split())
