import re
from collections import Counter

from cellwise.llm import html as H
from tests.conftest import SF_SMALL, plan_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head>
<body class="no-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <article>commented</article> -->
<div class="main-12 content"><article class="post-77"><header><h1>Title &amp; more</h1><p>by me</p></header>
<p>First   para&shy;graph<br>goes&nbsp;on <b>bold</b> text<p>Second &lt;tag&gt; &#233; &#x1F600;
<ul><li>one<li>two</ul><div class="ad-box">Buy!</div><form>Your mail <input></form><blockquote>Quoted</blockquote>
<script>track()</script><aside>Related</aside><table><tr><td>a<td>b</table>
<section id="comments"><h2>Comments</h2><p>Nice one</p></section></article></div>
<div id="sidebar"><p>Links and many more words that are not part of the text at all, really</p></div>
<footer>&copy; 2024</footer></body></html>"""
WANT = "Title & more\nFirst para­graph goes on bold text\nSecond <tag> é 😀\none\ntwo\nQuoted\na\nb"


def test_boilerplate_is_left_out():
    assert H.extract(PAGE, None) == WANT
    assert H.extract(PAGE, [">html>body.no-sidebar>div.content.main->article.post-"]) == WANT


def test_odd_markup():
    assert H.extract(None, None) == "" and H.extract("", ()) == ""
    assert H.extract("just text", None) == "just text"
    assert H.extract("<p>cut off &am", None) == "cut off &am"
    assert H.extract("<article><p>a <b>b<p>c</article><footer>x", None) == "a b\nc"
    assert H.extract("<body><script>if (a<b) {", None) == ""
    assert H.extract("<p title='>'>quoted \"attr\"</p><p a=\"x>broken", None).startswith('quoted "attr"')
    assert H.extract("<form><div><p>All in a form, as some servers do it.</p></div></form>", None).startswith("All in")
    assert H.extract("<SCRIPT>x</SCRIPT><P>İ UP</P>", None) == "İ UP"
    assert H.extract("<p>" * 3000 + "deep", None) == "deep"


def test_class_words_do_not_hide_the_article():
    body = "<p>A story of many words that is told here.</p><p>It goes on for a while.</p>"
    want = "A story of many words that is told here.\nIt goes on for a while."
    aside = "<div class='sidebar'><p>Also read this</p></div>"
    talk = "<div id='comments'><article class='comment'><p>" + "Nice one, really. " * 20 + "</p></article></div>"
    for page in (f'<div class="content-sidebar-wrap"><article>{body}</article>{aside}</div>',
                 f'<article class="post category-social">{body}</article>{aside}{talk}',
                 f'<main><article class="post category-social">{body}</article>{aside}</main>{talk}',
                 f'<div class="layout right-sidebar"><div>{body}</div>{aside}</div>',
                 f'<div id="search-page"><div class="text">{body}</div></div><footer>f</footer>',
                 f'<div class="comment-page"><div>{body}</div></div>',
                 f'<article>{body}</article>{aside}{talk}'):
        assert H.extract(f"<html><body>{page}</body></html>", None) == want, page


def test_pages_match_their_documents(spark):
    """The pages show the documents: title and lines are the expected text."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = H.extract_pages(pages).collect()
    assert len(got) == pages.count()
    for r in got:
        doc = docs[int(re.search(r"/[a-z]+/(\d+)", r["url"]).group(1))]
        lines = [" ".join(x.split()) for x in doc.split("\n")]
        assert r["text"].split("\n")[1:] == [x for x in lines if x]
        assert r["n_chars"] == len(r["text"])


def test_host_votes_correct_a_page(spark):
    body = "<div class='story'><p>{}</p></div><div class='teasers'><p>{}</p></div>"
    long, short = "A long story with many words in it. " * 20, "Tiny."
    rows = [(i, f"http://news.example/{i}", f"<body>{body.format(long, 'See also other things.')}</body>") for i in range(9)]
    rows.append((9, "http://news.example/9", f"<body>{body.format(short, long)}</body>"))
    rows += [(10, None, None), (11, "http://x/", ""), (12, "nohost", "<p>t</p>"), (12, "nohost", "<p>t</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as HOST", "'x' as text")
    got = H.extract_pages(df).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[9] == "Tiny." and texts[0] == long.strip()
    assert texts[10] == texts[11] == "" and texts[12] == "t"
    assert Counter(r["page_id"] for r in got)[12] == 2
    assert H.extract_pages(df.limit(0)).count() == 0


def test_attribute_values_do_not_hide():
    body = "<p>A story of many words that is told here.</p><p class='lead search'>It goes on for a while.</p>"
    want = "A story of many words that is told here.\nIt goes on for a while."
    for page in (f'<article data-title="the hidden costs of energy">{body}</article>',
                 f'<div class="col hidden sm"><article title="display:none" alt=hidden>{body}</article></div>',
                 f'<article data-class="ad" aria-hidden="false">{body}<div hidden>no</div><div style="color:red;display: none">no</div>'
                 f'<span aria-hidden=true>no</span><p class="ad">Buy!</p></article>'):
        assert H.extract(f"<html><body>{page}</body></html>", None) == want, page


def test_pages_are_parsed_twice_at_most(spark):
    pages = spark.createDataFrame([(1, "http://a.example/1", PAGE), (2, "http://a.example/2", PAGE)], "page_id long, url string, html string")
    plan = plan_text(H.extract_pages(pages))
    assert plan.count("ArrowEvalPython") <= 2  # the texts; the votes are a table by now
