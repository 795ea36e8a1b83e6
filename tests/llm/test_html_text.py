import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row

from clickscope.llm import html_text as H
from clickscope.llm import queries as Q

A = "The first paragraph says a good deal about the river and the mills that stood along its banks."
B = "A second one follows, with <b>bold</b> words, a <a href='/x'>link</a> and an entity: Fish &amp; chips &copy; &#233;."
B_TEXT = "A second one follows, with bold words, a link and an entity: Fish & chips © é."
C = "Short."
D = "The last paragraph closes the account of the mills, long after they were pulled down for good."
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News of the day</a></li><li><a href='/c'>Contact</a></li></ul></nav>"
COOKIE = "<div class='cookie-notice'><p>We use cookies to give you the best experience on this site, and share data with partners.</p></div>"
FOOT = "<footer><p>Copyright 2024 by the publisher of this site, all rights reserved, no part may be reproduced.</p></footer>"
FORM = "<form><label>Your mail address for our weekly letter about rivers</label><input name='m'><button>Send it now</button></form>"
COMMENTS = ("<section id='comments'><h2>3 comments</h2><article class='comment'><p>I remember those mills very well, as my uncle worked in one "
            "of them for years.</p></article></section>")
ASIDE = "<aside><h3>Popular</h3><p>Ten things that you never knew about the water mills of the north, with pictures.</p></aside>"
AD = "<div id='ad-top' class='banner'>Buy one mill and get a second one for free, only this week in our shop!</div>"
BODY = f"<h1>On mills</h1><p>{A}</p><p>{B}</p><p>{C}</p><p>{D}</p>"
TEXT = "\n\n".join(["On mills", A, B_TEXT, C, D])
HEAD = "<!DOCTYPE html><html><head><title>On mills</title><style>p { margin: 0 }</style><script>var a = '</p><p>no text';</script></head><body>"

PAGES = {
    "article": f"{HEAD}{NAV}{COOKIE}{AD}<article>{BODY}</article>{ASIDE}{COMMENTS}{FOOT}</body></html>",
    "main": f"{HEAD}<header><h1>The Mill Times</h1><p>All the news about mills, every day of the week</p></header>{NAV}<main>{BODY}</main>{FORM}{FOOT}",
    "parts within the article": f"{HEAD}{NAV}<article><header><h1>On mills</h1><p class='byline'>by A. Miller, 3 May</p></header><p>{A}</p>{AD}<p>{B}</p>"
                                f"{FORM}{ASIDE}<p>{C}</p><p>{D}</p><div class='share'>Share this with all of your friends</div><footer>Filed under mills"
                                f"</footer>{COMMENTS}</article>{FOOT}",
    "plain containers": f"{HEAD}<div id='menu'><a href='/'>Home</a> <a href='/x'>News</a></div><div class='content'>{BODY}</div>"
                        f"<div class='sidebar'>{A}</div><div id='footer'>{D}</div>",
    "no container": f"{HEAD}<ul><li><a href='/'>Home page of it</a></li><li><a href='/n'>News of the day</a></li></ul>{BODY}",
    "a paragraph in each div": HEAD + NAV + "<div id=main>" + "".join(f"<div>{x}</div>" for x in ("On mills", A, B, C, D)) + f"</div>{FOOT}",
    "open elements": f"{HEAD}{NAV}<article><h1>On mills</h1><p>{A}<p>{B}<p>{C}<p>{D}</article>{FOOT}",
    "spaces and comments": f"{HEAD}{NAV}<article>\n<h1>\tOn\n mills </h1><!-- <p>no</p> --><p> {A.replace(' ', '&nbsp; ')}</p><p>{B}</p>\n\n<p>{C}<br></p><script>"
                           f"document.write('<p>no</p>')</script><p>{D}</p><noscript>Enable scripts</noscript></article>",
    "a form around all": f"{HEAD}{NAV}<form class='page'><div class='search'>Look for it here</div><article>{BODY}</article></form>{FOOT}",
    "names that say nothing": f"{HEAD.replace('<body>', '<body class=has-sidebar>')}{NAV}<div class='with-ads'><article class='no-comments'>{BODY}</article></div>{FOOT}",
    "cut off in a tag": f"{HEAD}{NAV}<article>{BODY}<p class='x",
    "cut off in a comment": f"{HEAD}{NAV}<article>{BODY}<!-- and <p>so on</p>",
    "upper case": f"{HEAD}<NAV><A HREF='/'>Home</A></NAV><ARTICLE>{BODY.replace('<p>', '<P>').replace('</p>', '</P>')}</ARTICLE>{FOOT}",
    "odd declarations": f"<![if IE]><?xml version='1.0'?><![foo[x]]>{HEAD}{NAV}<article>{BODY}<![endif]></article>",
    "related articles": f"{HEAD}<article>{BODY}</article><article><h2>More</h2><p>Read on here.</p></article>{FOOT}",
}


@pytest.mark.parametrize("kind", sorted(PAGES))
def test_main_text(kind):
    assert H.main_text(PAGES[kind]) == TEXT


def test_blocks_of_lists_tables_and_breaks():
    page = f"<article><p>{A}</p><ul><li>one<li>two <i>three</i></ul><table><tr><td>4</td><td>5</td></table><pre>a\n  b</pre>x<br>y<hr>z &lt;p&gt; 1 < 2</article>"
    assert H.main_text(page).split("\n\n") == [A, "one", "two three", "4", "5", "a b", "x y", "z <p> 1 < 2"]


def test_pages_without_text_and_junk():
    for page in (None, "", " \n", NAV, "<script>x", "<!-- x", "<", "</", "<a", "<html>", "<p></p>", f"{NAV}{FOOT}"):
        assert H.main_text(page) == ""
    assert H.main_text("no markup at all & more &am") == "no markup at all & more &am"
    assert H.main_text("a<b") == "a" and H.main_text("1 < 2 > 0") == "1 < 2 > 0"
    assert H.main_text("<p>" * 30000 + A) == A
    assert H.main_text("<div>" * 3000 + A + "</div>" * 3000) == A
    assert H.main_text("".join(f"<p>{A}" for _ in range(2000))) == "\n\n".join([A] * 2000)


def test_smoothing_and_threshold():
    assert H.smoothed(np.ones(5)).tolist() == pytest.approx([1] * 5)
    got = H.smoothed(np.array([0, 0, 0, 8.0, 0, 0, 0]))
    assert got.argmax() == 3 and got[2] == pytest.approx(got[4]) and got[0] < got[1] < got[2]
    assert 2 < H.threshold(np.array([1.0, 1.1, 0.9, 5, 5.2, 5.1])) < 4
    assert H.threshold(np.array([3.0])) == 3


def test_rows_columns_and_empty(spark):
    rows = [Row(page_id=i, html=h, text=1, _text="t") for i, h in [(1, PAGES["article"]), (1, PAGES["article"]), (None, None), (2, "x" * 300000)]]
    df = spark.createDataFrame(rows, "page_id long, html string, text int, _text string").repartition(3)
    got = H.extract(df)
    assert got.columns == ["page_id", "html", "text", "_text", "n_chars"]
    assert sorted(((r.page_id, r.text, r.n_chars, r._text) for r in got.collect()), key=str) == sorted(
        [(1, TEXT, len(TEXT), "t")] * 2 + [(None, "", 0, "t"), (2, "x" * 300000, 300000, "t")], key=str)
    assert H.extract(df.limit(0)).collect() == []
    assert H.extract(df)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_registered_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    assert sorted(map(tuple, Q.op13_html_extraction(spark, sf).collect())) == sorted(con.execute(Q.OP13_SQL).fetchall())
