import html
import itertools
import random
import re

import numpy as np
import pytest

from barloom.llm import pages

SF = "/root/testdata/sf0.001"

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body class="has-sidebar"><header><a href=/>Home</a></header>
<nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div class="cookie-notice">We use cookies &amp; more.</div><main><article><header><h1>A &lt;title&gt;</h1></header>
<p>First   <b>bold</b> paragraph,<br>line&nbsp;two.<p>Second paragraph.<div class="ad-slot">Buy now!</div><ul><li>item one<li>item two</ul><form><label>Name</label><input></form>
<section id="comments"><p>Reader says hi.</p></section></article></main><aside>Related things</aside><footer>&copy; 2024</footer>"""




def text_of(page):
    return pages.main_text(page, pages.PLAIN)[0]


def test_page_text():
    assert text_of(PAGE) == "A <title>\nFirst bold paragraph, line two.\nSecond paragraph.\nitem one\nitem two"
    assert text_of(None) == text_of("") == text_of("<p") == ""
    assert text_of("<article>" + "<p>x y." * 3000).count("\n") == 2999


def test_wrappers_and_open_elements_do_not_swallow_the_page():
    said = "A long enough sentence of the article, with a comma, stands here."
    body = f"<article><h1>Head</h1><p>{said}</p><p>{said}</p></article>"
    want = f"Head\n{said}\n{said}"
    nav = "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>"
    assert text_of(f"<body><form action=/x>{nav}{body}<footer>&copy; Site</footer></form>") == want
    assert text_of(f"<head><title>Left open<body>{nav}{body}").endswith(want)
    assert text_of(f"<div class='page-sidebar-right form'>{nav}<main>{body}</main></div>") == want
    assert text_of(f"{body}<form><p>Subscribe to our newsletter, it is free.</p><button>Go</button></form>") == want
    assert text_of(f"{body}<div hidden><p>{said}</p></div><p style='display: none'>{said}</p>") == want
    assert text_of(f"{body}<section class=comments><article class=comment><p>{said}</p></article></section>") == want


def test_the_cut_decides_where_names_say_nothing():
    said = ["The first paragraph says, at some length, what the page is about, who wrote it, and why a reader should go on to the end of it.", "Short", "The last one, too, is long enough to be told from a menu by its words, its commas, and the full stop that ends it, like the first."]
    page = "".join(f"<div class=q{k}>{x}</div>" for k, x in enumerate(["".join(f"<a href=/{w}>{w}</a> " for w in ("home", "news", "about")), "".join(f"<p>{x}</p>" for x in said), "&copy; 2024 Site"]))
    got, n, turned = pages.main_text(page, pages.PLAIN)
    assert got == "\n".join(said) and n == 5 and turned == 1
    found = pages.blocks(page)
    assert pages.costs(found, pages.PLAIN)[2] < 0  # the short one, by itself


def test_minimum_cut_against_all_labellings():
    rnd = random.Random(3)
    for _ in range(60):
        n = rnd.randint(1, 9)
        score = np.array([rnd.uniform(-3, 3) for _ in range(n)])
        edges = {(i, j): rnd.uniform(0, 2) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.5}
        cost = lambda lab: sum(max(-s, 0) if x else max(s, 0) for s, x in zip(score, lab)) + sum(c for (i, j), c in edges.items() if lab[i] != lab[j])
        assert abs(cost(pages.minimum_cut(score, edges)) - min(map(cost, itertools.product([False, True], repeat=n)))) < 1e-9


def test_query_against_hand_labelled_pages(spark, tmp_path):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<article>" + "<p>Word &amp; word, again.</p>" * 20_000 + "</article>")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = sorted(((r.page_id, r.url or "", r.text, r.n_chars) for r in pages.op10_html_extraction(spark, str(tmp_path)).collect()))
    one = "A <title>\nFirst bold paragraph, line two.\nSecond paragraph.\nitem one\nitem two"
    long = "\n".join(["Word & word, again."] * 20_000)
    assert out == [(1, "u", one, len(one)), (1, "u", one, len(one)), (2, "", "", 0), (3, "v", "", 0), (4, "w", long, len(long))]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_against_the_articles_of_whole_tables(spark, sf):
    want = {}
    d = f"/root/testdata/{sf}"
    for r in spark.read.parquet(f"{d}/pages.parquet").collect():
        inner = re.search("<article>(.*)</article>", r.html, re.DOTALL)[1]
        said = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:h1|p)>", inner)]
        want[r.page_id] = "\n".join(x for x in said if x)
    got = {r.page_id: r.text for r in pages.op10_html_extraction(spark, d).collect()}
    assert [k for k in want if got[k] != want[k]] == [] and len(got) == len(want)


@pytest.mark.parametrize("weights", [pages.PLAIN, np.array([1.3, -5, 2.8, -0.8, 0.8, -5.8, 14.4, 1.0, -9.0])])
def test_many_short_equal_paragraphs_of_an_article_stay(weights):
    short = ["In it."] * 150 + ["Rech."] * 40 + ["1", "In it.", "-"]
    nav = "<nav><ul>" + "".join(f"<li><a href=/{k}>In it.</a></li>" for k in range(30)) + "</ul></nav>"
    body = "".join(f"<p>{x}</p>" for x in short)
    for tag in ("article", "main"):
        page = f"{nav}<div class=ad>In it.</div><{tag}><h1>Head</h1>{body}<div class=ad>In it.</div><ul class=share><li>Rech.</li></ul></{tag}><footer><p>Rech.</p></footer>"
        assert pages.main_text(page, weights)[0].split("\n") == ["Head", *short]


def test_an_article_does_not_hold_links():
    said = "A long enough sentence of the article, with a comma, stands here."
    links = "".join(f"<li><a href=/{k}>More about it</a></li>" for k in range(12))
    page = f"<article><h1>Head</h1><p>{said}</p><p>{said} See <a href=/x>this</a>.</p><div class=x1><div class=x2><ul>{links}</ul></div></div></article>"
    assert text_of(page) == f"Head\n{said}\n{said} See this."


def test_extraction_replaces_columns_of_its_names(spark):
    df = spark.createDataFrame([(1, PAGE, "old", "x")], "page_id bigint, html string, text string, n_blocks string")
    out = pages.extract(df)
    assert out.columns == ["page_id", "text", "n_blocks", "n_turned"] and out.first().n_blocks == 14
    assert pages.extract(df.limit(0)).count() == 0


def test_samples_count_copies_once(spark):
    df = spark.createDataFrame([(PAGE.replace("Second", f"S{i}"),) for i in range(20)], "html string")
    more = df.unionByName(df.limit(1).crossJoin(spark.range(300).select()))
    assert np.allclose(pages.fit(more), pages.fit(df))
