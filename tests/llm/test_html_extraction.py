from __future__ import annotations

import random
import re
from html import unescape

import numpy as np
import pytest

from regulus.llm.html_extraction import _covered, extract, parse
from regulus.llm.queries import QUERIES


def text_of(html):
    return parse(html).main


def test_marked_articles():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><a href="/">Home</a></nav><div class="ad">Buy</div><!-- <p>no</p> -->
    <article><header><h1>Head&shy;line &amp; more</h1><p>by me</p></header><p>One <b>two</b>&nbsp;three<br>four<p title="a > b">Five
      six<script>var x = "</p><p>no";</script><aside>side</aside><ul><li>item</li><li>next</li></ul><form>mail <input></form>
    <div class="newsletter-box">Sign up</div><div id="Comments"><p>first!</p></div></article>
    <div class="cookie-notice">We use cookies</div><footer>&copy; me</footer>"""
    assert text_of(page) == "Head\xadline & more\nOne two three four\nFive six\nitem\nnext"
    assert text_of("<form id=all><div class='post comments-open'><article>a</article></div></form>") == "a"
    assert text_of("<main><p>long text of the page</p><article class=related>x</article></main>") == "long text of the page"
    assert text_of("<aside><article>teaser</article></aside><div class='entry-content'>body of it</div>") == "body of it"
    assert text_of("<article>" + "x " * 30 + "</article><article>small</article>").startswith("x x")
    assert text_of("<div role=main>r</div>") == "r" and text_of("<ARTICLE>A &lt; B &#x41;&#66; &unknown; a < b</ARTICLE>") == "A < B AB &unknown; a < b"
    assert text_of("<p>none</p>") is None and parse(None).blocks == [] and parse("").main is None


def test_class_hints_on_the_article_itself():
    for tag in ("article class='post has-sidebar'", "article class='post comments-open'", "article class=with-ads", "article class='post sidebar'",
                "main class=with-ads", "main class=sidebar", "div role=main class=with-ads", "div itemprop=articleBody class='share widget'", "article class=related"):
        assert text_of(f"<{tag}><p>the text</p></{tag.split()[0]}>") == "the text"
        assert tag.endswith("related") or text_of(f"<main><p>a longer lead</p><{tag}><p>b</p></{tag.split()[0]}></main>") == "a longer lead\nb"
    assert text_of("<article>a</article><article class=ad>b</article>") == "a"
    assert text_of("<article hidden>a</article>") is None
    assert text_of("<form><article class='post has-sidebar'><p>the text</p></article></form>") == "the text"


def test_all_of_main_and_all_articles():
    long = " ".join(["word"] * 50)
    assert text_of(f"<main><h1>Title</h1><p>lead</p><article>{long}</article></main>") == f"Title\nlead\n{long}"
    assert text_of(f"<article>{long}</article><article>small</article>") == f"{long}\nsmall"
    assert text_of(f"<main>{long}</main><article>b <article>c</article></article><aside><article>d</article></aside>") == f"{long}\nb\nc"


def test_long_and_open_attribute_values():
    markup = "<p>x > y</p></article>" * 500
    assert text_of(f"<article><div data-props='{markup}' title=\"{markup}\">text</div> end</article>") == "text\nend"
    assert text_of("<article><p title=it's>one</p><p>isn't</p><p title=\"open>two</p></article>") == "one\nisn't\ntwo"
    for html in ("<a x='>' " * 200_000, "<a x=\"" * 200_001, "<a " * 300_000, "<a x=\"'" * 200_000):
        parse("<article>kept" + html)


def test_broken_pages_end():
    for html in ("<", "<a", "<!--", "<script>", "<p" + " \"" * 5000, "<article><p>x", "</p></p>", "<" * 5000, "&" * 3000, "<a href='" * 2000):
        parse(html)
    assert text_of("<article><p>x") == "x"


@pytest.mark.parametrize("seed", range(12))
def test_repeats_against_brute_force(seed):
    draw = random.Random(seed)
    passages = [[draw.choice("abc") for _ in range(draw.randint(1, 14))] for _ in range(3)]
    pages = [[t for _ in range(draw.randint(0, 4)) for t in draw.choice(passages) + [draw.choice("abcd") for _ in range(draw.randint(0, 4))]] for _ in range(draw.randint(0, 7))]
    run = draw.choice([1, 2, 4, 8])
    where = {}
    for i, p in enumerate(pages):
        for k in range(len(p) - run + 1):
            where.setdefault(tuple(p[k:k + run]), set()).add(i)
    for p, flags in zip(pages, _covered(pages, run)):
        want = np.zeros(len(p), dtype=bool)
        for k in range(len(p) - run + 1):
            if len(where[tuple(p[k:k + run])]) > 1:
                want[k:k + run] = True
        assert (flags == want).all()


@pytest.mark.parametrize("shard", [500_000, 60])
def test_unmarked_pages_of_a_host(spark, shard):
    draw = random.Random(5)
    words = lambda n: " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))
    top, bottom = words(20), words(25)
    rows, want = [], {}
    for i in range(30):
        body = [words(30), words(3)]
        if i == 20:
            body = want[19].split("\n")  # a copy of another page
        want[i] = "\n".join(body)
        rows.append((i, "http://one.example/x", f"<div id={i % 20}><div>{top}</div><p>{body[0]}</p><div>{body[1]}</div><p>{bottom}</p><a>a link</a></div>", 1))
    rows += [(100, "http://two.example/", f"<p>{top}</p>", 1), (101, None, None, 1), (102, None, "", 1), (None, "http://one.example/", "<article>own " + top + "</article>", 1)]
    want |= {100: top, 101: "", 102: "", None: "own " + top}
    want[19] = want[20] = f"{top}\n{want[19]}\n{bottom}"  # copies are kept whole
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int").repartition(3)
    got = extract(df, shard=shard).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id], r.page_id


@pytest.mark.parametrize("shard", [500_000, 60])
def test_marked_pages_go_through_the_arrays(spark, shard):
    draw = random.Random(6)
    words = lambda n: " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))
    share, links, quote, note, foot = words(20), words(18), words(25), words(6), words(22)
    rows, want = [], {}
    for i in range(12):
        own = [words(70), words(8), words(20)]
        want[i] = "\n".join([own[0], quote, own[1], own[2]])
        rows.append((i, "http://one.example/x", f"<article><h2>{own[0]}</h2><div>{share}</div><p>{quote}</p><ul><li><a>{links}</a></li></ul><p>{own[1]}</p>"
                     f"<section>{own[2]}</section><div>{note}</div></article><div>{foot}</div>"))
    rows += [(20, "http://two.example/", f"<article><p>{words(70)}</p><div>{share}</div></article>")]
    want[20] = rows[-1][2].replace("</p>", "\n").replace("<article><p>", "").replace("<div>", "").replace("</div></article>", "")  # no other page of its host has it
    same = f"<article><div>{words(40)}</div></article>"
    rows += [(30, "http://one.example/a", same), (31, "http://one.example/b", same)]
    want[30] = want[31] = same[14:-16]  # a copy is no boilerplate
    # what an article says is no boilerplate of a page that quotes it
    own = words(40)
    rows += [(40, "http://one.example/c", f"<p>{quote}</p><p>{own}</p><div>{foot}</div>")]
    want[40] = f"{quote}\n{own}"
    rows += [rows[3], (41, *rows[0][1:]), (99, *rows[4][1:])]
    want[41], want[99] = want[0], want[4]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), shard=shard).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id], r.page_id


def test_query(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op1_html_extraction"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        article = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("<(?:/?p|/?h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("n", range(1, 20))
def test_hosts_of_few_tokens(n):
    assert [f.tolist() for f in _covered([["a"] * n, []])] == [[False] * n, []]
    assert _covered([["a"] * n, ["a"] * n])[0].all() == (n >= 16)


def test_empty_table(spark):
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
