import math
import random
import time
from bisect import bisect_left

import pytest

from lastcol.llm import html_extract as hx


def text(page):
    return hx._main_text(page, frozenset())


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("plain  words", "plain words"), ("<p>a<p>b", "a\nb"), ("a < b", "a < b"),
    ("<script>var t='</p>';x()</script><p>x</p>", "x"), ("<script>never closed <p>x", ""),
    ("<nav><ul><li>m</li></ul></nav><article><h1>T</h1><p>a <b>b</b>&amp;c<br>d</p></article><footer>f</footer>",
     "T\na b&c d"),
    ("<article><p>x</p><div class='comments'><p>no</p></div></article>", "x"),
    ("<div class=\"cookie-notice\">no</div><div id=main-text><p>yes</p></div><div class=ad>no</div>", "yes"),
    ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"), ("<form><p>no</p></form><p>&#65;&eacute;&nbsp;z</p>", "Aé z"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\nb\nc"),
    ("<p title='>'>x</p>", "x"), ("</p></div>x", "x"), ("<article><header><h1>T</h1></header><p>x</p></article>", "T\nx"),
    ("<header><h1>Site</h1></header><main><p>x</p></main><aside>s</aside>", "x"),
])
def test_blocks(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page,want", [
    ('<article><div class="post-header"><h1>Title</h1></div><div class="legal-analysis"><p>Law body</p></div><p>Body</p></article>',
     "Title\nLaw body\nBody"),
    ('<article><section class="related-work"><p>w</p></section><p id="side-effects">s</p></article>', "w\ns"),
    ('<article><p>x</p><div class="comment-list">no</div><div class="share-buttons">no</div><div id="ad">no</div></article>', "x"),
    ('<main><div class="social share">no</div><p class="lead related-posts">no</p><p>x</p></main>', "x"),
    ('<div class="related-work">no</div><article>x</article>', "x"),
])
def test_names_within_an_article_must_say_it_whole(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page", ["<a " * 350_000, '<a "' * 250_000, "<b>" * 100_000 + "</b>" * 100_000, "<b>" * 90_000 + "</i>" * 90_000,
                                  "<svg>" * 60_000, "<svg>" + "</svg " * 90_000, "<b>" * 90_000 + "<h1>" * 90_000, "<div>" * 150_000,
                                  "<i><td>" + "<b>" * 80_000 + "</i>" * 80_000, "</a " * 250_000])
def test_broken_pages_take_time_in_proportion(page):
    began = time.process_time()
    hx.parse(page)
    assert time.process_time() - began < 12


def test_tag_ends_by_the_table_equal_the_pattern():
    rng = random.Random(9)
    for _ in range(3000):
        page = "".join(rng.choice("<a >\"'x/b") for _ in range(rng.randint(0, 25)))
        at, ends = hx._tag_ends(page)
        for i in range(len(page)):
            m = hx._ATTRS.match(page, i)
            assert (m.end() - 1 if m else -1) == ends[bisect_left(at, i)], (page, i)


def test_lists_of_a_host_by_join_or_at_once(spark, monkeypatch):
    rng = random.Random(3)
    pages = site(30, "a.example.com", rng) + site(20, "b.example.com", rng) + site(3, "c.example.com", rng)
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(pages)] + [(None, None, None)], "page_id long, url string, html string")
    want = sorted(map(str, hx.extract(df).collect()))
    monkeypatch.setattr(hx, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(hx, "GROUP_PAGES", 7)
    assert sorted(map(str, hx.extract(df).collect())) == want


def test_very_long_and_deep_pages():
    assert text("<div>" * 3000 + "x" + "</div>" * 3000) == "x"
    assert len(text("<p>" + "word " * 200_000)) == 999_999
    assert text("<" * 20_000).count("<") == 20_000


def site(n, host, rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    out = []
    for i in range(n):
        body = " ".join(word() for _ in range(30))
        out.append((f"http://{host}/p{i}", f"<html><body><div class=top>Our fine shop</div><div class=mid><p>{body}</p></div>"
                    f"<div class=end>All rights kept</div></body></html>", body))
    return out


def test_branches_that_a_host_repeats_go(spark):
    rng = random.Random(2)
    pages = site(40, "a.example.com", rng) + site(5, "b.example.com", rng)
    rows = [(i, u, h, "x") for i, (u, h, _) in enumerate(pages)] + [(900, None, None, "x"), (901, "", "<p>q</p>", "x"),
                                                                   (None, "http://a.example.com/", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = {r.page_id: r for r in hx.extract(df).collect()}
    assert len(out) == len(rows)
    for i, (_, _, body) in enumerate(pages):
        if i < 40:
            assert out[i].text == body and out[i].n_chars == len(body)
        else:  # too few pages to tell
            assert out[i].text == f"Our fine shop\n{body}\nAll rights kept"
    assert out[900].text == "" and out[901].text == "q"


def test_importance_equals_brute_force(spark):
    pages = [(i, "http://h/", f"<div><p>{i % k}</p></div>") for k in (3,) for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.path: r for r in hx.importance(df.withColumn("host", hx.host_of())).collect()}
    want = math.log(3) / math.log(30)
    assert abs(got["/div/p"].importance - want) < 1e-9 and got["/div/p"].n_pages == 30


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert hx.extract(df).count() == 0


def test_importance_decides_inside_and_beside_an_article(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    body = [" ".join(word() for _ in range(20)) for _ in range(60)]
    pages = [f"<body><main><article><h1>{b[:20]}</h1><p>{b}</p><p>Pass this on to your friends</p><div class=lead>"
             f"Our fine shop</div></article><div class=more><p>{b[::-1]}</p><p>All rights kept</p></div></main></body>"
             for b in body]
    copies = [pages[0]] * 200  # one page, however often it is delivered
    df = spark.createDataFrame([(i, "http://a.example.com/", h) for i, h in enumerate(pages + copies)],
                               "page_id long, url string, html string")
    out = {r.page_id: r.text for r in hx.extract(df).collect()}
    assert out == {i: f"{b[:20].strip()}\n{b}\n{b[::-1]}" for i, b in enumerate(body + [body[0]] * 200)}
    few = {r.page_id: r.text for r in hx.extract(df.filter("page_id < 5")).collect()}
    assert all(t.count("\n") == 5 and "Pass this on" in t for t in few.values())  # too few pages to tell
