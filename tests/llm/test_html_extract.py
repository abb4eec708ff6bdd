import random
import re
import time
from html import unescape

from conftest import DATA

from barloom.llm import html_extract
from barloom.llm.html_extract import Rules, align, extract, fold, main_text, pairs, parse, wrapper


def plain(html):
    """The generator's pages, by hand: blocks of the one article element."""
    article = re.search(r"<article>(.*)</article>", html, re.DOTALL).group(1)
    blocks = re.split(r"</?(?:p|h1)>", article)
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", lambda m: " " if m.group() == "<br>" else "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    rows = extract(pages).collect()
    assert len(rows) == len(html)
    for r in rows:
        assert r.text == plain(html[r.page_id])


def page(nav, body, tail="Contact us at the desk"):
    return f"<html><body><div class='x1'><a href=/>{nav}</a><a href=/b>More</a></div><div>{body}</div><div>{tail}</div></body></html>"


def test_pages_without_an_article_element(spark):
    rows = [(i, "http://h.example/x", page(f"home {i}", f"<h2>Title {i}</h2>" + "".join(f"<p>Text {i} {j}.</p>" for j in range(i % 4 + 1)))) for i in range(12)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    for i in range(12):
        assert got[i] == "\n\n".join([f"Title {i}", *(f"Text {i} {j}." for j in range(i % 4 + 1))])


def test_furniture_inside_and_outside_the_article():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <nav><ul><li>Menu</ul></nav><main><article><header><h1>A &amp; B&nbsp;&#x43;</h1></header><p>One <b>two<i>three</i></b><br>four
    <p>Five <script>if (1 < 2) { document.write("</p>") }</script>six<div class="ad-box">Buy</div><ul><li>x<li>y</ul>
    <form>Mail <input></form><section id="comments"><p>Nice!</p></section></article><aside>Side</aside></main>
    <div class="cookie-notice">Cookies</div><footer>F</footer></body></html>"""
    assert main_text(html, Rules(wrapper(parse(html)))) == "A & B C\n\nOne twothree four\n\nFive six\n\nx\n\ny"


def item(key, n=1):
    return [key, "1", n, []]


def test_fold_and_align_give_repeats_and_options():
    one = fold([item("h1"), item("p"), item("p"), item("p")])
    assert [(i[0], i[1]) for i in one] == [("h1", "1"), ("p", "+")]
    groups = fold([item("h2"), item("p"), item("h2"), item("p"), item("h2"), item("p")])
    assert [(i[0], i[1]) for i in groups] == [("()", "+")] and [x[0] for x in groups[0][3]] == ["h2", "p"]
    both = align(one, fold([item("h1"), item("table"), item("p")]))
    assert [(i[0], i[1]) for i in both] == [("h1", "1"), ("table", "?"), ("p", "+")]
    a, b = (wrapper(parse(f"<div>Same</div><p>{t}</p>")) for t in ("x", "y"))
    merged = align(a, b)
    assert merged[0][3][0][3][0] is not None and merged[1][3][0][3][0] is None


def test_odd_rows(spark):
    rows = [(1, None, None, 0), (2, "", "", 0), (3, "u", "no tags &lt;here&gt;", 0), (4, "http://a.example", "<p>" * 3000 + "deep", 0), (5, "http://a.example", "<article>" + "<p>w " * 20_000, 0), (5, "x", "<p>1 < 2 <", 0), (None, "http://b.example", "<div>" * 400 + "a" + "</div>" * 400, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = [(r.page_id, r.text) for r in extract(pages).collect()]
    assert len(got) == 7 and (1, "") in got and (2, "") in got and (3, "no tags <here>") in got and (4, "deep") in got and (5, "1 < 2 <") in got and (None, "a") in got
    assert extract(pages.limit(0)).count() == 0


def test_hostile_pages_take_seconds_and_keep_their_text(spark):
    n = 100_000
    deep = "<div>a" * n + "<nav>menu<p>more</p></nav><p>z</p>" + "b</div>" * n
    rows = [
        ("deep", deep, "\n\n".join(["a"] * n + ["z"] + ["b"] * n)),
        ("deep menu", "<div>" * n + "<nav>x<p>y</p></nav><p>one</p>two<p>three" + "</div>" * n, "one\n\ntwo\n\nthree"),
        ("no end", "<a " * 350_000, ("<a " * 350_000).strip()),
        ("open quote", "<p title='x>one</p><p>two <b>three</b></p>", "one\n\ntwo three"),
        ("quotes", "<i>ok</i><a \"<a>\" " * 100_000 + "'", None),
        ("ends", "<p>x</p>" + "<div>" * n + "</q9>" * n, "x"),
        ("cdata", "<p>x " + "<![CDATA[ " * n + "> y", "x y"),
        ("script", "<p>x</p><script>" + "</script " * n, "x"),
        ("inline", "<p>" + "<b>x</b> " * n, " ".join(["x"] * n)),
    ]
    start = time.time()
    pages = spark.createDataFrame([(i, f"http://{i}.example/", html) for i, (_, html, _) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    assert time.time() - start < 120
    for i, (name, _, text) in enumerate(rows):
        assert text is None or got[i] == text, name


def test_long_unlike_lists_are_aligned_by_anchors(monkeypatch):
    rng = random.Random(3)
    keys = [f"k{i}" for i in range(40)]

    def same(a, b):
        return a[0] == b[0]

    monkeypatch.setattr(html_extract, "CELLS", 20)
    for _ in range(300):
        a, b = ([item(rng.choice(keys)) for _ in range(rng.randrange(30))] for _ in range(2))
        out = pairs(a, b, same)
        assert [i for i, _ in out if i is not None] == list(range(len(a))) and [j for _, j in out if j is not None] == list(range(len(b)))
        assert all(same(a[i], b[j]) for i, j in out if i is not None and j is not None)
        if {x[0] for x in a} & {x[0] for x in b}:
            assert any(i is not None and j is not None for i, j in out)


def test_a_text_repeated_on_one_page_is_no_furniture():
    one = "<div>" + "<p>same</p>" * 8 + "</div>"
    assert main_text(one, Rules(wrapper(parse(one)))) == "\n\n".join(["same"] * 8)
    merged = wrapper(parse(one))
    for _ in range(3):
        merged = align(merged, wrapper(parse(one)))
    assert main_text(one, Rules(merged)) == ""
