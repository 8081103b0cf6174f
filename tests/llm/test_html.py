import html
import random
import re
import time

from larkspur.llm import html_text
from larkspur.llm.common import table
from tests.conftest import SF01

LONG = "This paragraph has enough words to be taken for the text of a page even where no element says so, since it goes on for a while."


def test_article_of_the_given_pages(spark):
    pages = table(spark, SF01, "pages")
    got = {r["page_id"]: r for r in html_text.extracted(pages).collect()}
    rows = pages.collect()
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"<p>|</p>|</?h1>", article))
        assert got[r["page_id"]]["text"] == "\n\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]
    assert len(got) == len(rows)


def test_what_is_never_text():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="home"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice"><p>{LONG}</p></div><div id="sidebar"><p>{LONG}</p></div>
    <main><h1>Title &amp; more</h1><p>One <a href="x">two</a> <b>three</b><br>four&nbsp;&lt;b&gt;</p><script>if (a < b) {{ "</p>" }}</script>
    <div class="ad">buy</div><aside>see also</aside><ul><li>x<li>y</ul><p hidden>no</p><p style="display: none">no</p><!-- <p>no</p> -->
    <blockquote><p>said</p></blockquote><table><tr><td>1<td>2</table><form><p>mail</p><input value="v"></form>
    <section class="comments"><h2>Comments</h2><p>{LONG}</p></section></main><footer><p>{LONG}</p></footer></body></html>"""
    assert html_text.main_text(page).split("\n\n") == ["Title & more", "One two threefour <b>".replace("threefour", "three four"), "x", "y", "said", "1", "2"]


def test_pages_without_an_article_element():
    page = f"<div class=menu><a href=a>A</a> <a href=b>B</a></div><div><h2>Head line here</h2><p>{LONG}</p><p>{LONG}</p></div><div><a href=c>other page</a></div><div>&copy; me</div>"
    got = html_text.main_text(page).split("\n\n")
    assert got.count(LONG) == 2 and "A B" not in got and "other page" not in got


def test_broken_and_empty_pages(spark):
    rows = [(1, None, None), (1, "u", ""), (2, "u", "<"), (3, "u", "<article>a<p>b</div></p></article"), (4, "u", "<article>" + "<div>" * 3000 + "deep"), (5, "u", "<script>never closed <p>x</p>"),
            (6, "u", "<article><p a='>' b=\">\">q < r & s &am; &#x41;</p>"), (7, "u", "<article><title>x"), (8, "u", "<article>" + "<p>w</p>" * 20_000), (None, "u", "<article>\x00 a\x85b</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = {(r["page_id"], r["url"]): r["text"] for r in html_text.extracted(pages).collect()}
    assert got[1, None] == got[1, "u"] == got[5, "u"] == got[7, "u"] == ""
    assert got[3, "u"] == "a\n\nb" or got[3, "u"].startswith("a\n\nb")
    assert got[4, "u"] == "deep" and got[6, "u"] == "q < r & s &am; A"
    assert got[8, "u"].count("w") == 20_000
    assert html_text.extracted(pages.where("false")).count() == 0


def test_tree_agrees_with_its_table():
    wrong = [r for r in html_text.TABLE if html_text.is_text(r[:-1]) != bool(r[-1])]
    assert len(wrong) <= 3
    assert not html_text.is_text((1, 1, 0, 80, 0.0, 50, 0.0, 60, 0.0, 0, 0)) and html_text.is_text((0, 1, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0, 0))


def test_a_name_alone_decides_nothing():
    words = " ".join(["word"] * 40)
    for page in (f'<article><p class="notice">{words}</p></article>', f'<main><section id="search-results-explained"><p>{words}</p></section></main>',
                 f"<article><p class=x'>{words}</p></article>", f'<div class="layout has-sidebar"><form id="all"><article><p>{words}</p></article></form></div>',
                 f'<div class="content"><p>{words}</p></div>', f"<p>{words}</p>"):
        assert html_text.main_text(page) == words, page
    assert html_text.main_text("<p>Short.</p>") == "Short."
    assert html_text.main_text("<article><p class=x'>it's one</p><p>it's two</p></article>") == "it's one\n\nit's two"
    for page in (f'<div class="cookie-notice"><p>{words}</p></div>', f'<article><section class="post-comments"><p>{words}</p></section></article>', f'<div class="comments"><article><p>{words}</p></article></div>',
                 f"<aside><article><p>{words}</p></article></aside>", f'<div id="ad-slot-3">{words}</div>', f"<form><p>{words}</p></form>"):
        assert html_text.main_text(page) == "", page


def test_hostile_pages_take_linear_time():
    """1 MB of each: time in proportion to the length, under 2 s."""
    size = 1 << 20
    patterns = ['<a "', "<div></p>", "<", "<!--", "<p a='", "<li><ul><center>", "&#", "</x", "<b a=b ", "<script>", "<td><center>", "<li><center></dd>", "</", "<a href=x>y", "<a/", "<p =", "<title></titlex"]
    pages = [p * (size // len(p)) for p in patterns]
    pages += ["<li><ul>" + "<center>" * 60_000 + "<li></li>" * 50_000, "<div>" * 100_000 + "</p>" * 100_000]
    for page in pages:
        begin = time.process_time()
        html_text.main_text(page)
        assert time.process_time() - begin < 2, page[:20]


def made_page(rnd):
    """Blocks in random order of kinds, without an article element, and which
    of them are text."""
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    parts, truth = [], []
    links = "".join(f"<li><a href=/{word()}>{word()}</a>" for _ in range(rnd.randrange(3, 9)))
    parts.append(rnd.choice([f"<nav><ul>{links}</ul></nav>", f"<div class='menu'><ul>{links}</ul></div>", f"<ul>{links}</ul>"]))
    if rnd.random() < 0.5:
        parts.append(rnd.choice([f"<div class=ad>{text(6)}</div>", f"<div id=cookie-banner><p>{text(30)}</p></div>", f"<aside>{text(40)}</aside>"]))
    truth.append(text(rnd.randrange(4, 9)))
    parts.append(f"<div id=text><h1>{truth[-1]}</h1>")
    for _ in range(rnd.randrange(2, 7)):
        body = text(rnd.randrange(25, 120))
        truth.append(body)
        parts.append(rnd.choice([f"<p>{body}</p>", f"<p>{body}", f"<p><b>{body}</b></p>", f"<div>{body}</div>"]))
        if rnd.random() < 0.2:
            parts.append(rnd.choice([f"<!-- {text(30)} -->", f"<script>var x = '<p>{text(30)}</p>'</script>", f"<style>{text(9)}</style>", f"<p hidden>{text(30)}</p>"]))
    parts.append("</div>")
    if rnd.random() < 0.5:
        parts.append(f"<section class=comments><p>{text(30)}</p><p>{text(50)}</p></section>")
    parts.append(rnd.choice([f"<footer>{text(5)} <a href=x>{text(2)}</a></footer>", f"<div class=footer><p>{text(12)}</p></div>"]))
    return "<html><head><title>x</title></head><body>" + "\n".join(parts) + "</body></html>", "\n\n".join(truth)


def test_made_pages_without_an_article_element():
    rnd = random.Random(7)
    pages = [made_page(rnd) for _ in range(300)]
    right = sum(html_text.main_text(page) == truth for page, truth in pages)
    assert right >= 0.97 * len(pages)
