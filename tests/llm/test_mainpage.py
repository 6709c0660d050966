"""Main text of pages: the article with and without its element, boilerplate of every kind, broken markup."""

import random
from html import escape

from reelhouse.llm import mainpage as M

PARAGRAPH = "Over a long paragraph the sum of lengths in the window rises far above that of a menu or a short notice line. " * 2


def sentence(r, n):
    return " ".join("".join(r.choice("abcdefghij é&<") for _ in range(r.randint(2, 9))).strip() or "x" for _ in range(n)).strip()


def boilerplate(r):
    s = escape(sentence(r, r.randint(2, 30)))
    return r.choice([
        f"<nav><ul><li><a href='/x'>{s}</a></li></ul></nav>", f"<header><h2>{s}</h2><p>{s}</p></header>", f"<footer>{s}</footer>",
        f"<aside><p>{s}</p></aside>", f'<div class="sidebar left"><p>{s}</p></div>', f'<div id="cookie-notice">{s}</div>',
        f'<div class="ad">{s}</div>', f"<form><label>{s}</label><input name=q><textarea>{s}</textarea></form>",
        f"<script>var t='</p><p>{s}';</script>", "<style>p{margin:0}</style>", f"<!-- {s} -->",
        f'<section class="comments"><article class="comment"><p>{s}</p><p>{PARAGRAPH}</p></article></section>',
        f"<div style='display: none'>{s}</div>", f"<ul class=breadcrumbs><li>{s}<li>{s}</ul>", f"<noscript>{s}</noscript>"])


def article(r):
    blocks = [" ".join(sentence(r, r.choice([1, 1, 3, 30])).split()) for _ in range(r.randint(1, 12))]
    shapes = ["<p>{}</p>", "<p>{}", "<p><b>{}</b></p>", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<p><b>{}<br>", "<div>{}</div>",
              "<p>\n  {}\n\t</p>", "<ul><li>{}</ul>"]
    return blocks, "".join(r.choice(shapes).format(escape(b).replace(" ", r.choice([" ", "\n ", "<i> </i>", "&#32;"]))) for b in blocks)


def test_article_element_gives_the_article_exactly():
    r = random.Random(1)
    for _ in range(400):
        blocks, body = article(r)
        inner = body + boilerplate(r) * r.randint(0, 2)
        tail = r.choice(["</body></html>", "", "</div></body>", "</html"])
        page = f"<!DOCTYPE html><html><head><title>T</title></head><body class='with-sidebar'>{boilerplate(r)}{boilerplate(r)}" \
               f"<{(t := r.choice(['article', 'main']))}>{inner}</{t}>{boilerplate(r)}{tail}"
        assert M.main_text(page) == "\n".join(blocks), page


def test_without_article_the_distribution_decides():
    menu = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(8))
    body = "".join(f"<p>{PARAGRAPH}</p>" for _ in range(4)) + "<p>Short one.</p>" + f"<p>{PARAGRAPH}</p>"
    page = f"<body><div><ul>{menu}</ul></div><div class=x><h1>Title</h1>{body}</div><div><ul>{menu}</ul><p>(c)</p></div></body>"
    p = PARAGRAPH.strip()
    assert M.main_text(page) == "\n".join(["Title", p, p, p, p, "Short one.", p])


def test_surge_and_dive_points():
    flat = [0, 0, 10, 0, 0, 0, 90, 5, 200, 0, 0, 4, 0, 0, 0, 3]
    keep = M.kept_lines(flat, [False] * len(flat), False)
    assert [i for i, k in enumerate(keep) if k] == [6, 7, 8, 9, 10, 11]
    assert M.kept_lines([], [], False).tolist() == [] and M.kept_lines([5], [False], False).tolist() == [True]


def test_broken_and_odd_pages():
    assert M.main_text(None) == M.main_text("") == M.main_text("  \n ") == M.main_text("<html><body></body></html>") == ""
    assert M.main_text("plain words &amp; more") == "plain words & more"
    assert M.main_text("<article><p>a &lt;b&gt; &amp;amp; 1 < 2 &nbsp; x<br>y</p><p>t<sup>2</sup>") == "a <b> &amp; 1 < 2 x y\nt2"
    assert M.main_text('<div class="ad">buy<article><p>kept</p></article>') == "kept"
    assert M.main_text("<form><div>a</div><article><p>kept</p></article></form>") == "kept"
    assert M.main_text("<article><header><h1>Head</h1></header><p>One</p><footer>by</footer></article>") == "Head\nOne"
    assert M.main_text("<article><p>One</p><script>if (a < b) {'</p>'}</scr" + "ipt ><p title='a > b'>Two</p>") == "One\nTwo"
    assert M.main_text("<ARTICLE><P CLASS=\"x\">One<!-- no end <p>two</p>") == "One"


def test_very_long_page_and_table(llm):
    many = "".join(f"<p>w{i}</p>" for i in range(60_000))
    rows = [(1, "u", f"<article>{many}</article>"), (2, None, None), (3, "u", ""), (None, "u", "<p>é</p>"), (None, "u", "<p>é</p>")]
    pages = llm.createDataFrame([(*r, "x", 7) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {(r["page_id"], r["text"], r["n_chars"]) for r in M.extract(pages).collect()}
    long = "\n".join(f"w{i}" for i in range(60_000))
    assert got == {(1, long, len(long)), (2, "", 0), (3, "", 0), (None, "é", 1)}
    assert M.extract(pages).columns == ["page_id", "url", "text", "n_chars"] and M.extract(pages.limit(0)).count() == 0
