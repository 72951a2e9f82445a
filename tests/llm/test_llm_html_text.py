import math
import re
import time

import pytest

from tabloom.llm.html_text import Page, main_text

PARAGRAPHS = ["The first paragraph of the article has some words, and some more of them.", "A second one & its \u00fcmlaut, <b> tags and all that.", "Short.", "Then a last long paragraph, so that the article is dense enough for anybody."]
BODY = "<p>" + "</p><p>".join(["The first paragraph of the article\n has   some <i>words</i>, and <a href='x'>some</a> more of them.",
                                "A second one &amp; its &uuml;mlaut, &lt;b&gt; tags and all that.", " Short.<br>", "Then a last long paragraph, so that the article is dense enough for anybody."]) + "</p>"
MENU = "<nav><ul>" + "<li><a href='/x'>entry of the menu</a></li>" * 8 + "</ul></nav>"
FOOT = "<footer>&copy; somebody &middot; <a href='/y'>imprint</a></footer>"
TEXT = "\n\n".join(PARAGRAPHS)


@pytest.mark.parametrize("page", [
    f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{MENU}<!-- ad --><article>{BODY}</article>{FOOT}</body></html>",
    f"<html><body>{MENU}<div class='ad'>Buy this now, it is cheap and good and new.</div><article>{BODY}</article>{FOOT}",
    f"<html><body><header>Site <a href='/'>home</a></header>{MENU}<main><article>{BODY}<form><input><button>Send</button></form></article></main><aside>More to read</aside>{FOOT}</body></html>",
    f"<body><div id=nav><a href=1>one</a> <a href=2>two</a></div><div class=content>{BODY}<div class='share'>Share this</div></div><div id='comments'><p>A comment that is as long as a paragraph of the article is, or longer.</p></div></body>",
    f"<body><article>{BODY}<section class='comments'><p>I do not agree with any of that, really not.</p></section></article><div class='cookie-notice'>We use cookies</div></body>",
    f"<BODY><ARTICLE>{BODY.replace('<p>', '<P>').replace('</p>', '')}</ARTICLE><FOOTER>x</FOOTER></BODY>",
])
def test_article(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain text\n only", "plain text only"), ("<p>a<p>b<ul><li>c<li>d</ul>", "a\n\nb\n\nc\n\nd"), ("<article><h1>T</h1><p><b>x<br><p>y</article>", "T\n\nx\n\ny"),
    ("<script>x", ""), ("<p>cut <a href='", "cut"), ("<p>&am &amp &nbsp;&#65;&#x42;", "&am & AB"), ("<nav>only a menu</nav>", ""), ("<!-- open comment <p>x</p>", ""), ("a < b and c > d", "a < b and c > d"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"), ("<div><p>x</div>y", "x\n\ny"),
])
def test_odd_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "x", "<b>" * 50_000, "<p>x" * 50_000, "<a href=\"" * 3000, "<" * 100_000, "<p x='" * 20_000, "&" * 100_000, "</p>" * 50_000, "<ul><li>" * 3000 + "x"])
def test_hostile_pages_end(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 20


LONG = " ".join(f"word{i}" for i in range(120))
SHORT = " ".join(f"part{i}" for i in range(36))
MENU = "<div class=menu><ul>" + "<li><a href=x>go there</a></li>" * 8 + "</ul></div>"


@pytest.mark.parametrize("mark", ["page has-sidebar", "content no-sidebar", "layout sidebar-right", "post share-enabled", "page-with-menu", "related-content"])
@pytest.mark.parametrize("inner", ["<article><h1>Head</h1><p>{}</p><p>{}</p></article>", "<h1>Head</h1><p>{}</p><p>{}</p>", "<div><h2>Head</h2><div>{}</div><div>{}</div></div>"])
def test_marked_frame_stays(mark, inner):
    page = f"<html><body>{MENU}<div class='{mark}'>{inner.format(LONG, SHORT)}<div class=sidebar>side words <a href=x>here</a></div></div><div class=comments><p>a reader says so</p></div></body></html>"
    assert main_text(page) == f"Head\n\n{LONG}\n\n{SHORT}"


@pytest.mark.parametrize("body", ["<section>{0}</section><section>{1}</section>", "<div id=content><div>{1}</div><div>{0}</div><div>{1}</div></div>", "<h1>{1}</h1><div><p>{0}</p><p>{0}</p></div><p>{1}</p>",
                                  "<div><div><p>{0}</p></div><div><p>{1}</p></div></div>", "<table><tr><td><p>{0}</p><p>{1}</p></td></tr></table>"])
def test_parts_beside_the_densest_node_stay(body):
    want = [LONG if m == "0" else SHORT for m in re.findall(r"\{(.)\}", body)]
    assert main_text(f"<body><nav>menu</nav>{MENU}{body.format(LONG, SHORT)}<div class=footer>imprint</div></body>") == "\n\n".join(want)


@pytest.mark.parametrize("mark", ["comments", "comment-list"])
def test_comments_go_though_they_are_long(mark):
    page = f"<body><div><h1>Head</h1><p>{SHORT}</p></div><section class={mark}><article class=comment><p>{LONG}</p></article><article><p>{LONG}</p></article></section></body>"
    assert main_text(page) == f"Head\n\n{SHORT}"


@pytest.mark.parametrize("page", ["<i>" * 200_000 + "</x>" * 200_000, "<p><table>" + "<i>" * 100_000 + "</p>" * 100_000 + "end", "<div>" * 100_000 + "x" + "</div>" * 100_000])
def test_time_is_linear(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 8


def test_density_against_a_plain_count():
    """The chosen node has the largest sum of child densities, counted anew from the nodes' own texts."""
    page = Page(f"<body><div id=a><p>{SHORT} <a href=x>one two</a></p></div><div id=b><p>{LONG}</p><p>{SHORT}</p></div><div id=c><a href=y>{SHORT}</a></div></body>")
    own, kids = dict(enumerate(page.chars)), {n: [m for m, p in enumerate(page.parents) if p == n] for n in range(len(page.tags))}
    links, one, one_link = page.link_chars.copy(), page.count.copy(), page.link_count.copy()
    whole = lambda n, of: of[n] + sum(whole(m, of) for m in kids[n])
    share = whole(0, links) / whole(0, own)

    def density(n):
        c, lc, t, lt = whole(n, own), whole(n, links), max(1, whole(n, one)), max(1, whole(n, one_link))
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e) if c else 1
        return c / t * math.log(max(1.0, c / max(1, lc) * t / lt)) / math.log(base) if c else 0.0

    sums = {n: sum(map(density, kids[n])) if any(map(density, kids[n])) else density(n) for n in kids}
    root, _threshold, got = page._densest()
    assert sums[root] == max(sums.values()) and all(abs(got[n] - density(n)) < 1e-9 for n in kids)
