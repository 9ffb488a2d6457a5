"""Main text of pages, hand-made and given."""

import html as entities
import re

import pytest

from monthmill.llm import html
from monthmill.llm.html import extract, main_text
from monthmill.llm.queries import op7_html_extraction

LONG = "A sentence of the article that goes on for a while, as such sentences do, with no link in it."
CASES = {
    None: "",
    "": "",
    "plain text only &amp; no tag": "plain text only & no tag",
    "<html><body></body></html>": "",
    f"<body><nav><a href=/>Home</a> <a href=/b>B</a></nav><article><h1>Head</h1><p>{LONG}<p>{LONG}</article><footer>foot</footer>": f"Head {LONG} {LONG}",
    f"<body><div class='main-menu'><ul><li><a>x</a><li><a>y</a></ul></div><div id=content><h2>T</h2><div><p>{LONG}</p><p>a  <b>b</b>c\n d</p></div></div><div class=\"sidebar\">{LONG}</div></body>": f"{LONG} a bc d",
    f"<article><header>H</header><p>{LONG}</p><form><input>Search here</form><aside>{LONG}</aside><div class=\"adBox\">Buy</div><section id='comments'><p>{LONG}</p></section></article>": LONG,
    f"<main><p>{LONG}</p><script>var a = '</p><p>no';</script><style>p{{}}</style><!-- {LONG} --><p>&lt;b&gt; &eacute;&#233;&#x41;&nbsp;x&unknown; &amp;amp;</p></main>": f"{LONG} <b> ééA x&unknown; &amp;",
    f"<body><p>{LONG}<br>next</p><unclosed attr=\"x><p>{LONG}": f"{LONG} next {LONG}",
    f"</p></div><ARTICLE><P>{LONG}</ARTICLE>": LONG,
}


@pytest.mark.parametrize("page", CASES)
def test_main_text(page):
    if page and "unclosed attr" in page:  # whatever it makes of the broken tag, the text before it stays
        assert main_text(page).startswith(f"{LONG} next")
    else:
        assert main_text(page) == CASES[page]


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + LONG + "</div>" * 5000) == LONG
    assert main_text("<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>") == " ".join([LONG] * 20_000)
    assert main_text("<" * 20_000) == "<" * 20_000


OTHER = "Words that are no part of the article."
NAMED = [
    f"<article><div class='entry-header'><p>{LONG}</p></div><p class='notice-board'>{LONG}</p><section id='share-prices'><p>{LONG}</p></section></article>",
    f"<body><div class='post share-enabled'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><p>short</p></div></body>",
    f"<body><div class='content with-sidebar'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><a href=/>other</a></div></body>",
]


@pytest.mark.parametrize("page", NAMED)
def test_names_do_not_remove_a_dense_block(page):
    assert main_text(page).count(LONG) == 3


@pytest.mark.parametrize("wrap", ["<div class=story>%s</div>", "<section>%s</section>", "<table><tr><td>%s</td></tr></table>", "%s", "<div class='ads'><h1>Head</h1>%s</div>", "<div id=sidebar><main>%s</main></div>"])
def test_articles_without_their_element(wrap):
    """Density finds the article wherever it stands; menus, notices, adverts and comments around it go."""
    body = wrap % f"<p>{LONG}</p><p>{LONG} <a href=/x>{LONG}</a></p>"
    page = f"""<body><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul><div class=cookie-banner><p>{OTHER}</p></div>{body}
        <div class=adBox>{OTHER}</div><div id=comments><p>{OTHER}</p><article class=comment><p>{OTHER} {OTHER}</p></article></div><div><a>links</a> <a>only</a></div></body>"""
    head = "Head " if "Head" in wrap else ""
    assert main_text(page) == f"{head}{LONG} {LONG} {LONG}"


def test_a_page_of_marked_elements_alone_keeps_its_text():
    assert main_text(f"<body><div class=banner><p>{LONG}</p></div></body>") == LONG


def test_densities_against_a_recursive_version():
    """Sums of child densities and the chosen subtree on random trees."""
    import math
    import random

    rng = random.Random(3)

    def made(depth):
        tag = rng.choice(["div", "section", "span", "a", "em"])
        return [tag, [made(depth - 1) if depth and rng.random() < 0.6 else "w" * rng.randrange(1, 40) for _ in range(rng.randrange(1, 5))]]

    def written(node):
        return node if isinstance(node, str) else f"<{node[0]}>{''.join(written(c) for c in node[1])}</{node[0]}>"

    def counts(node):
        """(characters, tags, characters in links, links)"""
        if isinstance(node, str):
            return len(node), 0, 0, 0
        inner = [counts(c) for c in node[1]]
        c, t, lc, lt = (sum(x[i] for x in inner) for i in range(4))
        t += sum(not isinstance(x, str) for x in node[1])
        return (c, t, c, lt + 1) if node[0] == "a" else (c, t, lc, lt)

    def density(node, whole):
        c, t, lc, lt = counts(node)
        linked = whole[2] / max(1, whole[0])
        base = math.log(c / max(1, c - lc) * lc + linked * c + math.e)
        return c / max(1, t) * math.log(max(c, 1) / max(1, lc) * max(1, t) / max(1, lt)) / math.log(max(base, 1 + 1e-9)) if c and base > 1 else c / max(1, t)

    for _ in range(200):
        tree = ["body", [made(4) for _ in range(rng.randrange(1, 5))]]
        root = html.parse(written(tree))
        order = html._measure(root)
        body = next(n for n in order if n.tag == "body")
        html._densities(order, body)
        whole = counts(tree)
        todo = [(tree, body)]
        while todo:
            mine, node = todo.pop()
            kids = [c for c in mine[1] if not isinstance(c, str)]
            assert node.sum == pytest.approx(sum(density(k, whole) for k in kids))
            todo += list(zip(kids, [c for c in node.children if isinstance(c, html.Node)]))


@pytest.mark.parametrize("part, many", [("</b></i>", 300_000), ('<p a="', 400_000), ("<p a=\"'>", 300_000), ("<b><p>", 200_000), ("<!", 500_000), ("<li><b>", 200_000), ("<a ", 400_000), ("</script", 300_000), ("<td><p><span>", 150_000)])
def test_long_broken_pages_take_linear_time(part, many):
    import time

    page = f"<article><p>{LONG}</p>" + "<i>" * 1000 + part * many
    start = time.process_time()
    found = main_text(page)
    assert time.process_time() - start < 60
    assert found.startswith(LONG)


def test_given_pages(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = op7_html_extraction(spark, folder).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        spaced = re.sub("<[^>]*>", "", re.sub("<(?!/?b>)[^>]*>", " ", article))
        assert r.text == " ".join(entities.unescape(spaced).split()) and r.n_chars == len(r.text)


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (None, None, f"<article><p>{LONG}</article>", "x"), (1, "u", None, "x")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in extract(pages).collect()) == [(0, "", LONG, len(LONG)), (1, "u", "", 0), (1, "u", "", 0)]
    assert extract(pages.limit(0)).collect() == []
