import html
import re

import pytest

from ledgerflow.llm.mainext import extract, main_text, measure, parse
from ledgerflow.llm.queries import QUERIES

LONG = "A long enough sentence of the article that says something, in many plain words. " * 4


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("just text &amp; more", "just text & more"),
    ("<article><h1>T</h1><p>a<br>b <b>c</b>\n d<p>e</article><footer>f</footer>", "T\na\nb c d\ne"),
    ("<body><nav><a href=x>menu</a></nav><main><p>x &lt; y&#33; &eacute;</main><aside>s</aside>", "x < y! é"),
    ("<article><p>one</p><script>if (a<b) {'</p>'}</script><style>p{}</style><!-- <p>no</p> --><p>two</p></article>", "one\ntwo"),
    ("<article><form><p>mail</p><input></form><p>text</p><div class='ad'>buy</div><section id=comments><p>first!</p></section></article>", "text"),
    ("<div role=navigation>n</div><article><header><h1>H</h1></header><p>t</p><footer>by</footer></article><header>top</header>", "H\nt"),
    ("<div class='site-header'>Site</div><div id=cookie-notice>ok?</div><article><div class=article-header><h1>H</h1></div><p>t</p></article>"
     "<div class='comment-list'><p>first</p></div>", "H\nt"),
    ("<div class='page-header'>Site name</div><div><h1 class='post-header'>H</h1><p>" + "long text here " * 30 + "</p></div>",
     "H\n" + ("long text here " * 30).strip()),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<article><p>a <p title='x>y'>b</p><p class=\"unclosed>c</article>", "a\nb\nc"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<article><p>cut &am", "cut &am"),
])
def test_pages(page, want):
    assert main_text(page) == want


def test_density_finds_the_text_without_an_article_element():
    links = "".join(f"<li><a href='/{i}'>link {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div><h2>Head line</h2><p>{LONG}</p><p>{LONG}</p></div></div><div><a href=a>b</a></div></body>"
    got = main_text(page)
    assert LONG.strip() in got and "link 7" not in got and got.startswith("Head line")


def test_densest_node_and_threshold():
    root = parse(f"<div id=x><p>{LONG}<p>{LONG}</div><div><a>{'l ' * 50}</a></div>")
    best = measure(root)
    assert best.tag == "div" and best.density > root.children[0].children[1].density


def test_dense_subtrees_beside_the_densest_article_belong_to_the_result():
    p = lambda c: f"<p>{c * 300}</p>"
    both = [c * 300 for c in "abcde"]
    two = f"<article>{p('a') * 3}</article><article>{p('d') * 2}</article>"
    assert main_text(f"<body>{two}</body>") == "\n".join(["a" * 300] * 3 + ["d" * 300] * 2)
    assert main_text(f"<body><article>{p('a')}{p('b')}{p('c')}</article><div><div>{p('d')}{p('e')}</div></div></body>") == "\n".join(both)
    assert main_text(f"<body><div><div>{p('a')}{p('b')}{p('c')}</div></div><section>{p('d')}{p('e')}</section></body>") == "\n".join(both)
    # a dense part of a thin one
    links = "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(30))
    assert main_text(f"<article>{p('a')}{p('b')}{p('c')}</article><div><ul>{links}</ul><section>{p('d')}{p('e')}</section></div>") == "\n".join(both)
    assert main_text(f"<main>{p('a')}{p('b')}{p('c')}</main><div><ul>{links}</ul></div>") == "\n".join(both[:3])


def test_comment_articles_are_furniture():
    p = lambda c: f"<p>{c * 300}</p>"
    for comment in ("<article class='comment'>", "<article id=comment-12 class='byuser'>", "<article class=comment-body>"):
        assert main_text(f"<article class='post has-sidebar comments-open'>{p('a')}{p('b')}{comment}{p('c')}</article></article>") == "a" * 300 + "\n" + "b" * 300
        assert main_text(f"<main><article class=post>{p('a')}{p('b')}</article>{comment}{p('c') * 4}</article></main>") == "a" * 300 + "\n" + "b" * 300
    assert main_text(f"<article>{p('a')}<article class='related'>{p('b') * 3}</article></article>") == "a" * 300
    assert main_text(f"<article>{p('a')}<article class='part'>{p('b')}</article></article>") == "a" * 300 + "\n" + "b" * 300


BODY = f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>"
WHOLE = "\n".join(["Head", LONG.strip(), LONG.strip()])


@pytest.mark.parametrize("page", [
    f"<body><div class='content with-sidebar'>{BODY}</div></body>",
    f"<body><div id=page class='has-sidebar'>{BODY}</div></body>",
    f"<body><div class='wrapper header-fixed'>{BODY}</div></body>",
    f"<body><div class='nav-open'><main>{BODY}</main></div></body>",
    f"<body><form action=/x><input name=state>{BODY}</form></body>",
    # hints that are wrong: the whole page, or an article, lies inside
    f"<body><div class='sidebar-layout'><div class=widget>{BODY}</div></div></body>",
    f"<body><div class='menu page'><article>{BODY}</article></div><div class=menu>some words of a menu</div></body>",
    f"<body><header class=banner><main>{BODY}</main></header></body>",
    f"<body><div class='search-page'><form><div>{BODY}</div><input></form></div><div class='ad'>Buy this now</div></body>",
])
def test_names_do_not_override_the_selection(page):
    assert main_text(page) == WHOLE


@pytest.mark.parametrize("page", [
    f"<body><div class='ad'>{LONG}</div><article>{BODY}</article></body>",
    f"<body><div class='sidebar-left'><p>{LONG}</p></div><div>{BODY}</div></body>",
    f"<body><div>{BODY}</div><form><p>Write to us, we read all of it.</p><input></form></body>",
    # more comments than text
    f"<body><div>{BODY}</div><div id=comments>{'<p>' + LONG + '</p>'}{('<p>' + LONG) * 4}</div></body>",
    f"<body><main>{BODY}</main><div class='cookie-banner'>{LONG * 6}</div></body>",
])
def test_furniture_by_name_goes(page):
    assert main_text(page) == WHOLE


def _densities(node):
    """Composite densities worked out anew, from the tree alone."""
    import math

    def count(n, inside):
        chars = tags = 0
        for c in n.children:
            if isinstance(c, str):
                chars += len(re.sub(r"\s", "", c)) if inside is None or inside else 0
            elif not c.furniture:
                link = None if inside is None else inside or c.tag == "a"
                a, b = count(c, link)
                chars, tags = chars + a, tags + b + (1 if inside is None or inside or c.tag == "a" else 0)
        return chars, tags

    body_c, _ = count(node, None)
    body_lc, _ = count(node, False)

    def density(n):
        (c, t), (lc, lt) = count(n, None), count(n, n.tag == "a")
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + body_lc / max(body_c, 1) * c + math.e)
        value = math.log(max(c / max(lc, 1) * (max(t, 1) / max(lt, 1)), 1.0))
        return c / max(t, 1) * (value / math.log(base) if base > 1 else value)
    return density


@pytest.mark.parametrize("seed", range(12))
def test_densities_against_the_formula(seed):
    import random
    rng = random.Random(seed)

    def part(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([LONG[:rng.randint(5, 200)], "<a href=x>some link</a>", "<br>", f"<p>{LONG[:rng.randint(5, 300)]}</p>"])
        return "<div>" + "".join(part(depth - 1) for _ in range(rng.randint(1, 5))) + "</div>"

    root = parse("<body>" + "".join(part(4) for _ in range(4)) + "</body>")
    best, density = measure(root), _densities(root)
    nodes, stack = [], [root]
    while stack:
        n = stack.pop()
        nodes.append(n)
        stack += [c for c in n.children if not isinstance(c, str)]
    assert all(abs(n.density - density(n)) <= 1e-9 * max(1, n.density) for n in nodes)
    total = lambda n: sum(density(c) if not isinstance(c, str) else len(re.sub(r"\s", "", c)) for c in n.children)
    assert abs(total(best) - max(map(total, nodes))) < 1e-6


def test_deep_and_large_pages():
    assert main_text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert main_text("<article>" + "<p>word</p>" * 20000 + "</article>").count("\n") == 19999
    assert main_text("<" * 10000) == "<" * 10000


def test_template_pages_and_awkward_rows(spark):
    def want(page):
        body = page[page.index("<article>") + 9:page.index("</article>")]
        parts = re.split("</?(?:p|h1|br)>", body)
        return "\n".join(x for x in (re.sub(r"\s+", " ", html.unescape(re.sub("</?b>", "", p))).strip() for p in parts) if x)

    got = {r["page_id"]: r for r in QUERIES["op8_main_text"](spark, "/root/testdata/sf0.01").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert got[r["page_id"]]["text"] == want(r["html"]) and got[r["page_id"]]["n_chars"] == len(want(r["html"]))
    rows = spark.createDataFrame([(1, None, None, "t"), (None, "u", "<p>x", "t"), (1, None, None, "t"), (2, "", "", "t")],
                                 "page_id long, url string, html string, text string")
    assert sorted(map(tuple, extract(rows).collect()), key=str) == sorted(
        [(1, None, "", 0), (None, "u", "x", 1), (1, None, "", 0), (2, "", "", 0)], key=str)
    assert extract(rows.limit(0)).count() == 0
