"""Wrapper induction on small sites."""

from __future__ import annotations

import random

import pytest
from helpers import frame, prose

from rillstone.llm import html


def text_of(page: str) -> str:
    return html.main_text(page, None)


CASES = [
    ("<p>one <b>two</b><br>three</p>", "one two three"),
    ("<main><div>a<p>b<p>c</div>d</main>", "a\nb\nc\nd"),
    ("x &lt;b&gt; &amp; &eacute;&#233;&#xe9; &unknown; &am", "x <b> & ééé &unknown; &am"),
    ("<ul><li>a<li>b <i>c</i></ul>", "a\nb c"),
    ("<main><table><tr><td>1<td>2<tr><td>3</table></main>", "1\n2\n3"),
    ("<nav>menu</nav><article><h1>T</h1><p>a  \n b</p></article><footer>f</footer>", "T\na b"),
    ('<article><p>a</p><div class="share-bar">s</div><aside>b</aside><form><p>c</p></form><p>d</p></article>', "a\nd"),
    ('<article><p>a</p><section id="comments"><p>no</p></section></article>', "a"),
    ('<article><p>a <span hidden>h</span>b</p><p style="display: none">n</p></article>', "a b"),
    ("<body><script>var t='</p><p>x'; if (a<b) {}</script><style>p{}</style><p>a</p><!-- <p>c</p> --></body>", "a"),
    ("<p>cut off <a href=\"x", "cut off"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<p>open <!-- never closed", "open"),
    ("<script>never closed <p>x", ""),
    ("</p></div>stray</b>", "stray"),
    ("<P CLASS=x>Upper</P><DIV>Case</DIV>", "Upper\nCase"),
    ("", ""),
    ("<html><body></body></html>", ""),
    ('<div class="content with-sidebar"><p>long enough to be most of the text here</p></div><div class="sidebar">s</div>', "long enough to be most of the text here"),
    ('<header>site</header><main><header><h1>Title</h1></header><p>a</p></main>', "Title\na"),
    ("<article><p>a<svg><text>s</text></svg></p><select><option>o</select><button>b</button></article>", "a"),
    ("<pre>a\n  b</pre>", "a b"),
]


@pytest.mark.parametrize(("page", "want"), CASES)
def test_page(page, want):
    assert text_of(page) == want


def test_deep_and_long_pages():
    assert text_of("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert text_of("<p>a</p>" * 20000).count("\n") == 19999


def site(n: int, seed: int, notice: str = "Please mind our weekly letter."):
    """Pages without telling names: only what varies shows where the article is."""
    rng = random.Random(seed)
    pages = []
    for _ in range(n):
        paragraphs = [prose(rng, rng.randint(20, 60)) for _ in range(rng.randint(2, 6))]
        title = prose(rng, 5)
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        top = '<div class="x1"><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul><p>The Daily Thing</p></div>'
        end = f'<div class="x3"><p>{notice}</p><p>All rights kept.</p></div>'
        page = f'<html><body>{top}<div class="x2"><h1>{title}</h1>{body}<p class="q">{notice}</p></div>{end}</body></html>'
        pages.append((page, "\n".join([title, *paragraphs])))
    return pages


def test_host_template(spark):
    found = site(30, 1)
    rows = [(i, f"http://www.One.example/{i}", page) for i, (page, _) in enumerate(found)]
    # Copies of one article do not make it template.
    copies = [(100 + i, "https://two.example:80/a?b", f"<body><article><h1>t</h1><p>same text</p></article><p>{i}</p></body>") for i in range(9)]
    odd = [(200, None, None), (201, "", ""), (202, "not a url", "<p>alone</p>"), (None, "http://one.example/x", found[0][0])]
    odd += [(3, rows[3][1], rows[3][2])]
    df = frame(spark, rows + copies + odd, "page_id long, url string, html string")
    got = html.extract(df).collect()
    assert len(got) == len(rows) + len(copies) + len(odd)
    texts = {r["page_id"]: r["text"] for r in got}
    assert all(texts[i] == want for i, (_, want) in enumerate(found))
    assert {texts[100 + i] for i in range(9)} == {"t\nsame text"}
    assert (texts[200], texts[201], texts[202], texts[None]) == ("", "", "alone", found[0][1])
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.extract(frame(spark, [], "page_id long, url string, html string")).count() == 0


def test_align_prefers_equal_texts():
    a = html.tree_of(html.parse("<body><p>x</p><p>same</p></body>"))
    b = html.tree_of(html.parse("<body><p>y</p><p>z</p><p>w</p><p>same</p></body>"))
    matched = html.align(a, b)
    last = {a.texts[x] == b.texts[y] for x, y in matched.items() if x == len(a.labels) - 1}
    assert last == {True}


def test_text_beside_the_largest_container_stays():
    long = prose(random.Random(4), 40)
    post = '<div class="post"><h1>{}</h1><p>{}</p><div class="text"><p>{}</p></div><p>{}</p></div>'
    assert text_of(f"<body>{post.format('Title', 'Lead', long, 'End')}</body>") == f"Title\nLead\n{long}\nEnd"
    assert text_of(f'<div><h1><a href="/">T</a></h1><div><p>{long}</p></div></div>') == f"T\n{long}"
    for tag in ("blockquote", "section", "table"):
        inner = f"<tr><td>{long}</td></tr>" if tag == "table" else f"<p>{long}</p>"
        assert text_of(f"<div><p>Before</p><{tag}>{inner}</{tag}><p>After</p></div>") == f"Before\n{long}\nAfter"


def test_host_with_nested_divs(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(12):
        # The smallest page has no title and no lead.
        title, lead, text = prose(rng, 4), prose(rng, 6), prose(rng, 50)
        head = f"<h1>{title}</h1><p>{lead}</p>" if i else ""
        top, end = "<div><p>The Daily Thing</p></div>", "<div><p>All rights kept.</p></div>"
        page = f'<body>{top}<div class="post">{head}<div class="text"><p>{text}</p></div></div>{end}</body>'
        rows.append((i, f"http://nested.example/{i}", page))
        want[i] = "\n".join([title, lead, text] if i else [text])
    got = html.extract(frame(spark, rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_surplus_end_tags():
    deep = "<div>" * 200 + "x" + "</div>" * 200
    assert text_of(f"<article>{deep}<p>after</p></article><p>outside</p>") == "x\nafter"
    # What is no content holds what stands in it, however deep.
    menu = '<nav><ul><li>menu</li></ul></nav>'
    assert text_of("<main>" + "<div>" * 200 + menu + "y</b></i><b>z</b>" + "</div>" * 200 + "<p>end</p></main>") == "yz\nend"
    parents = html.parse("<div>" * 5000 + "x").parents
    depth = [0]
    for p in parents[1:]:
        depth.append(depth[p] + 1)
    assert max(depth) <= html.DEEPEST


def matching(a: html.Tree, b: html.Tree, x: int = 0, y: int = 0) -> int:
    """The size of the best matching of two small trees, as defined."""
    best = [[0] * (len(b.children[y]) + 1) for _ in range(len(a.children[x]) + 1)]
    for i, c in enumerate(a.children[x]):
        for j, d in enumerate(b.children[y]):
            both = best[i][j] + matching(a, b, c, d) if a.labels[c] == b.labels[d] else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], both)
    return 1 + (a.texts[x] == b.texts[y]) + best[-1][-1]


@pytest.mark.parametrize("cells", [1 << 20, 4])
@pytest.mark.parametrize("long", [48, 0, 3])
def test_align_is_the_best_matching(monkeypatch, cells, long):
    """However it is computed: row by row or with arrays, with the whole table or parts of it."""
    monkeypatch.setattr(html, "CELLS", cells)
    monkeypatch.setattr(html, "LONG", long)
    rng = random.Random(11)

    def tree() -> html.Tree:
        n = rng.randint(1, 12)
        parents = [-1, *[rng.randint(max(0, i - 3), i) for i in range(n)]]
        return html.Tree([0, *[rng.randint(0, 1) for _ in range(n)]], parents, [rng.randint(0, 2) for _ in range(n + 1)], [1] * (n + 1), [0] * (n + 1))

    found = []
    for _ in range(500):
        a, b = tree(), tree()
        got = html.align(a, b)
        assert len(set(got.values())) == len(got)
        assert all(a.labels[x] == b.labels[y] and (x == 0 or got[a.parents[x]] == b.parents[y]) for x, y in got.items())
        size = sum(1 + (a.texts[x] == b.texts[y]) for x, y in got.items())
        assert size == matching(a, b)
        found.append(got)
    monkeypatch.undo()
    rng.seed(11)
    assert found == [html.align(tree(), tree()) for _ in range(500)]


def test_deep_and_long_pages_through_hosts(spark):
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    long = ["".join(f"<p>{k} {i}</p>" for i in range(20000)) for k in ("a", "b")]
    pages = [("deep", deep), ("long", long[0]), ("both", long[0]), ("both", long[1] + "<p>c</p>")]
    rows = [(i, f"http://{name}.example/", f"<body>{page}</body>") for i, (name, page) in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in html.extract(frame(spark, rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "x" and [got[i].count("\n") for i in (1, 2, 3)] == [19999, 19999, 20000]


def test_boilerplate_longer_than_the_story(spark):
    rng = random.Random(12)
    rows, want = [], {}
    notice = prose(rng, 150)
    for i in range(20):
        story = f"{prose(rng, 12)} {i}"
        rows.append((i, f"http://short.example/{i}", f"<body><div><p>{notice}</p></div><div><p>{story}</p></div></body>"))
        want[i] = story
    # A copied story is none: it is on few pages of the host.
    rows += [(100 + i, *rows[3][1:]) for i in range(8)]
    want |= {100 + i: want[3] for i in range(8)}
    got = html.extract(frame(spark, rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def neutral_site(n: int, seed: int, article: bool) -> list[tuple[str, str]]:
    """Pages whose class names tell nothing: one block before the story, one inside it and one behind are the same on
    every page. (page, main text) of each."""
    rng = random.Random(seed)
    before, within, behind = (prose(rng, k) for k in (30, 12, 60))
    tag = "article" if article else "div"
    out = []
    for _ in range(n):
        title, paragraphs = prose(rng, 5), [prose(rng, rng.randint(15, 60)) for _ in range(rng.randint(2, 6))]
        middle = "".join(f"<p>{p}</p>" for p in paragraphs)
        page = (
            f'<body><div class="k1"><p>{before}</p></div><{tag} class="k2"><h1>{title}</h1><div class="k3"><p>{within}</p></div>'
            f'{middle}</{tag}><div class="k4"><p>{behind}</p></div></body>'
        )
        out.append((page, "\n".join([title, *paragraphs])))
    return out


@pytest.mark.parametrize("article", [True, False])
def test_the_wrapper_decides_where_names_tell_nothing(spark, article):
    """What is the same on all pages of a host goes, inside an article as well, though no name marks it; a page by itself
    cannot know."""
    found = neutral_site(25, 3, article)
    rows = [(i, f"http://plain.example/{i}", page) for i, (page, _) in enumerate(found)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html.extract(df).collect()}
    assert got == {i: text for i, (_, text) in enumerate(found)}
    alone = [html.main_text(page, None) for page, _ in found]
    assert all(a != text for a, (_, text) in zip(alone, found))
