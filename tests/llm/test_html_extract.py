from __future__ import annotations

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nearmiss.llm import html_extract as h
from nearmiss.llm.html_extract import extract_main_text, main_text

PROSE = "A sentence of some length, with commas, that reads like the text of an article and not like a menu. "


def page(body: str) -> str:
    return (
        '<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{x}</style><script>var t="</p>";</script></head><body>'
        '<nav><ul><li><a href="/a">one</a></li><li><a href="/b">two</a></li></ul></nav>'
        f"{body}<footer>&copy; someone</footer></body></html>"
    )


def test_article_without_what_stands_beside():
    html = page(
        '<div class="ad">Buy this, now, really, it is good, yes.</div><header>Site name</header>'
        f"<article><h1>Head &amp; line</h1><p>{PROSE}</p><p>Second\n\t para<br>graph.</p>"
        '<div class="cookie-notice">We use cookies.</div><form><p>Your name, please</p></form></article>'
        f'<aside><p>{PROSE}</p></aside><div id="comments"><p>{PROSE * 5}</p></div>'
    )
    assert main_text(html) == f"Head & line {PROSE.strip()} Second para graph."


def test_container_is_found_by_score_without_article():
    menu = '<div><ul>' + "".join(f'<li><a href="/{i}">A rather long link, number {i}, with commas, in it</a></li>' for i in range(30)) + "</ul></div>"
    html = page(f'{menu}<div><div class="text">' + f"<p>{PROSE}</p>" * 4 + "<p>Short.</p></div></div>")
    assert main_text(html) == " ".join([PROSE.strip()] * 4 + ["Short."])


def test_siblings_that_read_like_prose_stay():
    html = page(f"<div><div><p>{PROSE * 3}</p><p>{PROSE}</p></div><p>{PROSE}</p><p><a href='x'>{PROSE}</a></p></div>")
    assert main_text(html) == " ".join([(PROSE * 3).strip(), PROSE.strip(), PROSE.strip()])


def test_a_name_that_only_hints_does_not_cost_the_text():
    """Whole names drop an element, parts of names don't unless its links tell."""
    side = page(f'<div class="side-effects"><p>{PROSE * 3}</p></div><p>short</p>')
    assert main_text(side) == f"{(PROSE * 3).strip()} short"
    items = '<ul class="menu-items"><li>Soup of the day</li><li>Fish</li></ul>'
    assert main_text(page(f"<article><p>{PROSE}</p>{items.replace('items', 'dishes')}</article>")) == f"{PROSE.strip()} Soup of the day Fish"
    links = '<ul class="share-us-today"><li><a href="x">Tell your friends</a></li><li><a href="y">Mail it</a></li></ul>'
    assert main_text(page(f"<article><p>{PROSE}</p>{links}</article>")) == PROSE.strip()
    for name in ("ad", "sidebar left", "cookie-notice", "site-header", "comments_list", "main-menu ads"):
        for attribute in ("class", "id"):
            html = page(f'<article><p>{PROSE}</p><div {attribute}="{name}"><p>{PROSE}</p></div></article>')
            assert main_text(html) == PROSE.strip(), name
    html = page(f'<article><p>{PROSE}</p><section role="complementary"><p>{PROSE}</p></section></article>')
    assert main_text(html) == PROSE.strip()
    for name in ("formula", "adapter", "social-history-of-bread", "post-header-text", "main-content"):
        assert main_text(page(f'<article><p>{PROSE}</p><div class="{name}">More.</div></article>')) == f"{PROSE.strip()} More."


@pytest.mark.parametrize("html", [
    "<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, '<a b="' * 100_000, "<a b='" * 99_999,
    "<b>" * 100_000 + "<h1>" * 100_000, "<!" * 200_000, "</" * 200_000, "<a " * 200_000, "<a \"'" * 100_001, "<p><b>" * 60_000,
    "<!-- " * 100_000, "<li><b>" * 60_000 + "</li>" * 60_000, "<" * 500_000, "<a>" + "x<" * 200_000 + "<!-- -->",
], ids=lambda x: x[:8].replace(" ", "_"))
def test_odd_markup_takes_linear_time(html):
    began = time.process_time()
    main_text(html)
    assert time.process_time() - began < 4  # a square would take minutes


def test_long_tags_are_still_tags():
    assert main_text(f'<p>one <img alt="{"x > y" * 50_000}"> two</p>') == "one two"


def _brute_scores(root):
    """Scores by their definition, a walk over the whole tree for each element."""
    def below(node, beside=False):
        yield node
        for c in node.children:
            if isinstance(c, h.Node) and not c.beside:
                yield from below(c)

    def in_link(node):
        while node is not None:
            if node.tag == "a":
                return True
            node = node.parent
        return False

    def own(node):
        return sum(len(c.strip()) for c in node.children if isinstance(c, str))

    nodes = list(below(root))
    chars = {id(n): sum(own(x) for x in below(n)) for n in nodes}
    linked = {id(n): sum(own(x) for x in below(n) if in_link(x)) for n in nodes}
    points = {id(n): 0.0 for n in nodes}
    for n in nodes:
        inline = [c for c in n.children if isinstance(c, h.Node) and c.tag not in h.BLOCK and not c.beside]
        length = own(n) + sum(chars[id(c)] for c in inline)
        if n.tag not in h.PARAGRAPHS or not length:
            continue
        commas = sum(c.count(",") for c in n.children if isinstance(c, str))
        mine = min(length / 25, 1.0) + commas + min(length / 100, 3.0)
        line, up = [], n if n.tag in h.CONTAINERS else n.parent
        while up is not None and len(line) < 5:
            line.append(up)
            up = up.parent
        for level, x in enumerate(line):
            points[id(x)] += mine / (1 if level == 0 else 2 if level == 1 else 3 * level)
    out = []
    for n in nodes:
        density = linked[id(n)] / max(chars[id(n)], 1)
        score = (points[id(n)] + h.PRIOR.get(n.tag, 0.0) + h.DOUBT * n.doubt) * (1 - density) if points[id(n)] else 0.0
        out.append(0.0 if n.doubt and density >= h.DOUBT_LINKS else score)
    return out


def test_scores_equal_their_definition_on_random_trees():
    rng = random.Random(11)
    names = ["div", "p", "section", "article", "ul", "li", "a", "b", "span", "td", "nav", "blockquote"]
    seen = 0
    for _ in range(300):
        html, open_ = "", []
        for _ in range(rng.randrange(1, 60)):
            kind = rng.random()
            if kind < 0.4:
                open_.append(rng.choice(names))
                html += f"<{open_[-1]}{rng.choice(['', '', ' class=side-effects', ' class=ad'])}>"
            elif kind < 0.6 and open_:
                html += f"</{open_.pop()}>"
            else:
                html += rng.choice(["word, ", "a longer run of words, with commas, ", "x" * 120])
        root = h.parse(html)
        want = _brute_scores(root)
        got = h.measure(root)
        seen += len(got)
        assert [round(n.score, 9) for n in got] == [round(x, 9) for x in want]
    assert seen > 1000


def test_broken_markup():
    html = page("<article><h1>H</h1><p><b>open bold.<br><p>next<p>third</i></p></div>tail &lt;x&gt; &nbsp; &#233;")
    assert main_text(html) == "H open bold. next third tail <x> é © someone".replace(" © someone", "")


def test_stray_quotes_comments_and_unclosed_raw_text():
    assert main_text('<p>a "quoted 5" < 6 & more</p><!-- <p>no</p> --><p title="x>y">b</p>') == 'a "quoted 5" < 6 & more b'
    assert main_text("<p>before</p><script>var x = '<p>no</p>'") == "before"
    assert main_text("<p>before</p><!-- never closed <p>no</p>") == "before"


def test_no_text():
    for html in (None, "", "   ", "<html></html>", "<script>x</script>", "<nav><a href='x'>menu</a></nav>"):
        assert main_text(html) == ""


def test_deep_nesting_and_long_text():
    assert main_text("<div>" * 5000 + f"<p>{PROSE}</p>") == PROSE.strip()
    assert len(main_text(f"<article><p>{'word ' * 200_000}</p></article>")) == 5 * 200_000 - 1


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/pab \"'=&;!-divscrt\n", max_size=200))
def test_any_input_gives_clean_text(html):
    text = main_text(html)
    assert text == " ".join(text.split())


def test_query_rows(spark, crowded):
    good = page(f"<article><p>{PROSE}</p></article>")
    rows = [(1, "http://a/", good), (1, "http://a/", good), (2, None, None), (None, "u", ""), (3, "v", "<p>x</p>")]
    frame = crowded(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(extract_main_text(frame).collect(), key=str)
    want = [(1, "http://a/", PROSE.strip()), (1, "http://a/", PROSE.strip()), (2, None, ""), (3, "v", "x"), (None, "u", "")]
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == sorted([(*w, len(w[2])) for w in want], key=lambda w: f"Row(page_id={w[0]}")
    assert extract_main_text(frame.limit(0)).count() == 0
