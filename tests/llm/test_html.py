import html
import re
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataloom.llm.html import Page, extract, extract_pages

LONG = "A paragraph of the article, with commas, and enough text to be one."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain  text", "plain text"),
        (f"<body><nav><a href=/>Home</a></nav><header>Site</header><div class=main><h2>Head</h2><p>{LONG}</p></div><footer>F</footer></body>", f"Head\n{LONG}"),
        (f"<article><p>{LONG}<p>Second<br>line</article><aside>Side</aside>", f"{LONG}\nSecond line"),
        (f"<article><p>{LONG}</p><form>Mail <input></form><div class='ad'>Buy</div><script>'</p>'</script><style>p{{}}</style></article><div id=comments><article class=comment><p>{LONG}</p></article></div>", LONG),
        (f"<main><article><section><p>One, two</p></section><section><p>{LONG}</p></section></article></main>", f"One, two\n{LONG}"),
        ("<p>a &lt;b&gt; &amp;amp; &#233;&nbsp;x</p>", "a <b> &amp; é x"),
        ("<p>x<!-- no --> y</p><!-- open", "x y"),
        ("<div>a<b>c</b>d <i>e</i>f</div>", "acd ef"),
        (f"<ul><li>one<li>two</ul><p>{LONG}</p><table><tr><td>c1<td>c2</table>", f"one\ntwo\n{LONG}\nc1\nc2"),
    ],
)
def test_main_text(page, text):
    assert extract(page) == text


def test_depth_and_size():
    assert extract("<div>" * 5000 + LONG) == LONG
    assert extract(f"<article>{'<p>' + LONG:s}{('</p><p>' + LONG) * 5000}</article>").count("\n") == 5000


def test_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|<footer|$)", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, None, 1), (None, "u", "<p>x", 2), (2, "u", "", 3), (2, "u", "", 3)], "page_id long, url string, html string, text int")
    got = extract_pages(df).collect()
    assert sorted(r.text for r in got) == ["", "", "", "x"] and extract_pages(df.where("false")).count() == 0


LINKS = "<ul><li><a href=/1>One other page</a><li><a href=/2>Another other page</a></ul>"
BODY = f"<div class=body><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
KEPT = "\n".join([LONG] * 3)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div id=content><p>Short lead</p>{BODY}<ul><li>one<li>two</ul></div>", f"Short lead\n{KEPT}\none\ntwo"),
        (f"<div><h3>Head</h3>{BODY}<h2>After</h2><blockquote>Quote</blockquote><table><tr><td>c1<td>c2</table><p>End.</p></div>", f"Head\n{KEPT}\nAfter\nQuote\nc1\nc2\nEnd."),
        (f"<body><nav>{LINKS}</nav><div><div>{BODY}</div><section><h2>Second</h2><p>Few words</p></section></div>{LINKS}<footer>F</footer></body>", f"{KEPT}\nSecond\nFew words"),
        (f"<body><p>Lead</p><article>{BODY}</article>loose text<p>End</p>{LINKS}<div class=ad>Buy</div></body>", f"Lead\n{KEPT}\nloose text\nEnd"),
        (f"<body><p>Outside</p><main><p>Lead</p><article>{BODY}</article></main></body>", f"Lead\n{KEPT}"),
    ],
)
def test_nothing_beside_the_best_container_is_lost(page, text):
    assert extract(page) == text


def test_broken_tags_never_reach_the_text():
    long = "Some text, with commas, that is long enough to count as a paragraph of the article."
    for page in (f"<p title=it's>{long}</p><p>Next</p>", f'<p class="x>{long}</p>', f"<div data-x='1' title=\"a>b\"><p>{long}</p></div>", f"<p>{long}</p><a href='x"):
        text = extract(page)
        assert "<" not in text and "title" not in text and "class" not in text and long in text, page
    assert extract(f"<p>{long} 1 < 2 and <3 hearts</p>") == f"{long} 1 < 2 and <3 hearts"
    assert extract(f"<!-- <p>no</p> --><p>{long}</p><!-- open <p>lost") == long


def test_names_with_doubtful_words():
    long = "Some text, with commas, that is long enough to count as a paragraph of the article, and then a bit more of it, so that it can't be a mere notice on the page."
    page = f'<div class="post"><div class="entry-header"><h1>The title</h1></div><p>{long}</p><section id="notice-of-ruling"><p>{long} Again.</p></section>'
    page += f'<div class="cookie-notice"><p>We use cookies.</p></div><div class="with-ads promo"><p>{long} Buy.</p></div><div class="thread"><p>{long} I agree.</p></div><div class="with-sidebar"><p>{long} End.</p></div></div>'
    assert extract(page) == f"The title\n{long}\n{long} Again.\n{long} End."


def test_long_pages_take_time_in_proportion():
    import time

    start = time.perf_counter()
    for page in ("<a " * 300_000, "<b>" * 200_000 + "</i>" * 200_000, "<b>" * 100_000 + "<h1>x</h1>" * 50_000, '<a b="' * 200_000, "<a b='>" * 200_000, "<!-- " * 200_000, "<" * 500_000, "<div>" * 100_000 + "text"):
        extract(page)
    assert time.perf_counter() - start < 60


PROSE = "The court held, after a long hearing, that the rule applies."


@pytest.mark.parametrize(
    ("part", "kept"),
    [
        (f"<section id=discussion><h2>Discussion</h2><p>{PROSE}</p></section>", f"Discussion\n{PROSE}"),
        (f"<section id=discussion><h2>Discussion</h2><div><p>{PROSE}</p></div><div><p>{PROSE}</p></div></section>", None),
        (f"<section id=comment-on-the-ruling><p>{PROSE}</p></section>", PROSE),
        (f"<section id=menu><h2>The menu</h2><p>{PROSE}</p></section>", f"The menu\n{PROSE}"),
        ("<ul id=menu><li>Home<li>About</ul>", None),
        (f"<div id=menu>{LINKS}</div>", None),
        ("<p class=social-security>Short remark.</p>", "Short remark."),
        ("<div class=holiday-notice>We are closed.</div>", None),
        ("<div class=comment-list><p>I agree.</p></div>", None),
        (f"<section><h2>Reader comments</h2><div class=c1><p>{PROSE}</p></div><p>Me too.</p></section>", None),
        (f"<div><h3>2 comments</h3></div><div><p>{PROSE}</p></div><div><p>Yes.</p></div>", None),
        (f"<h3>Comments</h3><p>{PROSE}</p>", f"Comments\n{PROSE}"),
        (f"<h3>Comments</h3><ul><li>{PROSE}</ul><h3>Sources</h3><p>Smith.</p>", "Sources\nSmith."),
        ("<article class=user-post><p>I agree.</p></article>", None),
        ("<form><label>Mail</label><h2>Write to us</h2><p>We answer soon.</p></form>", None),
    ],
)
def test_names_and_headings_settled_by_content(part, kept):
    for open_, close in (("<article>", "</article>"), ("<div class=post>", "</div>")):
        if "<article" in part and open_ != "<article>":
            continue
        page = f"<body>{open_}<h1>Title</h1>{'<p>' + LONG + '</p>' * 3}{'<p>' + LONG + '</p>'}{part}{close}</body>"
        assert extract(page) == "\n".join(["Title", LONG, LONG, *([kept] if kept else [])]), (open_, extract(page))


def test_live_reports_pages_in_a_form_and_linked_leads():
    report = f"<article><h1>Live</h1><p>Short intro.</p><article><p>{LONG}</p></article><article><p>{LONG} Then.</p></article></article>"
    assert extract(report) == f"Live\nShort intro.\n{LONG}\n{LONG} Then."
    assert extract(f"<body><form action=/x><header>Top</header><h1>Title</h1>{BODY}<input><label>Search</label></form></body>") == f"Title\n{KEPT}"
    sources = "<ul><li>Smith, 2020, <a href=/1>The rule</a><li>Jones, 2021, in print</ul>"
    assert extract(f"<div><p>A lead with <a href=/x>a link</a> in it</p>{BODY}{sources}{LINKS}</div>") == f"A lead with a link in it\n{KEPT}\nSmith, 2020, The rule\nJones, 2021, in print"


class Brute(HTMLParser):
    """Points of well-formed pages, computed anew from lists of ancestors."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.path, self.n, self.found = [], 0, {}

    def handle_starttag(self, tag, attrs):
        self.n += 1
        self.path.append((self.n, tag))

    def handle_endtag(self, tag):
        self.path.pop()

    def handle_data(self, data):
        block = max((i for i, (_, t) in enumerate(self.path) if t in ("p", "div", "section", "article", "body", "li", "ul", "h1")), default=-1)
        key = tuple(self.path[: block + 1])
        text, links = self.found.get(key, ("", 0))
        self.found[key] = (text + data, links + len(data.strip()) * any(t == "a" for _, t in self.path))

    def points(self):
        given, length, linked = {}, {}, {}
        for path, (text, links) in self.found.items():
            text = " ".join(text.split())
            if not text:
                continue
            worth = (1 + sum(text.count(c) for c in ",，、") + min(len(text) / 100, 3)) * (1 if len(text) >= 25 else 0.25) * (1 - min(1, links / len(text)))
            holders = [n for n, _ in path]
            to = holders if path[-1][1] in ("div", "section", "article", "body") else holders[:-1]
            for n, share in zip(reversed([0, *to]), (1, 0.5), strict=False):
                given[n] = given.get(n, 0) + worth * share
            for n in [0, *holders]:
                length[n] = length.get(n, 0) + len(text)
                linked[n] = linked.get(n, 0) + links
        return {n: given.get(n, 0) * (1 - min(1, linked[n] / length[n])) for n in length}


@st.composite
def well_formed(draw, depth=4):
    words = st.sampled_from(["short", "a text, with commas, and long enough to count", "links here", "多、多，字"])
    kind = draw(st.sampled_from(["p", "a", "ul"] + ["div", "section"] * 2)) if depth else "p"
    if kind in ("div", "section"):
        return f"<{kind}>{''.join(draw(st.lists(well_formed(depth=depth - 1), min_size=1, max_size=4)))}</{kind}>"
    if kind == "ul":
        return f"<ul><li>{draw(words)}</li><li><a>{draw(words)}</a></li></ul>"
    return f"<p>{draw(words)} <a>{draw(words)}</a></p>" if kind == "a" else f"<p>{draw(words)}</p>"


@settings(max_examples=200, deadline=None)
@given(st.lists(well_formed(), min_size=1, max_size=4))
def test_points_against_brute_force(parts):
    page = f"<body>{''.join(parts)}</body>"
    brute = Brute()
    brute.feed(page)
    want = brute.points()
    tree = Page(page)
    got = {n: s for n, s in enumerate(tree.points()[0]) if tree.points()[1][n]}
    assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-9 for n in want)
