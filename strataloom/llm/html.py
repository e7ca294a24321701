"""Main text of HTML pages by tree scoring.

Each block of text passes points for its length and commas to its parent and half of them to the
grandparent, discounted by the share of its text that is links. The container with the most
points, or the article around it, is kept, and so is all text beside it and beside the containers
around it, up to <main> if there is one, but for boilerplate and parts that are largely links.
A name such as "notice-of-ruling" or "discussion" doesn't settle what a part is: its share of links
and how it holds its text do. Reader comments are also known by the heading before them and as
articles within an article that has a text of its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements by how they are laid out.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BOILERPLATE = frozenset("script style textarea title noscript iframe noembed noframes template head nav header footer aside menu dialog button select datalist fieldset object svg canvas audio video map search label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words of a class or id that mark what isn't the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored sponsors promo promoted promotion banner cookie cookies consent gdpr notice notices newsletter subscribe subscription paywall"
    " sidebar sidebars sidenav nav navbar navigation menu menus breadcrumb breadcrumbs footer footers foot header headers masthead topbar toolbar comment comments commentlist disqus reply replies respond thread threads discussion discussions"
    " share sharing social related recommended recommendations popup modal overlay pagination pager login signup widget widgets outbrain taboola skip hidden".split()
)
#: Words before those, in one name, that tell of a layout with or without such a part: "with-sidebar".
LAYOUT = frozenset(("with", "has", "no", "without"))
#: Those of them that also stand in names of parts of an article: "entry-header", "notice-of-ruling".
DOUBTFUL = frozenset("notice notices header headers head foot banner share sharing social related promotion hidden skip widget widgets overlay".split())
#: Words that name no subject: a doubtful word among these only is not an article's.
PLAIN = frozenset("a box bar area block blocks list wrap wrapper container inner outer item items top bottom left right site page global main primary secondary sticky fixed text link links button buttons form panel unit slot label message msg policy the this is my our js c u l o".split())
#: Words that are also the name of a part of an article when they stand alone: id="discussion".
TOPICS = frozenset("discussion discussions menu menus".split())
#: Words between a mark and its subject: "comment-on-the-ruling".
ABOUT = frozenset("on of about regarding".split())
#: Share of links, at most, of a part with a doubtful name that is the article's; the same for what stands beside the best container, and for paragraphs and lists there.
LINKED, LINKED_TEXT = 0.25, 0.5
#: Elements that hold text as paragraphs do.
PARAGRAPHS = frozenset("p blockquote pre dd td th h1 h2 h3 h4 h5 h6 figcaption li".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What only a form around a whole page holds.
PAGE_PARTS = frozenset("article main h1 nav header footer".split())
#: Headings of reader comments; those of the second kind are an article's own if a paragraph follows at once.
READERS = re.compile(r"\d+ (?:comments?|replies|responses)|(?:readers?|users?|visitors?)['’]?s? (?:comments|replies|responses)(?: ?\(\d+\))?|(?:comments|replies|responses) ?\(\d+\)|(?:leave|post|write|add) (?:a|your) (?:comment|reply)|join the (?:discussion|conversation)", re.I)
PERHAPS_READERS = re.compile(r"comments|replies|responses", re.I)
#: The elements that an opening tag ends without an end tag, and where the search for them stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

NAME = re.compile(r"/?[a-zA-Z][^\s/>]*+")
#: The rest of a tag behind its name: a quote opens a value only behind "=", and only if it is closed again.
REST = re.compile(r"""((?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+")


def _marked(tag: str, attributes: str) -> int:
    """Whether an element's attributes say that it isn't part of the article: 0 no, 1 its name has a doubtful word, 2 its name may be a topic's, 3 yes."""
    out = 0
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            if tag not in ("html", "body", "article", "main"):
                for token in value.split():
                    words = WORDS.findall(token)
                    marks = MARKS.intersection(words)
                    if marks and not any(x in LAYOUT and y in MARKS for x, y in zip(words, words[1:], strict=False)):
                        subject = any(x in marks and y in ABOUT for x, y in zip(words, words[1:-1], strict=False))
                        doubt = subject or marks <= DOUBTFUL and not MARKS.union(PLAIN).issuperset(words)
                        out = max(out, 1 if doubt else 2 if TOPICS.issuperset(words) else 3)
            elif tag == "article" and {"comment", "comments", "reply", "related", "ad", "promo", "sponsored"} & {*WORDS.findall(value)}:
                return 3
        elif name == "role":
            if value.strip() in ROLES:
                return 3
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return 3
    return out


class Page:
    """The tree of one page: per node its tag, parent and whether it is boilerplate; and the blocks of text."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.off, self.doubt = ["#root"], [-1], [False], {}
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters of links
        self._text: list[str] = []
        self._links = 0
        self._read(html)

    def _flush(self, node: int) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((node, text, self._links))
            self._text, self._links = [], 0

    def _say(self, raw: str, node: int, links: int) -> None:
        if raw and not self.off[node]:
            said = unescape(raw) if "&" in raw else raw
            self._text.append(said)
            if links:
                self._links += len(said.strip())

    def _read(self, html: str) -> None:
        stack, home, at, said, links = [0], [0], 0, 0, 0  # home: the nearest block around each open node; said: where what hasn't been said begins
        open_ = Counter()

        def close(upto: int) -> None:
            nonlocal links
            while len(stack) > upto:
                node = stack.pop()
                home.pop()
                open_[self.tag[node]] -= 1
                if self.tag[node] == "a":
                    links -= 1
                if self.tag[node] in BLOCKS:
                    self._flush(node)

        def find(names, stops) -> int:
            if not any(open_[t] for t in names):
                return 0
            for i in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[i]]
                if t in names:
                    return i
                if t in stops:
                    return 0
            return 0

        while (start := html.find("<", at)) >= 0:
            if start > said:
                self._say(html[said:start], stack[-1], links)
            said, at = start, start + 1
            if html.startswith(("!", "?"), at):
                end = html.find("-->" if html.startswith("!--", at) else ">", at)
                at = said = len(html) if end < 0 else end + (3 if html.startswith("!--", at) else 1)
                continue
            m = NAME.match(html, at)
            if not m:
                continue  # a bare "<"
            rest = REST.match(html, m.end())
            if not rest:  # the page ends within the tag
                said = len(html)
                break
            at = said = rest.end()
            name, ends = m[0].lstrip("/"), m[0][0] == "/"
            name = name.lower()
            if ends:
                if name in BLOCKS:
                    i = find({name}, ())
                    if i:
                        close(i)
                    self._flush(home[-1])
                elif name == "br":
                    self._say(" ", stack[-1], 0)
                elif i := find({name}, BLOCKS):
                    close(i)
                continue
            if name in BLOCKS:
                if i := find({"p"}, {"td", "th", "button", "table", "article", "section", "div", "body"}):
                    close(i)
                if name in ENDS and (i := find(*ENDS[name])):
                    close(i)
                self._flush(home[-1])
            elif name == "a" and links and (i := find({"a"}, BLOCKS)):
                close(i)
            if name in VOID:
                if name == "br":
                    self._say(" ", stack[-1], 0)
                continue
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(stack[-1])
            mark = _marked(name, rest[1]) if len(rest[1]) > 3 else 0
            self.off.append(self.off[stack[-1]] or name in BOILERPLATE or mark == 3)
            if mark or name == "form":
                self.doubt[node] = mark
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                at = said = end.end() if end else len(html)
                continue
            stack.append(node)
            open_[name] += 1
            home.append(node if name in BLOCKS else home[-1])
            links += name == "a"
        if said < len(html):
            self._say(html[said:], stack[-1], links)
        self._flush(home[-1])
        self._settle()

    def _settle(self) -> None:
        """Drop what the whole page shows not to be the article's: parts with doubtful names, forms, reader comments."""
        if self.doubt:
            self._drop(self._doubtful())
        self._drop_readers()
        if self.tag.count("article") > 1:
            self._drop(self._replies())

    def _drop(self, gone: set[int]) -> None:
        off = [False] * len(self.tag)
        for node in range(1, len(self.tag)):
            off[node] = node in gone or off[self.parent[node]]
        self.blocks = [b for b in self.blocks if not off[b[0]]]

    def _doubtful(self) -> set[int]:
        """Forms, but for those around a page, and parts with doubtful names, but for those with few links and most of their text in paragraphs, or with a heading of the article.

        A part that has a topic's name must hold these paragraphs itself: a thread of comments wraps each of them.
        """
        length, linked, titled = self._sums()
        held, own = [0] * len(self.tag), [0] * len(self.tag)  # characters in paragraphs below each node, and in its own
        page = [False] * len(self.tag)
        for node, text, _ in self.blocks:
            if self.tag[node] in PARAGRAPHS:
                held[node] += len(text)
                if self.tag[node] != "li":
                    own[node] += len(text)
                    own[self.parent[node]] += len(text)
        for node in range(len(self.tag) - 1, 0, -1):
            up = self.parent[node]
            held[up] += held[node]
            page[node] = page[node] or self.tag[node] in PAGE_PARTS
            page[up] = page[up] or page[node]
        gone = set()
        for node, mark in self.doubt.items():
            if self.tag[node] == "form" and not page[node]:
                gone.add(node)
            elif mark and not (mark == 1 and titled[node]):
                said = held if mark == 1 else own
                if linked[node] > LINKED * length[node] or 2 * said[node] < length[node]:
                    gone.add(node)
        return gone

    def _drop_readers(self) -> None:
        """Drop what follows a heading of reader comments, up to the next heading of its rank or the end of the part that holds both."""
        found = [i for i, (node, text, _) in enumerate(self.blocks) if self.tag[node] in HEADINGS and self._readers(i, text)]
        if not found:
            return
        last = list(range(len(self.tag)))  # the last node below each
        for node in range(len(self.tag) - 1, 0, -1):
            last[self.parent[node]] = max(last[self.parent[node]], last[node])
        length = self._sums()[0]
        kept, done = [], 0
        for i in found:
            if i < done:
                continue
            kept += self.blocks[done:i]
            node, text, _ = self.blocks[i]
            at = node
            while self.parent[at] > 0 and length[self.parent[at]] == len(text):  # a part around the heading alone
                at = self.parent[at]
            within, rank, done = self.parent[at], self.tag[node], i + 1
            while done < len(self.blocks) and within <= self.blocks[done][0] <= last[within]:
                other = self.blocks[done][0]
                if self.parent[other] == within and self.tag[other] in HEADINGS and self.tag[other] <= rank and not self._readers(done, self.blocks[done][1]):
                    break
                done += 1
        self.blocks = kept + self.blocks[done:]

    def _readers(self, i: int, text: str) -> bool:
        """Whether block i is a heading of reader comments."""
        if READERS.fullmatch(text.rstrip(".:!…")):
            return True
        if not PERHAPS_READERS.fullmatch(text.rstrip(":")):
            return False
        following = self.blocks[i + 1][0] if i + 1 < len(self.blocks) else -1
        return following < 0 or self.tag[following] != "p" or self.parent[following] != self.parent[self.blocks[i][0]]

    def _replies(self) -> set[int]:
        """Articles within an article whose own text is at least as long as any of theirs."""
        within = [0] * len(self.tag)  # the nearest article around each node, itself included
        for node in range(1, len(self.tag)):
            within[node] = node if self.tag[node] == "article" else within[self.parent[node]]
        own, inner = Counter(), {}
        for node, text, _ in self.blocks:
            own[within[node]] += len(text)
        for node in range(1, len(self.tag)):
            if self.tag[node] == "article" and within[self.parent[node]]:
                inner.setdefault(within[self.parent[node]], []).append(node)
        return {n for outer, nodes in inner.items() if own[outer] >= max(own[n] for n in nodes) for n in nodes}

    def _sums(self) -> tuple[list[int], list[int], list[bool]]:
        """Per node the characters of text and of links below it, and whether it holds an <h1> or <h2>."""
        length, linked, titled = [0] * len(self.tag), [0] * len(self.tag), [False] * len(self.tag)
        for node, text, links in self.blocks:
            length[node] += len(text)
            linked[node] += links
            titled[node] = titled[node] or self.tag[node] in ("h1", "h2")
        for node in range(len(self.tag) - 1, 0, -1):  # children come after their parents
            up = self.parent[node]
            length[up] += length[node]
            linked[up] += linked[node]
            titled[up] = titled[up] or titled[node]
        return length, linked, titled

    def points(self) -> tuple[list[float], list[int], list[int]]:
        """Per node: its points, and the characters of text and of links below it."""
        score = [0.0] * len(self.tag)
        for node, text, links in self.blocks:
            own = (1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) / 100, 3.0)) * (1 if len(text) >= 25 else 0.25)
            own *= 1 - min(1.0, links / len(text))
            to = node if self.tag[node] in ("div", "section", "article", "main", "body", "td", "#root") else self.parent[node]
            score[to] += own
            if to > 0:
                score[self.parent[to]] += own / 2
        length, linked, _ = self._sums()
        return [s * (1 - min(1.0, k / n)) if n else 0.0 for s, n, k in zip(score, length, linked, strict=True)], length, linked

    def main_text(self) -> str:
        if not self.blocks:
            return ""
        score, length, linked = self.points()
        best = max(range(len(score)), key=lambda i: (score[i], -i))
        at = best
        while at > 0:
            if self.tag[at] in ("article", "main"):
                best = at
                if self.tag[at] == "article":
                    break
            at = self.parent[at]
        around, at = set(), best  # the nodes above the best one, up to <main> if there is one
        while at > 0 and self.tag[at] != "main":
            at = self.parent[at]
            around.add(at)
        inside = [False] * len(self.tag)
        for node in range(len(self.tag)):
            up = self.parent[node]
            beside = up in around and node not in around and linked[node] < (LINKED_TEXT if self.tag[node] in ("p", "ul", "ol", "dl") else LINKED) * length[node]
            inside[node] = node == best or beside or node > 0 and inside[up]
        return "\n".join(text for node, text, links in self.blocks if inside[node] or node in around and links < LINKED * len(text))


def extract(html: str | None) -> str:
    """The main text of a page; empty for none."""
    return Page(html).main_text() if html else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row; no shuffle, no state between pages.

    A null or empty html gives an empty text. Broken markup is read as far as it goes: a quote that
    isn't closed is none, and a tag that the page's end cuts off is left out. Pages of any length are read
    whole, in time that grows with their length. Repeated rows come out repeated; other columns are
    ignored; an empty table gives an empty one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")


def op2_html(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op2_html": op2_html}
ORACLES: dict[str, str] = {}
