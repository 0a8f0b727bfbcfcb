"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, the runs of text between the tags that break lines. Every block has features of its
ancestors (tags, words of classes and ids) and of its text (length, links, punctuation); the chain decides
for all blocks of a page at once which belong to the article, by Viterbi. The weights are trained on labelled
pages, a sample of bounded size: pages of the table whose own mark-up tells the article, and text of these and
other pages set again in many layouts, with menus, notices, adverts, forms and comments around and inside. The
layouts carry their own labels, so no page has to name its article.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from custbehav.llm.common import columns

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
HIDDEN = frozenset("script style noscript template svg math iframe object textarea select head".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
SECTIONS = frozenset("article aside dialog fieldset footer form header ins main nav section".split())
# An open tag of the first set ends an open element of the second within the same list or table.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# What may stand in a head; anything else ends an open one, whose end tag may be left out.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
# Inside an article these hold no main text.
_NOT_MAIN = frozenset({"tag aside", "tag nav", "tag form", "tag footer"})
_FEATURES = 1 << 12
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LABEL = "data-main"


def _index(name: str) -> int:
    return zlib.crc32(name.encode()) % _FEATURES


class _Element:
    __slots__ = ("tag", "marks", "hidden", "link", "label")

    def __init__(self, tag, marks, hidden, link, label):
        self.tag, self.marks, self.hidden, self.link, self.label = tag, marks, hidden, link, label


class Blocks(HTMLParser):
    """Collects the leaf blocks of a page: text, words within links, ancestors' marks and, where given, the label."""

    def __init__(self, labelled: bool = False):
        super().__init__(convert_charrefs=True)
        self.labelled = labelled
        self.open = [_Element("", frozenset(), False, False, 0)]
        self.found: list[tuple[str, int, str, frozenset, int]] = []
        self.text: list[str] = []
        self.linked = 0

    def parse_marked_section(self, i, report=1):
        """What begins with "<![" is a comment up to the next ">", whatever it says."""
        return self.parse_bogus_comment(i, report)

    def _end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            top = self._container()
            self.found.append((text, self.linked, top.tag, top.marks, top.label))
        self.text, self.linked = [], 0

    def _container(self) -> _Element:
        for element in reversed(self.open):
            if element.tag not in INLINE:
                return element
        return self.open[0]

    def _end_head(self, anywhere: bool = False) -> None:
        """Close a head that stands open, as the innermost element or anywhere."""
        if self.open[-1].tag == "head":
            self.open.pop()
        elif anywhere:
            self._close({"head"}, {"template", "svg", "iframe", "object"})

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD:
            self._end_head(tag == "body")
        if tag in VOID:
            if tag in ("br", "hr"):
                self.text.append(" ")
            return
        breaks = tag not in INLINE
        if breaks:
            self._end_block()
        if tag in CLOSES_P:
            self._close({"p"}, {"td", "th", "li", "div", "section", "article", "body", "blockquote", "button"})
        elif tag in CLOSES:
            self._close(*CLOSES[tag])
        above = self.open[-1]
        names, label = [], above.label
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += [m.lower() for m in _NAME.findall(value)]
            elif key == _LABEL and self.labelled:
                label = int(value)
        marks = above.marks
        if names or tag in SECTIONS:
            marks = frozenset(m for m in marks if not m.startswith("near ")) | {f"near {n}" for n in (*names, tag)}
        if breaks or names:
            marks = marks | {f"tag {tag}"} | {f"name {n}" for n in names} | {f"{tag} {n}" for n in names}
        self.open.append(_Element(tag, marks, above.hidden or tag in HIDDEN, above.link or tag == "a", label))

    def _close(self, tags, limits) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in tags:
                del self.open[depth:]
                return
            if self.open[depth].tag in limits:
                return

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        if tag not in INLINE:
            self._end_block()
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        if data.strip():
            self._end_head()
        top = self.open[-1]
        if not top.hidden:
            self.text.append(data)
            if top.link:
                self.linked += len(data.split())


def blocks(html: str | None, labelled: bool = False) -> list[tuple[str, int, str, frozenset, int]]:
    """The leaf blocks of a page. Labels are read where ``labelled`` says so, in drawn layouts and never in pages of a table."""
    parser = Blocks(labelled)
    parser.feed(html or "")
    parser.close()
    parser._end_block()
    return parser.found


_MARK_INDICES: dict[tuple, np.ndarray] = {}


def _step(value: float, steps: tuple) -> int:
    return sum(value >= s for s in steps)


def features(block, place: int, count: int) -> np.ndarray:
    """Indices of the features of a block."""
    text, linked, tag, marks, _ = block
    known = _MARK_INDICES.get((tag, marks))
    if known is None:
        if len(_MARK_INDICES) > 20_000:
            _MARK_INDICES.clear()
        names = [f"own {tag}", "bias", *marks]
        known = _MARK_INDICES[tag, marks] = np.array(sorted({_index(n) for n in names}), np.int64)
    words = text.count(" ") + 1
    last = text[-1]
    own = [
        f"words {_step(words, (2, 4, 8, 16, 32, 64))}",
        f"links {_step(linked / words, (0.01, 0.2, 0.5, 0.9))}",
        f"ends {'stop' if last in '.!?…' else 'letter' if last.isalnum() else 'other'}",
        f"rights {'©' in text}",
        f"place {'first' if place == 0 else 'last' if place == count - 1 else 'inside'}",
    ]
    return np.concatenate((known, np.array([_index(n) for n in own], np.int64)))


class Model:
    """Weights of the main-text label against the other, and of the four transitions."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        self.weights, self.transitions = weights, transitions

    def decode(self, found: list) -> list[int]:
        """The best labels of all blocks of a page."""
        if not found:
            return []
        scores = [float(self.weights[features(b, i, len(found))].sum()) for i, b in enumerate(found)]
        (stay0, into), (out, stay1) = self.transitions.tolist()
        zero, one, back = 0.0, scores[0], []
        for score in scores[1:]:
            from0 = zero + stay0 >= one + out
            from1 = one + stay1 >= zero + into
            back.append((0 if from0 else 1, 1 if from1 else 0))
            zero, one = max(zero + stay0, one + out), max(one + stay1, zero + into) + score
        label = int(one > zero)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def fit(pages: list[list], rounds: int = 200, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Maximum-likelihood weights of labelled pages (lists of blocks), by gradient steps scaled per weight."""
    pages = [p for p in pages if p]
    weights, transitions = np.zeros(_FEATURES), np.zeros((2, 2))
    if not any(block[4] for page in pages for block in page):
        raise ValueError("no page with a labelled article to train on")
    pages = sorted(pages, key=len, reverse=True)
    lengths = np.array([len(p) for p in pages])
    longest, n = int(lengths[0]), len(pages)
    rows, hits, labels = [], [], np.zeros((n, longest), np.int64)
    for p, page in enumerate(pages):
        for i, block in enumerate(page):
            own = features(block, i, len(page))
            rows.append(np.full(len(own), p * longest + i))
            hits.append(own)
            labels[p, i] = block[4]
    rows, hits = np.concatenate(rows), np.concatenate(hits)
    inside = np.arange(longest)[None, :] < lengths[:, None]
    seen = np.bincount(hits, labels.ravel()[rows], _FEATURES)
    pair = inside[:, 1:]
    moves = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            moves[a, b] = (pair & (labels[:, :-1] == a) & (labels[:, 1:] == b)).sum()
    total_w, total_t = np.full(_FEATURES, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        score = np.zeros((n, longest, 2))
        score[:, :, 1] = np.bincount(rows, weights[hits], n * longest).reshape(n, longest)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = score[:, 0]
        for i in range(1, longest):
            k = int((lengths > i).sum())  # pages are in the order of their length
            step = ahead[:k, i - 1, :, None] + transitions
            ahead[:k, i] = np.logaddexp(step[:, 0], step[:, 1]) + score[:k, i]
        for i in range(longest - 2, -1, -1):
            k = int((lengths > i + 1).sum())
            step = transitions + (score[:k, i + 1] + behind[:k, i + 1])[:, None, :]
            behind[:k, i] = np.logaddexp(step[:, :, 0], step[:, :, 1])
        last = ahead[np.arange(n), lengths - 1]
        whole = np.logaddexp(last[:, 0], last[:, 1])
        chance = np.where(inside, np.exp(ahead[:, :, 1] + behind[:, :, 1] - whole[:, None]), 0.0)
        expected = np.bincount(hits, chance.ravel()[rows], _FEATURES)
        both = ahead[:, :-1, :, None] + transitions + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        expected_moves = (np.exp(np.minimum(both, 0.0)) * pair[:, :, None, None]).sum(axis=(0, 1))
        for value, total, gradient in (
            (weights, total_w, (seen - expected) / n - decay * weights),
            (transitions, total_t, (moves - expected_moves) / n - decay * transitions),
        ):
            total += gradient**2
            value += rate * gradient / np.sqrt(total)
    return Model(weights, transitions)


_BODIES = (
    ("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "post-body"), ("div", "entry-content"),
    ("section", "article-body"), ("div", "story"), ("div", "main"), ("div", "text"), ("td", ""), ("div", "page"), ("div", ""),
)
_ASIDES = {
    "menu": (("nav", ""), ("ul", "menu"), ("div", "nav"), ("div", "navbar"), ("div", "breadcrumbs"), ("div", "topmenu"), ("div", "links")),
    "header": (("header", ""), ("div", "header"), ("div", "masthead"), ("div", "site-header"), ("div", "banner"), ("div", "logo")),
    "footer": (("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright"), ("div", "bottom")),
    "sidebar": (("aside", ""), ("div", "sidebar"), ("div", "related"), ("div", "widget"), ("section", "recommended"), ("div", "side-column"), ("div", "popular")),
    "notice": (("div", "cookie-notice"), ("div", "consent"), ("div", "notice"), ("div", "alert"), ("section", "gdpr"), ("div", "popup"), ("dialog", "")),
    "advert": (("div", "ad"), ("div", "ads"), ("aside", "advert"), ("div", "sponsored"), ("div", "promo"), ("section", "advertisement"), ("ins", "adsbygoogle")),
    "form": (("form", ""), ("form", "search"), ("div", "newsletter"), ("form", "login"), ("div", "subscribe"), ("div", "signup"), ("fieldset", "")),
    "comments": (("section", "comments"), ("div", "comments"), ("ul", "comment-list"), ("div", "comment"), ("ol", "commentlist"), ("div", "discussion"), ("div", "responses"), ("section", "reader-comments")),
    "share": (("div", "share"), ("ul", "social"), ("div", "tags"), ("div", "author-bio")),
}


def layout(lines: list[str], others: list[str], seed: int) -> str:
    """A page that sets ``lines`` as its article in a layout drawn from the seed, marked with its label.

    ``others`` gives the prose of adverts, comments and notices, which is as good as the article's.
    """
    draw = random.Random(seed)

    def words(low: int, high: int) -> str:
        own = draw.choice(others).split() or ["more"]
        start = draw.randrange(len(own))
        return escape(" ".join((own[start:] + own[:start])[: draw.randint(low, high)]))

    def wrap(tag: str, name: str, inner: str, label: int | None = None) -> str:
        attributes = f' {draw.choice(("class", "class", "id"))}="{name}"' if name else ""
        attributes += f' {_LABEL}="{label}"' if label is not None else ""
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def aside(kind: str) -> str:
        tag, name = draw.choice(_ASIDES[kind])
        if kind in ("menu", "share", "sidebar") and draw.random() < 0.8:
            links = [f'<a href="/{i}">{words(1, 6)}</a>' for i in range(draw.randint(2, 9))]
            inner = "".join(f"<li>{x}</li>" for x in links) if draw.random() < 0.7 else " | ".join(links)
            inner = f"<ul>{inner}</ul>" if tag not in ("ul", "ol") and inner.startswith("<li") else inner
        elif kind == "form":
            inner = f"<label>{words(1, 4)}</label><input name=q><button>{words(1, 2)}</button>" + f"<p>{words(2, 12)}</p>" * draw.randint(0, 1)
        elif kind == "footer":
            inner = f"&copy; {words(2, 14)}" + f"<p>{words(2, 20)}</p>" * draw.randint(0, 2)
        else:
            each = draw.choice(("p", "div", "p", "span")) if tag not in ("ul", "ol") else "li"
            inner = "".join(f"<{each}>{words(2, 40)}</{each}>" for _ in range(draw.randint(1, 4)))
            if kind in ("notice", "header", "advert") and draw.random() < 0.5:
                inner = words(2, 20)
        return wrap(tag, name, inner, 0)

    tag, name = draw.choice(_BODIES)
    body = []
    for number, line in enumerate(lines):
        text = escape(line)
        if draw.random() < 0.15 and " " in text:
            first, rest = text.split(" ", 1)
            text = f"{first} <{(inline := draw.choice(('b', 'em', 'a')))}>{rest}</{inline}>"
        own = "h1" if number == 0 and draw.random() < 0.7 else draw.choices(("p", "h2", "blockquote", "li", "pre", "div"), (20, 2, 1, 2, 1, 3))[0]
        body.append(f"<ul><li>{text}</li></ul>" if own == "li" else f"<{own}>{text}</{own}>")
        if draw.random() < 0.12:
            body.append(aside(draw.choice(("advert", "share", "form", "sidebar", "notice"))))
    if draw.random() < 0.35:
        body.append(aside("comments"))
    main = wrap(tag, name, "".join(body), 1)
    if tag == "td":
        main = f"<table><tr>{main}</tr></table>"
    around = [aside(k) for k in draw.sample(("menu", "header", "notice", "advert", "form", "sidebar"), draw.randint(2, 5))]
    below = [aside(k) for k in draw.sample(("footer", "comments", "sidebar", "menu", "advert", "share"), draw.randint(1, 4))]
    inner = "".join(around) + main + "".join(below)
    if draw.random() < 0.5:
        inner = f"<div {draw.choice(('class', 'id'))}=\"{draw.choice(('wrapper', 'container', 'page', 'site'))}\">{inner}</div>"
    return f"<html><head><title>{words(2, 8)}</title></head><body>{inner}</body></html>"


# Prose for layouts where no page of the table has any.
_PROSE = (
    "The bridge over the river", "It was built in three summers, and the town paid for it with a tax on salt.",
    "Two of the five arches fell in the flood. They were set up again within a year, this time on oak piles that reach "
    "the rock, and nothing has moved since.",
    "Today it carries only walkers and bicycles.",
    "Visitors find the old toll house at its northern end, where a small exhibition shows drawings, tools and the "
    "letters of the masons; in winter it is open on Sundays.",
)


def labelled_pages(pages: DataFrame, most_pages: int = 400, layouts: int = 3) -> list[list]:
    """Blocks with labels of at most ``most_pages`` pages that mark their article, and of layouts of pages' text.

    The pages are those with the smallest hashes, alike in every run; first only hashes are compared, and then the
    pages up to the last one of them are fetched, each once however often it is repeated. A page is used up to 20,000
    characters. Beside the text of the marked pages, that of others is set in layouts: as many as are missing to
    ``most_pages``, a quarter of it at least. Training needs no more; extraction reads all of every page.
    """
    pages = pages.filter("html is not null").withColumn("_marked", F.lower("html").contains("<article") & (F.length("html") <= 20_000))

    def smallest(rows: DataFrame, most: int) -> list[str]:
        hashed = rows.select(F.xxhash64("html").alias("h"), "html")
        least = [row[0] for row in hashed.select("h").distinct().orderBy("h").limit(most).collect()]
        if not least:
            return []
        wanted = hashed.filter(F.col("h") <= least[-1]).groupBy("h").agg(F.min(F.substring("html", 1, 20_000)).alias("html"))
        return [row["html"] for row in sorted(wanted.collect(), key=lambda row: row["h"])]

    sample, texts = [], []
    for page in smallest(pages.filter("_marked"), most_pages):
        found = [(t, k, tag, marks, int("tag article" in marks and not marks & _NOT_MAIN)) for t, k, tag, marks, _ in blocks(page)]
        # A page without text in its article tells nothing, and labels its real text wrong.
        if any(block[4] for block in found):
            sample.append(found)
            texts.append([block[0] for block in found if block[4]])
    for page in smallest(pages.filter("not _marked"), max(most_pages - len(texts), most_pages // 4)):
        found = [(text, linked, text.count(" ") + 1) for text, linked, *_ in blocks(page)]
        prose = [text for text, linked, words in found if words >= 5 and 2 * linked <= words]
        if lines := prose or [text for text, *_ in found]:
            texts.append(lines)
    if not texts:
        texts = [list(_PROSE)] * max(most_pages // 10, 1)
    others = [line for lines in texts for line in lines]
    made = [
        blocks(layout(lines, others, number * layouts + k), labelled=True)
        for number, lines in enumerate(texts) for k in range(layouts)
    ]
    return sample + made


def extract(pages: DataFrame, model: Model, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``text`` (empty if none) and ``n_chars``.

    Null and empty pages have no text. Pages are read whole, one by one: repeated rows give repeated results, an
    empty table none.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html in batch.column(2).to_pylist():
                found = blocks(html)
                labels = sent.value.decode(found)
                texts.append(" ".join(block[0] for block, label in zip(found, labels) if label))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )

    rows = columns(pages, page_id=id_column, url=url_column, html=html_column)
    rows = rows.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(task, "page_id long, url string, text string, n_chars long")


def main_text(pages: DataFrame, **options) -> DataFrame:
    """Train on a sample of the pages and extract the main text of all."""
    return extract(pages, fit(labelled_pages(columns(pages, html="html"), **options)))
