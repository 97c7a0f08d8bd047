"""Main text of web pages: boosted trees over the nodes of the page's tree, decoded from the top down.

Every element gets features of its own (tag, attribute tokens, depth), of its subtree (text, density, share
of links, paragraphs, form fields), of its siblings and of its ancestors. Boosted trees give the odds that
it belongs to the main text or leads to it. Decoding then picks the most likely set of nodes in which no node is kept
below a dropped one: a node is either dropped with all below it or kept, with the best choice for each child.

The trees are fitted on made-up pages of many layouts (`sample_pages`), whose main text is known.

Cases: a null, empty or textless page gives an empty text. Unclosed and stray tags are repaired as browsers do
in the common cases. Repeated rows are handled one by one. Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm import trees

# A tag's start, and all of it where no < stands in it; that try never looks beyond the next <.
_OPENING = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)(?:((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>)?""")
_SIGNS = re.compile(r"""[>"']""")
_NAMES = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)

#: HTML's elements without content, with raw content, and those that stand within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A new one of these ends an open one of the same group; all blocks end an open paragraph.
SAME = {"li": "li", "dt": "dt", "dd": "dt", "tr": "tr", "td": "td", "th": "td", "option": "option"}

TAGS = (
    ("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("div",), ("section",), ("article", "main"), ("nav", "menu"), ("header",),
    ("footer",), ("aside",), ("ul", "ol", "dl"), ("li", "dt", "dd"), ("a",), ("form", "input", "button", "select", "textarea", "label", "fieldset", "option"),
    ("script", "style", "noscript", "template", "iframe", "svg", "canvas", "object"), ("head", "title", "meta", "link", "base"),
    ("table", "tr", "td", "th", "tbody", "thead", "caption"), ("figure", "figcaption", "img", "picture", "video"), ("blockquote", "pre", "code"), ("html", "body"),
)
_TAG = {name: i for i, group in enumerate(TAGS) for name in group}
#: Words in class, id or role, by what they tell.
WORDS = {
    "content": "content article body post entry story main text prose",
    "menu": "nav menu navbar breadcrumb breadcrumbs navigation pagination pager toolbar tabs",
    "header": "header masthead topbar logo brand branding banner",
    "footer": "footer copyright colophon legal imprint foot",
    "side": "sidebar side aside rail widget widgets secondary complementary related recommended popular trending teaser",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense adslot commercial",
    "notice": "notice cookie cookies consent gdpr alert privacy disclaimer popup modal overlay warning message",
    "comment": "comment comments reply replies respond discussion disqus reader feedback",
    "share": "share social sharing follow tags tag meta byline author",
    "form": "form newsletter subscribe signup login search subscription",
}
_GROUPS = list(WORDS)
_OF_WORD = {w: i for i, words in enumerate(WORDS.values()) for w in words.split()}
#: What a node inherits from its ancestors: word groups, and the groups of telling tags.
_TELLING = {name: i for i, name in enumerate(("menu", "header", "footer", "side", "form", "content"))}
_TELLING_TAG = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "article": "content", "main": "content"}


@lru_cache(maxsize=50_000)
def _groups(attributes: str) -> tuple[int, ...]:
    """Which word groups the attributes name; the last number stands for hidden elements."""
    found = set()
    for values in _NAMES.findall(attributes):
        for word in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", "".join(values)):
            if (group := _OF_WORD.get(word.lower())) is not None:
                found.add(group)
    if _HIDDEN.search(attributes):
        found.add(len(_GROUPS))
    return tuple(sorted(found))


@dataclass
class Page:
    """Elements in page order (parents before children) and the texts between tags; owner -1 is the end of a block."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    pieces: list[tuple[int, str]] = field(default_factory=list)


class _TagEnds:
    """Where tags end. What is found out about a sign (>, ", ') is kept, so a broken page is not walked again for each tag."""

    def __init__(self, source: str):
        self.source = source
        self.last_close = source.rfind(">")
        self.known: dict[int, int] = {}
        self.looked, self.sign = 0, -1

    def _next_sign(self, at: int) -> int:
        if not self.looked <= at <= self.sign:
            found = _SIGNS.search(self.source, at)
            self.looked, self.sign = at, found.start() if found else len(self.source)
        return self.sign

    def tag(self, at: int) -> int:
        """Place of the > that ends a tag whose attributes start at `at`; -1 if none does. Quoted ones don't."""
        if at > self.last_close:
            return -1
        sign, passed, end = self._next_sign(at), [], -1
        while sign <= self.last_close:
            if (known := self.known.get(sign)) is not None:
                end = known
                break
            passed.append(sign)
            if self.source[sign] == ">":
                end = sign
                break
            closing = self.source.find(self.source[sign], sign + 1)
            if closing < 0:
                break
            found = _SIGNS.search(self.source, closing + 1)
            if not found:
                break
            sign = found.start()
        self.known.update(dict.fromkeys(passed, end))
        return end

    def declaration(self, at: int) -> int:
        return self.source.find(">", at) if at <= self.last_close else -1


class _Open:
    """The open elements, outermost first, with the depths of each name and of all blocks at hand."""

    def __init__(self):
        self.nodes: list[int] = []
        self.names: list[str] = []
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: int, tag: str) -> None:
        depth = len(self.nodes)
        self.nodes.append(node)
        self.names.append(tag)
        self.depths.setdefault(tag, []).append(depth)
        if tag not in INLINE:
            self.blocks.append(depth)

    def close(self, depth: int) -> None:
        while len(self.nodes) > depth:
            self.nodes.pop()
            tag = self.names.pop()
            self.depths[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()

    def end_tag(self, tag: str) -> None:
        """An end tag that matches nothing is passed over; an inline one doesn't close a block."""
        depths = self.depths.get(tag)
        if depths and not (tag in INLINE and self.blocks[-1] > depths[-1]):
            self.close(depths[-1])

    def start_block(self, tag: str) -> None:
        """A new block ends an open paragraph, or an open element of its own group."""
        group, inner = SAME.get(tag), self.blocks[-1]
        if inner and (self.names[inner] == "p" or (group and SAME.get(self.names[inner]) == group)):
            self.close(inner)


def parse(source: str) -> Page:
    page, stack, ends = Page(), _Open(), _TagEnds(source)
    tags, parents, attributes, pieces = page.tags, page.parents, page.attributes, page.pieces

    def open_element(tag: str, given: str) -> int:
        tags.append(tag)
        parents.append(stack.nodes[-1] if stack.nodes else -1)
        attributes.append(given)
        return len(tags) - 1

    stack.push(open_element("#root", ""), "#root")
    # Text runs from `begin`; the next tag is looked for from `at`.
    begin = at = 0
    size = len(source)
    while (start := source.find("<", at)) >= 0:
        opening = _OPENING.match(source, start)
        if opening:
            end = opening.end() - 1 if opening[3] is not None else ends.tag(opening.end())
        elif source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            end = end + 2 if end >= 0 else size - 1
        elif source.startswith(("<!", "<?"), start):
            end = ends.declaration(start + 2)
        else:
            end = -1
        if end < 0:
            at = start + 1
            continue
        if start > begin:
            pieces.append((stack.nodes[-1], source[begin:start]))
        begin = at = end + 1
        if not opening:
            continue
        tag, given = opening[2].lower(), source[opening.end(2) : end]
        inline = tag in INLINE
        if not inline:
            pieces.append((-1, ""))
        if opening[1]:
            stack.end_tag(tag)
            continue
        if not inline and tag != "br":
            stack.start_block(tag)
        node = open_element(tag, given)
        if tag in RAW:
            closing = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, at)
            pieces.append((node, source[at : closing.start() if closing else size]))
            begin = at = closing.end() if closing else size
        elif tag not in VOID and not given.endswith("/"):
            stack.push(node, tag)
    if begin < size:
        pieces.append((stack.nodes[-1], source[begin:]))
    pieces.append((-1, ""))
    return page


_MARKS = re.compile(r"[.,;:!?]")


def features(page: Page) -> np.ndarray:
    """One row per element. Plain lists while walking the tree, as single numbers are slow in arrays."""
    tags, parents, count = page.tags, page.parents, len(page.tags)
    chars, marks, links, start = [0] * count, [0] * count, [0] * count, [-1] * count
    depth, order, children, linked = [0] * count, [0] * count, [0] * count, [False] * count
    kind = [_TAG.get(t, len(TAGS)) for t in tags]
    named, inherited = [0] * count, [0] * count
    groups = len(_GROUPS)
    for i in range(count):
        for group in _groups(page.attributes[i]) if page.attributes[i] else ():
            named[i] |= 1 << group
        up = parents[i]
        if up >= 0:
            depth[i], order[i] = depth[up] + 1, children[up]
            children[up] += 1
            inherited[i] = inherited[up] | named[up] & ((1 << groups) - 1)
            if (telling := _TELLING_TAG.get(tags[up])) is not None:
                inherited[i] |= 1 << groups + _TELLING[telling]
            linked[i] = linked[up] or tags[i] == "a"
    seen = 0
    for owner, text in page.pieces:
        if owner >= 0 and (length := len(text.strip())) and tags[owner] not in RAW:
            chars[owner] += length
            marks[owner] += len(_MARKS.findall(text))
            if linked[owner]:
                links[owner] += length
            if start[owner] < 0:
                start[owner] = seen
            seen += length
    direct = list(chars)
    nodes = [1] * count
    paragraphs, items, fields = ([int(k == which) for k in kind] for which in (0, 10, 12))
    for i in range(count - 1, 0, -1):
        up = parents[i]
        chars[up] += chars[i]
        marks[up] += marks[i]
        links[up] += links[i]
        nodes[up] += nodes[i]
        paragraphs[up] += paragraphs[i]
        items[up] += items[i]
        fields[up] += fields[i]
        if start[i] >= 0 and (start[up] < 0 or start[i] < start[up]):
            start[up] = start[i]
    table = np.array([depth, children, order, chars, direct, links, nodes, paragraphs, marks, items, fields, start], dtype=np.float64)
    depth_, children_, order_, chars_, direct_, links_, nodes_, paragraphs_, marks_, items_, fields_, start_ = table
    above = np.maximum(np.array(parents), 0)
    siblings, total, share = children_[above], max(chars_[0], 1.0), links_ / np.maximum(chars_, 1)
    columns = [
        depth_, children_, order_, siblings, np.log1p(chars_), np.log1p(direct_), share, np.log1p(nodes_), chars_ / nodes_, paragraphs_,
        np.log1p(marks_), chars_ / total, np.maximum(start_, 0) / total, items_, fields_, share[above], np.log1p(chars_[above] / np.maximum(siblings, 1)),
        chars_ / np.maximum(chars_[above], 1), paragraphs_[above],
    ]
    tag_flags = np.array(kind)[:, None] == np.arange(len(TAGS) + 1)
    word_flags = (np.array(named)[:, None] >> np.arange(groups + 1)) & 1
    from_above = (np.array(inherited)[:, None] >> np.arange(groups + len(_TELLING))) & 1
    return np.concatenate([np.array(columns).T, tag_flags, word_flags, from_above], axis=1)


def decode(logits: np.ndarray, parents: list[int]) -> np.ndarray:
    """The likeliest choice in which whatever is kept has only kept ancestors."""
    below, dropped = (-np.logaddexp(0, -logits)).tolist(), (-np.logaddexp(0, logits)).tolist()
    for i in range(len(parents) - 1, 0, -1):
        below[parents[i]] += max(below[i], dropped[i])
        dropped[parents[i]] += dropped[i]
    kept = [True] * len(parents)
    for i in range(1, len(parents)):
        kept[i] = kept[parents[i]] and below[i] > dropped[i]
    return np.array(kept)


def kept_text(page: Page, kept: np.ndarray) -> str:
    """The texts of kept elements: white space in a block becomes one space, blocks are joined by one."""
    blocks, now = [], []
    for owner, text in page.pieces:
        if owner < 0:
            if now:
                blocks.append(" ".join(html.unescape("".join(now)).split()))
                now = []
        elif kept[owner] and page.tags[owner] not in RAW:
            now.append(text)
    return " ".join(b for b in blocks if b)


def _words(draw: random.Random, least: int, most: int) -> str:
    parts = ("ka", "lo", "mi", "tur", "es", "an", "ve", "dor", "in", "sha", "bel", "o", "qui", "ren")
    count = draw.randint(least, most)
    out = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) + ("," if draw.random() < 0.06 else "") for _ in range(count)]
    for i in range(0, count, draw.randint(6, 15)):
        out[i] = out[i].capitalize()
        if i:
            out[i - 1] = out[i - 1].rstrip(",") + "."
    return " ".join(out)


def _any(draw: random.Random, *options: str) -> str:
    return draw.choice(options)


def sample_page(draw: random.Random) -> str:
    """A made-up page. Elements of the main text carry the attribute data-main, others don't; what leads to the main text is told from that."""

    def links(many: int) -> str:
        return "".join(f'<li><a href="/{i}">{_words(draw, 1, 3)}</a></li>' for i in range(many))

    def block(tag: str, names: tuple[str, ...], inner: str) -> str:
        how = draw.choice(("class", "id", "class", ""))
        given = f' {how}="{draw.choice(names)}"' if how and names and (tag == "div" or draw.random() < 0.5) else ""
        if tag == "div" and not given and names:
            given = f' class="{draw.choice(names)}"'
        return f"<{tag}{given}>{inner}</{tag}>"

    def menu() -> str:
        return block(_any(draw, "nav", "div", "nav"), ("nav", "menu", "navbar", "main-nav"), f"<ul>{links(draw.randint(2, 9))}</ul>")

    def advert() -> str:
        inner = _any(draw, _words(draw, 4, 30), f"<p>{_words(draw, 4, 30)}</p>", f'<a href="/x">{_words(draw, 3, 12)}</a>')
        return block("div", ("ad", "ads", "advert", "ad-slot", "sponsored", "promo"), inner)

    def notice() -> str:
        return block("div", ("notice", "cookie-notice", "consent", "alert", "gdpr"), f"<p>{_words(draw, 6, 40)}</p>" + _any(draw, "", "<button>Ok</button>"))

    def form() -> str:
        return block("form", ("newsletter", "search", "login"), f'<label>{_words(draw, 1, 4)}</label><input name="q"><button>{_words(draw, 1, 2)}</button>')

    def side() -> str:
        inner = f"<h3>{_words(draw, 1, 4)}</h3>" + _any(draw, f"<ul>{links(draw.randint(2, 6))}</ul>", f"<p>{_words(draw, 8, 50)}</p>")
        return block(_any(draw, "aside", "div"), ("sidebar", "related", "widget", "side", "popular"), inner)

    def comments() -> str:
        each = "".join(
            _any(draw, f'<li class="comment"><p>{_words(draw, 3, 60)}</p></li>', f'<div class="comment"><p>{_words(draw, 3, 60)}</p></div>')
            for _ in range(draw.randint(1, 6))
        )
        return block(_any(draw, "section", "div"), ("comments", "comment-list", "discussion", "replies"), f"<h3>{_words(draw, 1, 3)}</h3>{each}").replace(
            "<section>", '<section class="comments">'
        )

    def footer() -> str:
        return block(_any(draw, "footer", "div", "footer"), ("footer", "site-footer", "copyright"), f"&copy; {_words(draw, 1, 4)} &middot; {_words(draw, 2, 20)}" + _any(draw, "", f"<ul>{links(3)}</ul>"))

    def header() -> str:
        return block(_any(draw, "header", "div"), ("header", "masthead", "site-header"), _any(draw, f"<h2>{_words(draw, 1, 4)}</h2>", f'<a href="/">{_words(draw, 1, 3)}</a>', f"<p>{_words(draw, 2, 10)}</p>"))

    def paragraph() -> str:
        body = _words(draw, 1, draw.choice((4, 20, 60, 150)))
        return draw.choice((
            f"<p data-main>{body}</p>", f"<p data-main>{body}</p>", f"<p data-main>{body}</p>", f"<p data-main><b data-main>{body}<br><p data-main>{_words(draw, 3, 80)}</p>",
            f'<p data-main>{body} <a data-main href="/y">{_words(draw, 1, 3)}</a> <em data-main>{_words(draw, 1, 5)}</em></p>',
            f"<h2 data-main>{_words(draw, 1, 7)}</h2><p data-main>{body}</p>", f"<blockquote data-main><p data-main>{body}</p></blockquote>",
            "<ul data-main>" + "".join(f"<li data-main>{_words(draw, 1, 12)}</li>" for _ in range(draw.randint(1, 5))) + "</ul>",
            f"<figure data-main><img data-main src='/i'><figcaption data-main>{_words(draw, 2, 12)}</figcaption></figure><p data-main>{body}</p>",
            f"<table data-main><tr data-main><td data-main>{_words(draw, 1, 4)}</td><td data-main>{_words(draw, 1, 4)}</td></tr></table>",
        ))

    inside = [f"<h1 data-main>{_words(draw, 1, 14)}</h1>" if draw.random() < 0.9 else ""]
    for _ in range(draw.choice((1, 2, 4, 8, 20))):
        inside.append(paragraph())
        if draw.random() < 0.08:
            inside.append(_any(draw, advert(), side(), notice(), form(), '<script>var a="<p>";</script>', f'<div class="share"><ul>{links(3)}</ul></div>'))
    if draw.random() < 0.3:
        inside.append(comments())
    shape = draw.random()
    body = "".join(inside)
    if shape < 0.55:
        main = f"<article>{body}</article>"
    elif shape < 0.7:
        main = f"<main>{body}</main>" if draw.random() < 0.5 else f"<main><article>{body}</article></main>"
    else:
        names = ("content", "post-body", "article-body", "entry-content", "story", "main-content")
        main = f'<div {_any(draw, "class", "id")}="{draw.choice(names)}">{body}</div>'
        if draw.random() < 0.4:
            main = f'<div class="wrapper">{main}</div>'
    before = [f() for f in (header, menu, advert, notice, form, side) if draw.random() < 0.5]
    after = [f() for f in (comments, side, form, advert, notice, menu, footer, footer) if draw.random() < 0.4]
    draw.shuffle(before)
    head = f'<head><meta charset="utf-8"><title>{_words(draw, 1, 9)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
    page = f'<!DOCTYPE html><html lang="en">{head}<body>{"".join(before)}{main}{"".join(after)}'
    return page + ("" if draw.random() < 0.15 else "</body></html>")


def model(pages: int = 500, seed: int = 3) -> trees.Forest:
    """Boosted trees fitted on made-up pages."""
    draw = random.Random(seed)
    rows, labels = [], []
    for _ in range(pages):
        page = parse(sample_page(draw))
        wanted = np.array(["data-main" in a for a in page.attributes], dtype=float)
        for i in range(len(wanted) - 1, 0, -1):
            wanted[page.parents[i]] = max(wanted[page.parents[i]], wanted[i])
        rows.append(features(page))
        labels.append(wanted)
    return trees.fit(np.concatenate(rows), np.concatenate(labels))


def _extracted(forest: trees.Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                pages = [parse(h or "") for h in batch.column(2).to_pylist()]
                rows = [features(p) for p in pages]
                ends = np.cumsum([len(r) for r in rows])[:-1]
                logits = np.split(forest.logits(np.concatenate(rows)), ends) if rows else []
                texts = [kept_text(p, decode(own, p.parents)) for p, own in zip(pages, logits, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return run


def extract(pages: DataFrame, forest: trees.Forest | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    slim = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return slim.mapInArrow(_extracted(forest or model()), "page_id bigint, url string, text string, n_chars bigint")
