"""Main text of web pages: boosted trees score DOM nodes, a hierarchical decoder makes the choices consistent.

1. A tolerant parser turns a page into a tree of block elements and the text blocks they own. Scripts, styles,
   comments, forms' controls and the head never give text.
2. Each node has features of its subtree (text, link and tag density), its tag and attribute tokens, depth, siblings and ancestors.
3. Gradient-boosted trees give the odds that a node belongs to the article. They are fitted on the driver to nodes whose label is known without
   looking at names: ``MADE_PAGES`` pages made at random carry their truth (boilerplate in them is told by names, links, form and place, any of
   which may be missing; articles have misleading names), and of ``SAMPLE_PAGES`` pages of the table (``PAGE_NODES`` nodes of each at most)
   those nodes count that tags decide: nav, footer, aside, form; what stands in and outside a page's one article or main element.
4. A node can only be kept if its parent is. The kept set with the highest total log probability is found
   by one pass over the tree from the leaves.

Kept blocks come out in page order: references decoded, white space (by Unicode) inside a block made one space, trimmed, joined by
an empty line. Line breaks (br) are white space. Whole pages are parsed, nothing is capped.

What is boilerplate by neither name, tag, links nor place cannot be told from an article: an advert in plain words under a plain name stays.

Rows: a null or empty html gives an empty text; repeated rows are extracted each; a null url or id is kept; other columns are left behind.
"""

from __future__ import annotations

import html as references
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import boosting
from docloom.llm._common import by_bytes, text_buffer

SAMPLE_PAGES = 150
PAGE_NODES = 100
MADE_PAGES = 450
BLOCK_BYTES = 4 << 20

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template textarea select option button svg math iframe object canvas audio video head title".split())
RAW = set("script style textarea title iframe noscript".split())
#: What can stand in a head without ending it; its end tag is optional.
IN_HEAD = set("base basefont bgsound link meta title style script noscript noframes template head html".split())
BLOCKS = set(
    "html body main article section div nav header footer aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary dialog center hgroup menu".split()
)
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

#: Attribute tokens by what they name (fixed word lists): features, and names for made pages. Those of "vague" stand on articles and boilerplate alike.
KINDS = {
    "advert": "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion outbrain taboola",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pager pagination",
    "side": "sidebar rail widget widgets related recommended recommendations",
    "edge": "footer masthead copyright colophon",
    "comment": "comment comments respond reply replies disqus commentlist",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay banner newsletter subscribe subscription signup paywall toast",
    "share": "share sharing social",
    "form": "form search login register",
    "content": "content article main post entry story body text prose",
    "vague": "more author trending popular side aside page single top tag tags meta byline print follow facebook twitter dialog header head topnav toolbar tabs skip branding logo legal foot contact input reviews discussion commercial promoted topbar",
}
_KIND_OF = {w: k for k, words in KINDS.items() for w in words.split()}
BAD_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu", "fieldset"}
TAG_GROUPS = [{"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "ul", "ol", "dl", "dt", "dd"}, {"div"}, {"section"}, {"article", "main"}, {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "dialog"}, {"table", "tr", "td", "th", "tbody"}, {"blockquote", "pre", "figure", "figcaption"}]

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_NAMES = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TRUTH = re.compile(r'data-truth="([01])"')
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Page:
    """Nodes in page order (parents first) and the text blocks they own."""

    def __init__(self, html: str):
        self.tag, self.parent, self.tokens = ["#page"], [-1], [""]
        self.inline = [0]  # other tags below a node, not in a deeper node
        self.blocks: list[tuple[int, str]] = []
        self.links = [0]
        self.truth: list[str] = [""]  # of made pages: 1 article, 0 boilerplate, else as the parent
        self._parse(html)

    def _parse(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("#page", 0)]  # open elements: name, node
        text: list[str] = []
        link_depth, link_chars, hidden = 0, 0, 0

        def flush():
            nonlocal link_chars
            if text:
                joined = "".join(text)
                if "&" in joined:
                    joined = references.unescape(joined)
                joined = " ".join(joined.split())
                if joined:
                    self.blocks.append((stack[-1][1], joined))
                    self.links[stack[-1][1]] += link_chars
                text.clear()
            link_chars = 0

        def pop_to(k: int):
            nonlocal link_depth, hidden
            flush()
            for name, _ in stack[k:]:
                link_depth -= name == "a"
                hidden -= name in HIDDEN
            del stack[k:]

        def leave_head(name: str):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "head":
                    pop_to(k)
                    break
                if stack[k][0] in HIDDEN and name != "body":
                    break  # in a template, say

        at, n = 0, len(html)
        while at < n:
            m = _TAG.search(html, at)
            end = m.start() if m else n
            if hidden and stack[-1][0] == "head" and html[at:end].strip():
                leave_head("")
            if end > at and not hidden:
                piece = html[at:end]
                text.append(piece)
                if link_depth:
                    link_chars += len(piece)
            if not m:
                break
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:  # end tag
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        if name in BLOCKS or any(s in BLOCKS for s, _ in stack[k:]):
                            pop_to(k)
                        else:
                            for s, _ in stack[k:]:
                                link_depth -= s == "a"
                                hidden -= s in HIDDEN
                            del stack[k:]
                        break
                    if stack[k][0] in BLOCKS and name not in BLOCKS:
                        break  # an inline end tag does not close a block
                continue
            if hidden and name not in IN_HEAD:
                leave_head(name)
            node = stack[-1][1]
            if name in VOID:
                self.inline[node] += 1
                text.append(" ")
                continue
            if name in RAW:
                close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                stop = html.find(">", close.end()) if close else -1
                at = stop + 1 if stop >= 0 else n
                self.inline[node] += 1
                continue
            if name in BLOCKS:
                if name in CLOSES_P:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == "p":
                            pop_to(k)
                            break
                        if stack[k][0] in BLOCKS:
                            break
                if name in SAME_CLOSES:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in SAME_CLOSES[name]:
                            pop_to(k)
                            break
                        if stack[k][0] in SCOPES[name]:
                            break
                flush()
                attributes = m[3] or m[6] or ""
                self.tag.append(name)
                self.parent.append(stack[-1][1])
                self.tokens.append(" ".join(a or b or c for _, a, b, c in _NAMES.findall(attributes)) if "=" in attributes else "")
                self.inline.append(0)
                self.links.append(0)
                self.truth.append(found[1] if "data-truth" in attributes and (found := _TRUTH.search(attributes)) else "")
                stack.append((name, len(self.tag) - 1))
            else:
                self.inline[node] += 1
                attributes = m[3] or m[6] or ""
                if attributes.endswith("/"):
                    continue
                stack.append((name, node))
                link_depth += name == "a"
                hidden += name in HIDDEN
        flush()


def kinds_of(tokens: str) -> set[str]:
    return {_KIND_OF[w] for t in _TOKEN.findall(tokens) if (w := t.lower()) in _KIND_OF} if tokens else set()


N_FEATURES = 14 + len(TAG_GROUPS) + 2 * len(KINDS) + 3


def features(page: Page) -> np.ndarray:
    n = len(page.tag)
    parent = page.parent
    own, words, stops = [0] * n, [0] * n, [0] * n
    for node, text in page.blocks:
        own[node] += len(text)
        words[node] += text.count(" ") + 1
        stops[node] += text.count(".") + text.count(",")
    chars, links, tags, ps, word, stop = own[:], page.links[:], [1 + x for x in page.inline], [int(t == "p") for t in page.tag], words[:], stops[:]
    for v in range(n - 1, 0, -1):
        u = parent[v]
        chars[u] += chars[v]
        links[u] += links[v]
        tags[u] += tags[v]
        ps[u] += ps[v]
        word[u] += word[v]
        stop[u] += stop[v]
    children: list[list[int]] = [[] for _ in range(n)]
    for v in range(1, n):
        children[parent[v]].append(v)
    tags_below = [Counter(page.tag[s] for s in c) for c in children]
    depth = [0] * n
    out = np.zeros((n, N_FEATURES))
    total = max(chars[0], 1)
    kinds = [kinds_of(t) for t in page.tokens]
    above_kinds: list[set[str]] = [set()] * n
    above = [(0, 0, 0)] * n  # below: an article, a boilerplate tag, a header outside articles
    names = list(KINDS)
    for v in range(n):
        u = parent[v]
        if u >= 0:
            depth[v] = depth[u] + 1
            above_kinds[v] = above_kinds[u] | kinds[v] if kinds[v] else above_kinds[u]
            a, b, c = above[u]
            t = page.tag[v]
            above[v] = (a or t in ("article", "main"), b or t in BAD_TAGS, c or (t == "header" and not a))
        sib = children[u] if u >= 0 else [v]
        row = out[v]
        same = tags_below[u][page.tag[v]] / len(sib) if u >= 0 else 1.0
        mean = (chars[u] - own[u]) / len(sib) if u >= 0 else chars[v]
        row[:14] = (
            depth[v], np.log1p(own[v]), np.log1p(chars[v]), links[v] / max(chars[v], 1), np.log1p(tags[v]), chars[v] / tags[v], np.log1p(ps[v]), np.log1p(len(sib)),
            0.0, same, np.log1p(mean), stop[v] / max(word[v], 1), chars[v] / max(word[v], 1), chars[v] / total,
        )
        for k, group in enumerate(TAG_GROUPS):
            if page.tag[v] in group:
                row[14 + k] = 1
        at = 14 + len(TAG_GROUPS)
        for kind in kinds[v]:
            row[at + names.index(kind)] = 1
        for kind in above_kinds[v]:
            row[at + len(KINDS) + names.index(kind)] = 1
        row[-3:] = above[v]
    for c in children:
        for k, v in enumerate(c):
            out[v, 8] = k / len(c)
    return out


def with_text(page: Page) -> np.ndarray:
    has = np.zeros(len(page.tag), bool)
    for v, _ in page.blocks:
        has[v] = True
    for v in range(len(has) - 1, 0, -1):
        has[page.parent[v]] |= has[v]
    return has


def told_by_tags(page: Page) -> np.ndarray:
    """1 article, 0 boilerplate, -1 unknown, by tags alone: names are not looked at."""
    n, has = len(page.tag), with_text(page)
    mains = [v for v in range(1, n) if page.tag[v] in ("article", "main") and has[v]]
    one = [v for v in mains if page.tag[v] == "article"] or mains
    label, inside, holds = np.full(n, -1), np.zeros(n, bool), np.zeros(n, bool)
    if len(one) == 1:
        v = one[0]
        while v >= 0:  # what holds the article has to be kept
            holds[v], v = True, page.parent[v]
    for v in range(1, n):
        u = page.parent[v]
        inside[v] = inside[u] or (len(one) == 1 and v == one[0])
        if page.tag[v] in BAD_TAGS or (page.tag[v] == "header" and not inside[v]) or label[u] == 0:
            label[v] = 0
        elif inside[v]:  # a box with a name may be anything
            label[v] = -1 if label[u] < 0 and v != one[0] or page.tokens[v] and page.tag[v] not in ("article", "main") else 1
        elif len(one) == 1:
            label[v] = 1 if holds[v] else 0
    label[~has] = -1
    return label


def made(page: Page) -> np.ndarray:
    """The labels that a made page carries."""
    label = np.full(len(page.tag), 1)
    for v in range(1, len(label)):
        label[v] = int(page.truth[v]) if page.truth[v] else label[page.parent[v]]
    label[~with_text(page)] = -1
    return label


def made_page(r: random.Random) -> str:
    """A page from a random template, which carries its truth."""
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
    some = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    sentence = lambda: some(1, 25).capitalize() + r.choice([".", ".", "", ", " + some(2, 6) + "."])
    link = lambda a=1, b=4: f'<a href="/{word()}">{some(a, b)}</a>'

    def prose() -> str:
        parts = [sentence() for _ in range(r.choice([1, 1, 2, 4, 8]))]
        if r.random() < 0.2:
            parts.insert(r.randint(0, len(parts)), f"{some(3, 9)} {link(1, 3)} {some(2, 9)}")
        return " ".join(parts)

    def attribute(value: str) -> str:
        return f' {r.choice(["class", "class", "id"])}="{value}"' if value else ""

    def good() -> str:
        kind = r.random()
        return attribute("" if kind < 0.5 else r.choice(KINDS["content"].split()) if kind < 0.65 else r.choice(KINDS["vague"].split()) if kind < 0.88 else word())

    def bad(kind: str, sure: bool) -> str:
        strong = r.choice(["", "", word() + " ", word() + "-"]) + r.choice(KINDS[kind].split()) + r.choice(["", "", "-" + word()])
        chance = r.random()
        return attribute(strong if sure or chance < 0.5 else "" if chance < 0.7 else r.choice(KINDS["vague"].split()) if chance < 0.9 else word())

    def links() -> str:
        n = r.randint(2, 9)
        return r.choice([lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>", lambda: " ".join(link() for _ in range(n)), lambda: "".join(f"<p>{link(1, 7)}</p>" for _ in range(n)), lambda: " | ".join(link() for _ in range(n))])()

    def box(kind: str, inner: str, sure: bool, tags: str = "div div section") -> str:
        tag = r.choice(tags.split())
        return f'<{tag} data-truth="0"{bad(kind, sure)}>{inner if tag != "p" else some(2, 14)}</{tag}>'  # a p cannot hold blocks

    talk = lambda: "".join(f"<div><p>{some(1, 2)}</p><p>{prose()}</p></div>" for _ in range(r.randint(1, 6)))
    stuff = lambda: r.choice([lambda: f"<p>{sentence()}</p>", lambda: f"<div>{some(2, 9)}</div>", sentence, lambda: f"<p>{prose()}</p>", links])()
    plain = lambda: "".join(stuff() for _ in range(r.randint(1, 3)))
    anywhere = [
        lambda: f'<nav data-truth="0"{bad("menu", False)}>{links()}</nav>',
        lambda: box("menu", links(), False, "div ul div"),
        lambda: f'<aside data-truth="0"{bad("side", False)}>{plain()}</aside>',
        lambda: box("side", links(), False),
        lambda: box("side", plain(), True),
        lambda: box("advert", plain(), True, "div div p section"),
        lambda: box("notice", plain(), True, "div div p"),
        lambda: box("share", links(), False, "div ul"),
        lambda: box("comment", talk(), True, "div section ol"),
        lambda: f'<form data-truth="0"{bad("form", False)}><label>{some(1, 4)}</label>{plain()}</form>',
    ]
    outside = [
        *anywhere,
        lambda: f'<header data-truth="0"{bad("edge", False)}>{r.choice([some(1, 5), links(), "<h1>" + some(1, 4) + "</h1>" + links()])}</header>',
        lambda: box("edge", r.choice([links(), some(2, 9), plain()]), True),
        lambda: box("advert", some(2, 14), False),
    ]

    def piece() -> str:
        return r.choice([
            *[lambda: f"<p{good()}>{prose()}</p>"] * 6, lambda: f"<h{r.randint(2, 4)}{good()}>{some(1, 8)}</h2>", *[lambda: f"<ul{good()}>" + "".join(f"<li>{r.choice([sentence(), some(1, 3), f'{some(2, 6)} {link(1, 2)}'])}</li>" for _ in range(r.randint(1, 8))) + "</ul>"] * 2,
            lambda: f"<blockquote{good()}><p>{prose()}</p></blockquote>", lambda: f"<pre>{some(3, 30)}</pre>", lambda: f"<figure><figcaption>{sentence()}</figcaption></figure>", lambda: f"<div{good()}>{prose()}</div>",
            lambda: f"<div{good()}>" + "".join(f"<p{good()}>{prose()}</p>" for _ in range(r.randint(1, 4))) + "</div>", lambda: f"<section{good()}><h2>{some(1, 6)}</h2><p>{prose()}</p></section>",
            lambda: "<table>" + "".join(f"<tr><td>{some(1, 3)}</td><td>{some(1, 6)}</td></tr>" for _ in range(r.randint(1, 5))) + "</table>", lambda: f'<p class="{r.choice(["byline", "author", "meta"])}">{some(2, 5)}</p>',
        ])()

    body = [r.choice([f"<h1{good()}>{some(2, 9)}</h1>", f"<header{good()}><h1>{some(2, 9)}</h1><p>{some(2, 5)}</p></header>", ""])]
    for _ in range(r.choice([1, 2, 4, 8, 12, 60] if r.random() < 0.3 else [2, 4, 8])):
        body.append(piece())
        if r.random() < 0.15:
            body.append(r.choice(anywhere)())
    inner = "".join(body)
    tag = r.choice(["article", "article", "main", "div", "div", "both", "section"])
    main = f'<main data-truth="1"{good()}><article{good()}>{inner}</article></main>' if tag == "both" else f'<{tag} data-truth="1"{good()}>{inner}</{tag}>'
    before, after = "".join(r.choice(outside)() for _ in range(r.randint(0, 3))), "".join(r.choice(outside)() for _ in range(r.randint(0, 4)))
    footer = r.choice(["", f'<footer data-truth="0">{sentence()}', f'<footer data-truth="0">{links()}{sentence()}</footer>'])
    if r.random() < 0.3:
        return f'<html><body><div data-truth="1"{good()}>{before}{main}{after}</div>{footer}</body></html>'
    return f"<html><body>{before}{main}{after}{footer}</body></html>"


def fit(known: list[tuple[np.ndarray, np.ndarray]], pages: int = MADE_PAGES) -> boosting.Trees:
    """known: features and labels of sampled nodes."""
    r = random.Random(11)
    x, y = [k[0] for k in known], [k[1] for k in known]
    for _ in range(pages):
        page = Page(made_page(r))
        label = made(page)
        x.append(features(page)[label >= 0])
        y.append(label[label >= 0])
    return boosting.fit(np.concatenate(x), np.concatenate(y).astype(float), trees=50)


def decode(parent: list[int], log_odds: np.ndarray) -> np.ndarray:
    """The kept nodes: the set closed under parents with the highest total log probability; the page itself is kept."""
    n = len(parent)
    keep, drop = -np.logaddexp(0, -log_odds), -np.logaddexp(0, log_odds)
    keep[0], drop[0] = 0.0, -np.inf
    with_children, without = keep.tolist(), drop.tolist()
    for v in range(n - 1, 0, -1):
        u = parent[v]
        with_children[u] += max(with_children[v], without[v])
        without[u] += without[v]
    kept = np.zeros(n, bool)
    kept[0] = True
    for v in range(1, n):
        kept[v] = kept[parent[v]] and with_children[v] >= without[v]
    return kept


def extract(htmls: list[str], trees: boosting.Trees) -> list[str]:
    pages = [Page(h) for h in htmls]
    odds = trees.log_odds(np.concatenate([features(p) for p in pages])) if pages else np.zeros(0)
    out, at = [], 0
    for p in pages:
        kept = decode(p.parent, odds[at : at + len(p.tag)])
        at += len(p.tag)
        out.append("\n\n".join(t for v, t in p.blocks if kept[v]))
    return out


def sample_nodes(pages: DataFrame, sample: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of nodes that tags decide, from up to ``sample`` different pages by the order of a hash; copies of a page count once.
    Tasks parse the pages and send numbers, of ``PAGE_NODES`` nodes a page at most."""
    known = pages.where("length(html) > 0").withColumn("h", F.xxhash64("html"))
    chosen = known.select("h").distinct().orderBy("h").limit(sample)
    rows = known.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("html").alias("html"))  # ``sample`` numbers

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            cells = []
            for html in part.column(1).to_pylist():
                page = Page(html)
                label = told_by_tags(page)
                at = np.flatnonzero(label >= 0)
                at = at[np.linspace(0, len(at) - 1, min(len(at), PAGE_NODES)).astype(int)] if len(at) else at
                cells.append((features(page)[at].tobytes(), label[at].astype(np.int8).tobytes()))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([c[k] for c in cells], pa.binary()) for k in (0, 1))], ["h", "x", "y"])

    found = rows.mapInArrow(run, "h long, x binary, y binary").orderBy("h").collect()
    return [(np.frombuffer(f.x, np.float64).reshape(-1, N_FEATURES), np.frombuffer(f.y, np.int8)) for f in found if f.y]


def main_text(pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) per row."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    trees = fit(sample_nodes(pages.select(html.alias("html")), sample))
    kinds = pages.schema["page_id"].dataType.simpleString(), pages.schema["url"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            _, offsets = text_buffer(part.column(2))
            for i, j in by_bytes(offsets, BLOCK_BYTES):
                texts = extract(part.column(2).slice(i, j - i).to_pylist(), trees)
                yield pa.RecordBatch.from_arrays([part.column(0).slice(i, j - i), part.column(1).slice(i, j - i), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    out = pages.select("page_id", "url", html.alias("html")).mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
