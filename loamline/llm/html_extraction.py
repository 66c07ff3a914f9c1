"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded along the tree.

A page is parsed into block elements and runs of text.  Each of these is a node with features of its subtree (text, share of links, paragraphs,
sentences), its attribute tokens and tag, those of its ancestors, its depth and its siblings.  Boosted oblivious trees give
the chance that a node's subtree holds main text.  Decoding picks, for the whole page at once, the likeliest labels among
those where no node is main below a node that is not; the text of the runs left is the page's main text.

The trees are trained on pages that :func:`example` makes by chance from a seed, with layouts of many kinds, so the
model does not depend on the table that is read, and is small (``trees`` times 2 ** ``depth`` leaves).

Null and empty html give the empty text and 0 characters.  Repeated pages are extracted each.  Very long pages are taken whole.
An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.dom import HEADINGS, Node, parse

SCHEMA = "page_id long, url string, text string, n_chars long"
MARK = "\ue000"  # in made pages, stands before main text

#: Attribute tokens by what they tell, and tags by kind.  A node's flags are a bit for each.
FAMILIES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pager pagination paging tabs toc skip topbar toolbar sitemap",
    "header": "header head masthead banner logo brand branding tagline hero top",
    "footer": "footer foot copyright legal colophon bottom imprint contentinfo",
    "side": "sidebar side aside rail widget widgets secondary complementary related recommended recommendations popular trending tags teaser also",
    "notice": "cookie cookies consent gdpr notice notification alert alertdialog popup modal overlay dialog newsletter subscribe subscription paywall privacy message",
    "advert": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted dfp outbrain taboola",
    "form": "form search login signin signup register contact feedback survey poll",
    "comment": "comment comments commentlist disqus reply replies respond discussion thread reviews review responses",
    "share": "share sharing social follow facebook twitter buttons",
    "main": "article content main post entry story body text hentry blog primary column",
}
TAG_KINDS = {
    "t_article": "article main", "t_nav": "nav menu", "t_header": "header", "t_footer": "footer", "t_aside": "aside", "t_form": "form fieldset legend label button select textarea option",
    "t_div": "div section center", "t_p": "p", "t_heading": " ".join(sorted(HEADINGS)), "t_list": "ul ol dl", "t_item": "li dd dt", "t_table": "table tbody thead tfoot tr td th caption",
    "t_quote": "blockquote pre figure figcaption", "t_run": "#", "t_dialog": "dialog details summary iframe object noscript", "t_top": "#root html body",
}
NAMES = [*FAMILIES, *TAG_KINDS, "hidden"]
FAMILY_BITS = {w: 1 << k for k, words in reversed([*enumerate(FAMILIES.values())]) for w in words.split()}
TAG_BITS = {t: 1 << len(FAMILIES) + k for k, tags in enumerate(TAG_KINDS.values()) for t in tags.split()}
HIDDEN = 1 << len(NAMES) - 1
#: Bits that count when an ancestor or a descendant has them.
PASSED = [k for k, n in enumerate(NAMES) if n in FAMILIES or n in ("t_article", "t_nav", "t_header", "t_footer", "t_aside", "t_form", "t_p", "t_heading", "t_item", "t_table", "t_quote", "t_dialog", "hidden")]


class Page:
    """Nodes of one page in page order, with what can't be had from sums over ranges of them."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.parents: list[int] = []
        rows, last, stack = [], [], [(root, -1, 0, 1, 1)]
        above: list[int] = []
        own: list[int] = []
        depth: list[int] = []
        while stack:
            node, up, place, kin, same = stack.pop()
            k = len(self.nodes)
            self.nodes.append(node)
            self.parents.append(up)
            tag, bits = node.tag, TAG_BITS.get(node.tag, 0)
            for t in node.tokens:
                bits |= FAMILY_BITS.get(t, 0)
            if node.attrs:
                bits |= HIDDEN
            own.append(bits)
            above.append(above[up] | own[up] if up >= 0 else 0)
            depth.append(depth[up] + 1 if up >= 0 else 0)
            before = last[up] if place else -1
            last.append(-1)
            if up >= 0:
                last[up] = k
            stops = 0
            if tag == "#":
                t = node.text
                stops = t.count(". ") + t.count(", ") + t.count("? ") + (t[-1] in ".!?:")
            rows.append((node.chars, node.links, tag == "#", stops, tag == "p", place, kin, same, before))
            kids = node.kids
            n = len(kids)
            if n == 1:
                stack.append((kids[0], k, 0, 1, 1))
            elif n:
                tags: dict[str, int] = {}
                for x in kids:
                    tags[x.tag] = tags.get(x.tag, 0) + 1
                stack.extend([(kids[i], k, i, n, tags[kids[i].tag]) for i in range(n - 1, -1, -1)])
        size, longest = [1] * len(rows), [r[0] for r in rows]
        parents = self.parents
        for k in range(len(rows) - 1, 0, -1):
            up = parents[k]
            size[up] += size[k]
            if longest[k] > longest[up]:
                longest[up] = longest[k]
        self.rows, self.own, self.above, self.depth, self.size, self.longest = rows, own, above, depth, size, longest


def features(pages: list[Page]) -> np.ndarray:
    """A row for each node of each page, one page after another."""
    counts = [len(p.nodes) for p in pages]
    first = np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts).astype(np.int64)
    every = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
    rows = np.array([x for p in pages for r in p.rows for x in r], np.int64).reshape(-1, 9)
    size, up = every("size"), every("parents")
    up = np.maximum(up, 0) + first
    at = np.arange(len(rows))
    total_upto = np.concatenate([np.zeros((1, 5), np.int64), rows[:, :5].cumsum(axis=0)])
    chars, links, runs, stops, paras = (total_upto[at + size] - total_upto[at]).T.astype(np.float64)
    seen = (total_upto[at, 0] - total_upto[first, 0]).astype(np.float64)
    place, kin, same, before = rows[:, 5:].T
    has = np.flatnonzero(before >= 0)
    prev, following = np.zeros(len(rows)), np.zeros(len(rows))
    prev[has] = chars[before[has] + first[has]]
    following[before[has] + first[has]] = chars[has]
    page_chars, up_chars = np.maximum(1, chars[first]), np.maximum(1, chars[up])
    numbers = [
        np.log1p(chars), links / np.maximum(1, chars), np.log1p(chars / np.maximum(1, runs)), np.log1p(every("longest")), stops / np.maximum(1, chars) * 100, np.log1p(paras), np.log1p(size),
        chars / size, np.log1p(runs), chars / page_chars, chars / up_chars, seen / page_chars, place / kin, np.log1p(kin), same / kin, np.log1p(prev), np.log1p(following), every("depth"), links[up] / up_chars,
    ]
    own = (every("own")[:, None] >> np.arange(len(NAMES))) & 1
    own_upto = np.concatenate([np.zeros((1, len(PASSED)), np.int64), own[:, PASSED].cumsum(axis=0)])
    below = own_upto[at + size] > own_upto[at + 1]
    above = (every("above")[:, None] >> np.array(PASSED)) & 1
    return np.concatenate([np.stack(numbers, axis=1), own, above, below], axis=1).astype(np.float32)


class Trees:
    """Boosted oblivious trees: at each level of a tree all its nodes ask the same question."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, start: float):
        self.feature, self.cut, self.leaf, self.start = feature, cut, leaf, start

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        columns = {int(f): np.ascontiguousarray(x[:, f]) for f in np.unique(self.feature)}
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for f, c in zip(feature, cut, strict=True):
                at = at * 2 + (columns[int(f)] > c)
            out += leaf[at]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float = 0.25, bins: int = 24, smooth: float = 2.0, share: float = 0.5, seed: int = 5) -> Trees:
    """Newton steps on the logistic loss, each on a drawn ``share`` of the rows, with cuts at quantiles of each feature."""
    draw = np.random.default_rng(seed)
    is_flag = np.array([np.isin(x[:, f], (0, 1)).all() for f in range(x.shape[1])])
    flags = np.flatnonzero(is_flag)
    numbers = [(f, c) for f in np.flatnonzero(~is_flag) if len(c := np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])))]
    binned = [np.searchsorted(c, x[:, f], "left") for f, c in numbers]
    on = np.ascontiguousarray(x[:, flags], np.float32)
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(x), start)
    out_f, out_c, out_l = [], [], []
    worth = lambda g, h: g**2 / (h + smooth)
    for _ in range(trees):
        rows = np.flatnonzero(draw.random(len(x)) < share)
        p = 1 / (1 + np.exp(-margin[rows]))
        g, h = y[rows] - p, p * (1 - p)
        own_bins, own_flags, at = [b[rows] for b in binned], on[rows], np.zeros(len(rows), np.int64)
        chosen_f, chosen_c = [], []
        for level in range(depth):
            leaves, found = 1 << level, []
            sums = np.zeros((2, leaves, len(rows)), np.float32)
            sums[0, at, np.arange(len(rows))], sums[1, at, np.arange(len(rows))] = g, h
            all_g, all_h = (s.sum(axis=1, keepdims=True) for s in sums)
            g1, h1 = sums[0] @ own_flags, sums[1] @ own_flags
            gain = (worth(g1, h1) + worth(all_g - g1, all_h - h1)).sum(axis=0)
            found.append((float(gain.max()), int(flags[gain.argmax()]), 0.5))
            for (f, cuts), own in zip(numbers, own_bins, strict=True):
                key = at * (bins + 1) + own
                gs, hs = (np.bincount(key, w, leaves * (bins + 1)).reshape(leaves, -1).cumsum(axis=1) for w in (g, h))
                gain = (worth(gs, hs) + worth(gs[:, -1:] - gs, hs[:, -1:] - hs)).sum(axis=0)[: len(cuts)]
                found.append((float(gain.max()), int(f), float(np.float32(cuts[gain.argmax()]))))
            _, f, cut = max(found)
            chosen_f.append(f)
            chosen_c.append(cut)
            at = at * 2 + (x[rows, f] > np.float32(cut))
        leaf = rate * np.bincount(at, g, 1 << depth) / (np.bincount(at, h, 1 << depth) + smooth)
        out_f.append(chosen_f)
        out_c.append(chosen_c)
        out_l.append(leaf)
        margin += Trees(np.array([chosen_f]), np.array([chosen_c], np.float32), [leaf], 0.0).margins(x)
    return Trees(np.array(out_f), np.array(out_c, np.float32), np.array(out_l), start)


def decode(parents: list[int], margins: list[float]) -> list[bool]:
    """The likeliest labels where no node is main below one that is not."""
    n = len(parents)
    # Gain of the best labels of a subtree whose top is main, over the subtree with nothing main.
    gain = list(margins)
    for k in range(n - 1, 0, -1):
        if gain[k] > 0:
            gain[parents[k]] += gain[k]
    main = [False] * n
    for k in range(n):
        main[k] = gain[k] > 0 and (k == 0 or main[parents[k]])
    return main


def main_texts(pages: list[str | None], model: Trees) -> list[str]:
    """The main text of each page, blocks joined by blanks."""
    parsed = [Page(parse(p)) if p else None for p in pages]
    some = [p for p in parsed if p is not None]
    margins = model.margins(features(some)).tolist() if some else []
    out, at = [], 0
    for p in parsed:
        if p is None:
            out.append("")
            continue
        labels = decode(p.parents, margins[at : at + len(p.nodes)])
        at += len(p.nodes)
        out.append(" ".join([node.text for node, main in zip(p.nodes, labels, strict=True) if main and node.tag == "#"]))
    return out


# Pages to learn from.


class Maker:
    """Makes one page; main text is preceded by MARK."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.junk = self.r.random() < 0.15  # some pages' text is littered with signs
        self.plain = self.r.random() < 0.25  # and some pages name nothing by attributes

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def words(self, n: int) -> str:
        w = ["".join(self.r.choice("aeiounrstlédñ") for _ in range(self.r.choice((2, 3, 3, 4, 5, 6, 8, 11)))) for _ in range(max(1, n))]
        if self.junk:
            w = [x + self.pick("", "###", "&&&", "***", "%%") for x in w]
        return " ".join(w)

    def sentence(self, n: int | None = None) -> str:
        s = self.words(n or self.r.randint(2, 22)).capitalize()
        if self.r.random() < 0.4:
            s = s.replace(" ", ", ", 1)
        return s + self.pick(".", ".", ".", ".", "!", "?")

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def tag(self, options: str, inner: str, names: str = "", always: bool = False) -> str:
        name = self.r.choice(options.split())
        attrs = ""
        if names and (always or not self.plain) and self.r.random() < (1.0 if always else 0.8):
            value = self.r.choice(names.split())
            if self.r.random() < 0.4:
                value += self.pick("-1", "-wrap", " box", "-area", "__inner", " col-8")
            attrs = f' {self.pick("class", "class", "id")}="{value}"'
        return f"<{name}{attrs}>{inner}</{name}>"

    def links(self, n: int, text: int = 2) -> str:
        return "".join(f'<li><a href="/{k}">{escape(self.words(self.r.randint(1, text)))}</a></li>' for k in range(n))

    def main(self, text: str) -> str:
        text = escape(text)
        if self.r.random() < 0.2 and " " in text:
            a, b = text.split(" ", 1)
            text = f"{a} <a href='/x'>{b[: len(b) // 3]}</a>{b[len(b) // 3 :]}"
        return MARK + text

    def content(self) -> list[str]:
        r, out = self.r, []
        for _ in range(r.choice((1, 1, 2, 3, 5, 8, 12, 20))):
            kind = r.random()
            if kind < 0.68:
                text = self.main(self.prose(r.choice((1, 1, 3, 6, 10))))
                out.append(self.pick(f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>"))
            elif kind < 0.78:
                out.append(self.tag("h2 h3 h4", self.main(self.words(r.randint(1, 8)))))
            elif kind < 0.86:
                out.append(f"<ul>{''.join(f'<li>{self.main(self.sentence())}</li>' for _ in range(r.randint(2, 6)))}</ul>")
            elif kind < 0.90:
                out.append(f"<blockquote><p>{self.main(self.prose(2))}</p></blockquote>")
            elif kind < 0.93:
                out.append(f"<pre>{self.main(self.prose(2))}</pre>")
            elif kind < 0.96:
                out.append(f"<figure><img src=x><figcaption>{self.main(self.sentence())}</figcaption></figure>")
            else:
                out.append("<table>" + "".join(f"<tr><td>{self.main(self.words(2))}</td><td>{self.main(self.words(1))}</td></tr>" for _ in range(r.randint(2, 5))) + "</table>")
        return out

    def menu(self) -> str:
        inner = f"<ul>{self.links(self.r.randint(2, 10))}</ul>"
        if self.r.random() < 0.2:
            inner = " | ".join(f"<a href='/{k}'>{self.words(1)}</a>" for k in range(self.r.randint(2, 8)))
        return self.tag("nav nav nav div ul menu", inner, "menu nav navbar main-nav breadcrumbs top-menu pagination navigation")

    def head(self) -> str:
        inner = self.pick(f"<a href='/'>{self.words(2)}</a>", f"<h1>{self.words(2)}</h1><p>{self.sentence()}</p>", f"<div>{self.words(3)}</div>", f"<p>{self.prose(2)}</p>")
        return self.tag("header header div", inner + (self.menu() if self.r.random() < 0.5 else ""), "header site-header masthead banner branding page-header top")

    def advert(self) -> str:
        inner = self.pick(self.prose(2), f"<p>{self.prose(3)}</p>", f"<a href='/b'>{self.sentence()}</a>", f"<h4>{self.words(2)}</h4><p>{self.prose(2)}</p>")
        return self.tag("div div div aside section p", inner, "ad ads advert advertisement sponsored promo ad-slot banner-ad adsbox sponsor", True)

    def notice(self) -> str:
        inner = self.pick(self.prose(3), f"<p>{self.prose(4)}</p>", f"<p>{self.sentence()}</p><button>{self.words(1)}</button>", f"<h3>{self.words(2)}</h3><p>{self.prose(3)}</p>")
        return self.tag("div div section dialog aside", inner, "cookie-notice cookies consent gdpr-banner notice newsletter subscribe popup modal alert paywall cookie-banner privacy-notice", True)

    def side(self) -> str:
        parts = []
        for _ in range(self.r.randint(1, 4)):
            parts.append(self.pick(f"<h3>{self.words(2)}</h3><ul>{self.links(self.r.randint(2, 7), 7)}</ul>", f"<p>{self.prose(3)}</p>", f"<div>{self.sentence()}</div>", f"<h4>{self.words(1)}</h4><p>{self.prose(5)}</p>"))
        return self.tag("aside aside div section", "".join(parts), "sidebar side widget-area secondary related related-posts right-rail recommended aside", self.r.random() < 0.8)

    def form(self) -> str:
        inner = f"<label>{self.words(2)}</label><input name=q>" + self.pick("", f"<p>{self.prose(2)}</p>", f"<textarea>{self.words(3)}</textarea>", f"<select><option>{self.words(1)}<option>{self.words(1)}</select>") + f"<button>{self.words(1)}</button>"
        return f"<form action='/s'>{inner}</form>" if self.r.random() < 0.6 else self.tag("div section", f"<form>{inner}</form>", "search login signup contact-form newsletter")

    def comments(self) -> str:
        one = lambda: self.tag("div li article li div", self.pick("", f"<b>{self.words(2)}</b>", f"<h4>{self.words(2)}</h4>", f"<a href='/u'>{self.words(1)}</a>") + self.pick(f"<p>{self.prose(6)}</p>", self.prose(3), f"<div>{self.prose(4)}</div>"), "comment reply comment-body response")
        inner = self.pick("", f"<h2>{self.words(1)}</h2>", f"<h3>{self.words(2)}</h3>") + "".join(one() for _ in range(self.r.randint(1, 8))) + (self.form() if self.r.random() < 0.3 else "")
        return self.tag("section div div ol ul aside", inner, "comments comment-list disqus_thread discussion user-comments reader-comments responses", True)

    def share(self) -> str:
        return self.tag("div ul p", self.links(self.r.randint(2, 5), 1), "share social social-buttons sharing follow", True)

    def foot(self) -> str:
        inner = self.pick(f"&copy; {self.words(2)} &middot; {self.prose(2)}", f"<p>{self.prose(3)}</p><ul>{self.links(4)}</ul>", f"<ul>{self.links(5)}</ul><p>&copy; {self.words(3)}</p>", f"<p>{self.sentence()}</p>")
        return self.tag("footer footer footer div", inner, "footer site-footer copyright colophon legal bottom page-footer", self.r.random() < 0.7)

    def page(self) -> str:
        r = self.r
        title = self.words(r.randint(2, 12))
        body = self.content()
        if r.random() < 0.85:
            heading = f"<h1>{self.main(title)}</h1>"
            body.insert(0, f"<header>{heading}</header>" if r.random() < 0.15 else heading)
        for make, chance in ((self.advert, 0.25), (self.share, 0.15), (self.side, 0.12), (self.notice, 0.12), (self.form, 0.08), (self.comments, 0.12), (self.menu, 0.05)):
            if r.random() < chance:
                body.insert(len(body) if make == self.comments else r.randint(1, len(body)), make())
        main = "\n".join(body) if r.random() < 0.5 else "".join(body)
        if r.random() < 0.25:
            main = self.tag("div section", main, "content entry-content article-body post-content text story body")
        if r.random() < 0.93:
            main = self.tag("article article article main div div section td", main, "content main article post entry hentry story post-1 article-body primary")
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            main = self.tag("div main section", main, "wrapper container page content main row layout")
        before = [f() for f, chance in ((self.head, 0.45), (self.menu, 0.7), (self.notice, 0.25), (self.advert, 0.4), (self.form, 0.15), (self.side, 0.15)) if r.random() < chance]
        after = [f() for f, chance in ((self.comments, 0.3), (self.side, 0.35), (self.share, 0.1), (self.advert, 0.25), (self.notice, 0.2), (self.form, 0.12), (self.menu, 0.12)) if r.random() < chance]
        r.shuffle(before)
        r.shuffle(after)
        if r.random() < 0.85:
            after.append(self.foot())
        if r.random() < 0.15:
            after.append(self.notice())
        inner = "".join(before) + main + "".join(after)
        if r.random() < 0.15:
            inner = f"<div class='{self.pick('page', 'container', 'site')}'>{inner}</div>"
        return f"<!DOCTYPE html><html><head><title>{escape(title)}</title><style>p{{}}</style></head><body>{inner}</body></html>"


def example(seed: int) -> tuple[Page, np.ndarray]:
    """A made page, and whether each node's subtree holds main text."""
    root = parse(Maker(seed).page())
    stack, main_runs = [root], set()
    while stack:
        node = stack.pop()
        if MARK in node.text:
            main_runs.add(id(node))
            node.text = node.text.replace(MARK, "")
            node.chars = len(node.text)
            node.links = min(node.links, node.chars)
        stack.extend(node.kids)
    page = Page(root)
    y = np.array([id(n) in main_runs for n in page.nodes])
    for k in range(len(y) - 1, 0, -1):
        y[page.parents[k]] |= y[k]
    return page, y


@functools.lru_cache(maxsize=4)
def trained(pages: int, trees: int, depth: int, seed: int) -> Trees:
    made = [example(seed * 1_000_003 + k) for k in range(pages)]
    return boost(features([m[0] for m in made]), np.concatenate([m[1] for m in made]).astype(float), trees, depth)


def extract(pages: DataFrame, train_pages: int = 900, trees: int = 70, depth: int = 5, seed: int = 11, batch: int = 256) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages`` (page_id, url, html).

    ``train_pages`` is the number of made pages that the trees are fitted on.
    """
    model = pages.sparkSession.sparkContext.broadcast(trained(train_pages, trees, depth, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in batches:
            for start in range(0, held.num_rows, batch):
                part = held.slice(start, batch)
                texts = main_texts(part.column(2).to_pylist(), model.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, SCHEMA)
