"""A tolerant HTML parser that keeps what main-text extraction needs: block elements and runs of text.

Inline elements are part of the run they stand in.  Comments, declarations, scripts, styles and templates leave
nothing.  Unclosed and misnested tags are repaired by closing what they imply.
"""

from __future__ import annotations

import re
from html import unescape

#: Elements of HTML that start a block of their own.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html"
    " legend li main menu nav ol option optgroup p pre section select summary table tbody td tfoot th thead tr ul button textarea label iframe object noscript".split()
)
#: Elements whose content is not text of the page.
SILENT = frozenset("script style template head title noembed noframes svg math canvas audio video datalist".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noembed noframes iframe xmp".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Drawings and formulas, the places in them that hold HTML again, and the tags of HTML that end them elsewhere.
FOREIGN = frozenset({"svg", "math"})
ISLANDS = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub"
    " sup table tt u ul var".split()
)
#: An open element of a kind ends at the start of one of these, unless one of the scopes stands between.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "tfoot": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "thead": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
KEEPS_PARAGRAPH = frozenset("option optgroup label button select textarea iframe object noscript body html tbody thead tfoot tr td th legend".split())

#: Attributes as the states of an HTML tokenizer read them: a quote opens a value just after ``=``; anywhere else it belongs to a name or an
#: unquoted value.  A quote that nothing closes opens none.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
ATTRIBUTES = rf"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{VALUE})?)*+"
TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|/(?:>|[^a-zA-Z>][^>]*(?:>|\Z))"
    rf"|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>{ATTRIBUTES})(?:>|\Z))", re.S,
)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
TOKENS = re.compile(r"[a-z]+")
NO_TOKENS: tuple[str, ...] = ()


class Node:
    """A block element, or (tag ``#``) a run of text with its inline elements."""

    __slots__ = ("attrs", "chars", "kids", "links", "parent", "tag", "text", "tokens")

    def __init__(self, tag: str, parent: Node | None, tokens: tuple[str, ...] = NO_TOKENS):
        self.tag, self.parent, self.tokens = tag, parent, tokens
        self.kids: list[Node] = []
        self.text, self.chars, self.links, self.attrs = "", 0, 0, ""


def attribute_tokens(attrs: str) -> tuple[tuple[str, ...], str]:
    """Lower-case letter runs of class, id, role and aria-label, and marks: ``h`` hidden."""
    if not attrs or attrs.isspace():
        return NO_TOKENS, ""
    found, marks = [], ""
    for m in ATTRIBUTE.finditer(attrs):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            found += TOKENS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", unescape(value)).lower())
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            marks = "h"
    return tuple(found), marks


def parse(html: str) -> Node:
    """The tree of blocks and runs; its root is ``#root``."""
    root = Node("#root", None)
    at = root
    inline: list[str] = []  # open inline elements of the present run, to know links
    run: list[str] = []
    linked = 0
    silent: list[str] = []
    done = 0

    def close_run() -> None:
        nonlocal linked
        text = " ".join((run[0] if len(run) == 1 else "".join(run)).split())
        if text:
            node = Node("#", at)
            node.text, node.chars = text, len(text)
            node.links = min(len(text), linked)
            at.kids.append(node)
        run.clear()
        linked = 0

    def add(text: str, plain: bool = False) -> None:
        nonlocal linked
        if text and not silent:
            run.append(text if plain or "&" not in text else unescape(text))
            if inline and "a" in inline:
                linked += len(text.strip())

    find = TAG.search
    while m := find(html, done):
        start = m.start()
        if start > done:
            add(html[done:start])
        done = m.end()
        cdata, ends, name, attrs = m.groups()
        if name is None:
            add(cdata or "", True)
            continue
        name = name.lower()
        if ends:
            if silent:
                if name in silent:
                    while silent.pop() != name:
                        pass
                    continue
                # The end of a block around an element that nothing closed ends that element too.
                if "template" in silent or name not in BLOCKS or all(n.tag != name for n in chain(at)):
                    continue
                silent.clear()
            if name in BLOCKS:
                up = at
                while up is not root and up.tag != name:
                    up = up.parent
                if up is not root:
                    if run:
                        close_run()
                    at = up.parent
                    if name not in ("p", *HEADINGS):
                        inline.clear()
                elif name == "p" and run:
                    close_run()
            elif name in inline:
                while inline.pop() != name:
                    pass
            continue
        if silent and name in BREAKS_OUT and silent[-1] not in ISLANDS:
            outer = next((k for k in range(len(silent) - 1, -1, -1) if silent[k] in FOREIGN or silent[k] in ISLANDS), -1)
            if outer >= 0 and silent[outer] in FOREIGN:
                del silent[outer:]
        if name == "br":
            add(" ", True)
            continue
        foreign = name in FOREIGN or (bool(silent) and not FOREIGN.isdisjoint(silent))
        if silent or name in SILENT:
            if name in RAW and not foreign:
                end = RAW_END[name].search(html, done)
                done = end.start() if end else len(html)
            if name not in VOID and (silent or name != "head") and not (foreign and attrs.endswith("/")):
                silent.append(name)
            continue
        if name in BLOCKS:
            if run:
                close_run()
            if name in ("html", "body") and any(n.tag == name for n in chain(at)):
                continue
            if name in ENDS:
                kinds, scope = ENDS[name]
                up = at
                while up is not root and up.tag not in scope:
                    if up.tag in kinds:
                        at = up.parent
                    up = up.parent
            elif name not in KEEPS_PARAGRAPH:
                up = at
                while up is not root and up.tag not in ("td", "th", "button", "object", "table"):
                    if up.tag == "p" or (name in HEADINGS and up.tag in HEADINGS):
                        at = up.parent
                        break
                    up = up.parent
            if name == "hr":
                continue
            tokens, marks = attribute_tokens(attrs)
            node = Node(name, at, tokens)
            node.attrs = marks
            at.kids.append(node)
            at = node
            if name in RAW:
                end = RAW_END[name].search(html, done)
                stop = end.start() if end else len(html)
                add(html[done:stop])
                done = stop
        elif name not in VOID:
            if name == "a" and "a" in inline:
                inline.remove("a")
            inline.append(name)
    add(html[done:])
    if run:
        close_run()
    return root


def chain(node: Node | None):
    while node is not None:
        yield node
        node = node.parent
