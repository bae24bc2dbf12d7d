"""HTML as a flat tree with numeric features per element."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

# The following are fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)

#: Start tags that end open elements of these names, up to the given enclosing ones.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)",
    re.S,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_ATTR = re.compile(r"(?:class|id|role|itemprop|aria-label|data-role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

GOOD_WORDS = frozenset("article content main post entry body text story copy prose page".split())
BAD_WORDS = frozenset(
    "ad ads advert advertisement adv banner promo promoted sponsor sponsored nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead footer foot sidebar side aside widget comment comments reply replies discussion "
    "disqus respond cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations toolbar pagination pager search form "
    "copyright legal disclaimer outbrain taboola skip".split()
)
DROPPED_TAGS = frozenset(
    "script style noscript template head title textarea select button input iframe object svg math canvas nav aside "
    "footer form dialog menu".split()
)


class Tree:
    """Elements in page order; texts as (element, text, block break before it)."""

    __slots__ = ("attrs", "depth", "parent", "tags", "texts")

    def __init__(self) -> None:
        self.tags, self.parent, self.depth, self.attrs = ["#root"], [-1], [0], [()]
        self.texts: list[tuple[int, str, bool]] = []


def attr_words(attrs: str) -> tuple[str, ...]:
    """The words in class, id, role and the like."""
    found = []
    for m in _ATTR.finditer(attrs):
        found += [w.lower() for w in _PART.findall(m[1] or m[2] or m[3] or "")]
    return tuple(found)


def parse(page: str | None) -> Tree:
    """Read a page of any quality. Unknown or unmatched end tags are ignored, open elements end with the page."""
    tree = Tree()
    if not page:
        return tree
    tags, parent, depth, attrs, texts = tree.tags, tree.parent, tree.depth, tree.attrs, tree.texts
    stack, at, end, broken = [0], 0, len(page), True
    # How many elements of a tag are open, so that an end tag without one costs no look at the stack.
    opened: Counter[str] = Counter()

    def close(k: int) -> None:
        opened.subtract(tags[e] for e in stack[k:])
        del stack[k:]

    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            texts.append((stack[-1], page[at:stop], broken))
            broken = False
        if not m:
            break
        at = m.end()
        closing, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name not in INLINE:
            broken = True
        if closing:
            if opened[name]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if tags[stack[k]] == name))
            continue
        if name in CLOSES_P and opened["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]] == "p":
                    close(k)
                    break
                if tags[stack[k]] in CLOSES_P or tags[stack[k]] in ("td", "th", "li"):
                    break
        elif name in _ENDS and any(opened[t] for t in _ENDS[name][0]):
            ended, scope = _ENDS[name]
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]] in scope:
                    break
                if tags[stack[k]] in ended:
                    close(k)
                    break
        tags.append(name)
        parent.append(stack[-1])
        depth.append(depth[stack[-1]] + 1)
        attrs.append(attr_words(rest) if rest else ())
        if name in RAW:
            # Only the name itself ends it, in any case: "</scripts" does not.
            ending = _RAW_END[name].search(page, at)
            stop = ending.start() if ending else end
            if stop > at:
                texts.append((len(tags) - 1, page[at:stop], True))
            mark = page.find(">", stop)
            at = mark + 1 if ending and mark >= 0 else end
        elif name not in VOID:  # a slash ends nothing in HTML
            stack.append(len(tags) - 1)
            opened[name] += 1
    return tree


FEATURES = (
    "article nav header footer aside form list item heading paragraph division link table dropped "
    "good_words bad_words bad_above good_above own_bad depth siblings place same_tag own_text subtree_text "
    "link_share density subtree_tags marks paragraphs page_share holds_article holds_heading holds_form"
).split()
_KINDS = {
    "article": ("article", "main"), "nav": ("nav", "menu"), "header": ("header",), "footer": ("footer",),
    "aside": ("aside",), "form": ("form", "fieldset", "button", "select", "label", "input"),
    "list": ("ul", "ol", "dl"), "item": ("li", "dt", "dd"), "heading": ("h1", "h2", "h3", "h4", "h5", "h6"),
    "paragraph": ("p", "blockquote", "pre"), "division": ("div", "section"), "link": ("a",),
    "table": ("table", "tr", "td", "th", "tbody"),
}
_KIND = {tag: k for k, name in enumerate(FEATURES[:13]) for tag in _KINDS[name]}


def features(tree: Tree) -> list[list[float]]:
    """A row of FEATURES per element: what it is, where it stands and what stands below it."""
    n = len(tree.tags)
    own, links, below = [0] * n, [0] * n, [1] * n
    marks, paragraphs, children = [0] * n, [0] * n, [0] * n
    article, heading, form = [0] * n, [0] * n, [0] * n
    bad, good, bad_above, good_above = [0] * n, [0] * n, [0] * n, [0] * n
    place, same = [0] * n, [0] * n
    seen: list[dict[str, int]] = [{} for _ in range(n)]
    for k, text, _ in tree.texts:
        if tree.tags[k] not in ("script", "style"):
            size = len(text)
            own[k] += size
            marks[k] += text.count(",") + text.count(".")
    total = own[:]
    for k in range(n):
        tag, up = tree.tags[k], tree.parent[k]
        words = tree.attrs[k]
        if words:
            bad[k] = sum(w in BAD_WORDS for w in words)
            good[k] = sum(w in GOOD_WORDS for w in words)
        if k:
            place[k] = children[up]
            children[up] += 1
            seen[up][tag] = same[k] = seen[up].get(tag, 0) + 1
            bad_above[k] = int(bad_above[up] or bad[up] > 0 or tree.tags[up] in DROPPED_TAGS)
            good_above[k] = int(good_above[up] or good[up] > 0 or tree.tags[up] in ("article", "main"))
        kind = _KIND.get(tag, -1)
        article[k] = int(kind == 0)
        heading[k] = int(kind == 8)
        form[k] = int(kind == 5)
        paragraphs[k] = int(tag == "p")
        links[k] = own[k] if tag == "a" else 0
    for k in range(n - 1, 0, -1):
        up = tree.parent[k]
        total[up] += total[k]
        links[up] += total[k] if tree.tags[k] == "a" else links[k]
        below[up] += below[k]
        marks[up] += marks[k]
        paragraphs[up] += paragraphs[k]
        article[up] |= article[k]
        heading[up] |= heading[k]
        form[up] |= form[k]
    page = max(1, total[0])
    rows = []
    for k in range(n):
        row = [0.0] * 13
        kind = _KIND.get(tree.tags[k], -1)
        if kind >= 0:
            row[kind] = 1.0
        up = max(0, tree.parent[k])
        t = total[k]
        row += [
            float(tree.tags[k] in DROPPED_TAGS), good[k], bad[k], bad_above[k], good_above[k],
            float(bad[k] > 0 or tree.tags[k] in DROPPED_TAGS), tree.depth[k], children[up],
            place[k] / max(1, children[up]), seen[up].get(tree.tags[k], 0) / max(1, children[up]),
            math.log1p(own[k]), math.log1p(t), links[k] / max(1, t), math.log1p(t / below[k]),
            math.log(below[k]), marks[k] / max(1, t), math.log1p(paragraphs[k]), t / page,
            article[k], heading[k], form[k],
        ]
        rows.append(row)
    return rows


def join_texts(tree: Tree, kept: list[bool]) -> str:
    """The texts of kept elements: decoded, blocks with one space for each white space, one space between."""
    blocks: list[str] = []
    parts: list[str] = []
    broken = True
    for k, text, before in tree.texts:
        broken = broken or before
        if not kept[k]:
            continue
        if broken and parts:
            blocks.append("".join(parts))
            parts = []
        broken = False
        parts.append(html.unescape(text) if "&" in text else text)
    blocks.append("".join(parts))
    return " ".join(" ".join(blocks).split())
