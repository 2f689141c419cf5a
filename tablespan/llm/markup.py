"""Pages as blocks of text with the paths of their elements; a small reader of HTML for use inside tasks.

A path is a 64-bit hash of the tags and class names from the root to a block-level element. Inline elements are
not part of paths. Unclosed paragraphs, list items and cells end where HTML ends them; a tag that the page's end cuts off is
dropped.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape
from zlib import crc32

#: Fixed values of HTML: elements that are empty, that hold raw text, and that close an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "template tfoot th thead tr ul".split()
)
#: Blocks that hold running text; what stands around them is their container.
TEXT_BLOCKS = frozenset("blockquote caption dd dl dt figcaption h1 h2 h3 h4 h5 h6 li ol p pre table tbody td tfoot th thead tr ul".split())
#: An element of the first kind ends open ones of the second, up to the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}

#: Elements that are never main text, by name, by role, and by the words of their class names and ids.
NOT_TEXT = frozenset("aside audio button canvas dialog footer form head menu nav object search select svg template video".split()) | RAW
NOT_TEXT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads advert advertisement advertisements adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "recommended related replies reply share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar "
    "widget widgets".split()
)
NOT_TEXT_BEFORE = frozenset("has is no not with without".split())  # "has-sidebar" is no sidebar
MAIN, ARTICLE = 1, 2

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
_MASK = (1 << 63) - 1
_NEAR = 64  # open blocks among which a text's containers are looked for


@dataclass
class Block:
    path: int
    containers: tuple[int, ...]  # of its text: the nearest one first, three at most
    region: int  # the path of the article or main element around it, or 0
    inside: bool  # of an element asked for
    text: str
    linked: int  # characters in links


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: Counter = field(default_factory=Counter)  # how often each path occurs
    regions: dict[int, int] = field(default_factory=dict)  # MAIN or ARTICLE by path


@dataclass
class _Open:
    name: str
    block: bool
    path: int
    dropped: bool
    region: int
    inside: bool
    linked: bool


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _is_noise(label: str) -> bool:
    """Whether a class name or id speaks of something beside the main text."""
    words = [w for w in re.split(r"[-_\d]+|(?<=[a-z])(?=[A-Z])", label) if w]
    words = [w.lower() for w in words]
    return bool(words) and words[0] not in NOT_TEXT_BEFORE and (words[0] in NOT_TEXT_WORDS or words[-1] in NOT_TEXT_WORDS)


def _dropped(name: str, given: dict[str, str], region: int) -> bool:
    if name in NOT_TEXT or (name == "header" and not region) or "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return True
    if name in ("html", "body", "main"):
        return False
    return given.get("role", "").lower() in NOT_TEXT_ROLES or any(_is_noise(x) for key in ("class", "id") for x in given.get(key, "").split())


def read_page(html: str, wanted: frozenset[int] = frozenset()) -> Page:
    """The blocks of a page that are not noise by themselves; `wanted`: paths whose blocks are `inside`."""
    page = Page()
    stack = [_Open("", True, 0, False, 0, 0 in wanted, False)]
    open_blocks = stack[:]
    names: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            around = [x.path for x in open_blocks[:-_NEAR:-1] if x.name not in TEXT_BLOCKS][:3]
            own = open_blocks[-1]
            page.blocks.append(Block(own.path, tuple(around), own.region, own.inside, text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(depth: int) -> None:
        """Close the elements from this depth on."""
        if any(x.block for x in stack[depth:]):
            flush()
        for x in stack[depth:]:
            names[x.name] -= 1
            if x.block:
                open_blocks.pop()
        del stack[depth:]

    def ended(targets: set[str], limits: set[str]) -> None:
        if any(names[t] for t in targets):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in targets:
                    return close(depth)
                if stack[depth].name in limits:
                    return None
        return None

    at = 0
    while at < len(html):
        token = _TOKEN.match(html, at)
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            text = token[0]
            if (text[0] != "<" or text == "<") and not stack[-1].dropped:
                text = unescape(text)
                parts.append(text)
                linked += len(text) if stack[-1].linked else 0
            continue
        if token[1]:
            if name in BLOCKS:
                if not names[name]:
                    flush()
                    continue
                close(next(d for d in range(len(stack) - 1, 0, -1) if stack[d].name == name))
            elif names[name]:
                depth = len(stack) - 1
                while not stack[depth].block and stack[depth].name != name:
                    depth -= 1
                if stack[depth].name == name:
                    close(depth)
            continue
        if name in BLOCKS:
            flush()
            if name in ENDS:
                ended(*ENDS[name])
            elif name not in ("html", "body", "head"):
                ended({"p"}, {"table", "button", "object"})
        if name in VOID:
            if name == "br" and parts:
                parts.append(" ")
            continue
        above = stack[-1]
        given = _attributes(token[3]) if token[3].strip() else {}
        region, path = above.region, above.path
        dropped = above.dropped or _dropped(name, given, region)
        inside = above.inside
        if name in BLOCKS:
            classes = " ".join(sorted(c for c in given.get("class", "").split() if not re.search(r"\d", c)))
            path = ((above.path + 1) * 0x2545F4914F6CDD1D + crc32(f"{name}.{classes}.{given.get('role', '')}".encode()) * 0x9E3779B97F4A7C15 & _MASK) & _MASK
            path ^= path >> 29
            page.elements[path] += 1
            kind = 0 if dropped else ARTICLE if name == "article" or given.get("itemprop") == "articleBody" else MAIN if name == "main" or given.get("role") == "main" else 0
            if kind:
                page.regions[path] = kind
                region = path
            inside = inside or path in wanted
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else len(html)
            continue
        if token[3].endswith("/") and name not in BLOCKS:
            continue  # <svg/> and the like
        stack.append(_Open(name, name in BLOCKS, path, dropped, region, inside, above.linked or name == "a"))
        names[name] += 1
        if name in BLOCKS:
            open_blocks.append(stack[-1])
    flush()
    return page
