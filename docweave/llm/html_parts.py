"""The block-level structure of an HTML page: a token stream of blocks, folded into a union-free regular expression.

An expression is a list of items `[low, high, label, inner, members]`: at least `low` (0, 1) and at most `high` (1, MANY)
times an element with the `label` and the expression `inner`, or a text slot (label TEXT), or a group of items (label
GROUP). `members` are numbers of the page's blocks that a text slot holds; they are no part of the expression.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TEXT, GROUP, MANY = "#", "", 2
#: Items that a repeated group holds, at most; longer repetitions stay sequences.
GROUP_ITEMS = 4
#: Elements nested deeper than this still part blocks, but are no elements of the structure.
DEPTH = 100

# Elements of HTML by their role.
_RAW = "script style textarea title iframe noembed noframes xmp".split()
_SKIPPED = frozenset("button select noscript template svg math object audio video canvas datalist".split())
_BLOCKS = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th thead "
    "tr ul".split()
)
_BREAKS = frozenset("hr html head body frameset".split())
_VOID = frozenset("area base br col embed img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that a new one of the same set ends, unless one of the others is nearer.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
}
_TABLE = frozenset("table tbody thead tfoot tr td th caption".split())
# Classes and ids that set an inline element apart from the sentence around it.
_INLINE_NOISE = frozenset("ad ads advert advertisement sponsored share social".split())

_ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(_RAW)})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    rf"|<(/?)([a-z][^\s/>]*)({_ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NAME_PARTS = re.compile(r"[^A-Za-z]+")


def words_of(name: str) -> list[str]:
    """The lower-case words of a class or id, also of one in camel case."""
    return [word.lower() for word in _WORD.findall(name)]


def label_of(tag: str, attributes: str) -> str:
    """The tag with its role, marks and classes; numbers in names are left out, so that ids do not set pages apart."""
    parts = {"class": "", "id": "", "role": "", "itemprop": ""}
    hidden = False
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name in parts:
            parts[name] = parts[name] or value
        elif name == "style":
            hidden |= bool(_HIDDEN_STYLE.search(value))
        else:
            hidden |= name == "hidden" or value.lower() == "true"
    names = [_NAME_PARTS.sub("-", name).strip("-") for name in (parts["class"] + " " + parts["id"]).split()]
    label = tag + "".join("." + name for name in dict.fromkeys(names) if name)
    if parts["role"]:
        label += "@" + parts["role"].strip().lower()
    if "articlebody" in parts["itemprop"].lower():
        label += "@article"
    return label + "@hidden" if hidden else label


@dataclass
class Page:
    """Texts of the blocks of a page in order, how much of each is linked, and its structure."""

    texts: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    items: list = field(default_factory=list)


def _item(label: str, inner: list | None = None, members: list | None = None) -> list:
    return [1, 1, label, inner, members or []]


def read_page(source: str) -> Page:
    """Blocks of a page. Markup errors are taken as browsers take them where that matters to the text."""
    page = Page()
    root: list = []
    stack: list[tuple[str, list]] = []  # open elements and their items
    words: list[str] = []
    n_linked, in_link, place = 0, 0, 0
    skipped, depth, skipped_at = "", 0, 0  # an element whose content is left out

    def end_block() -> None:
        nonlocal n_linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                (stack[-1][1] if stack else root).append(_item(TEXT, None, [len(page.texts)]))
                page.texts.append(text)
                page.linked.append(min(n_linked, len(text)))
            words.clear()
        n_linked = 0

    def close_to(level: int) -> None:
        while len(stack) > level:
            label, inner = stack.pop()
            (stack[-1][1] if stack else root).append(_item(label, fold(inner)))

    def last(names: set[str] | frozenset[str], bounds: set[str] | frozenset[str]) -> int | None:
        for level in range(len(stack) - 1, -1, -1):
            tag = stack[level][0].split(".", 1)[0].split("@", 1)[0]
            if tag in names:
                return level
            if tag in bounds:
                return None
        return None

    def add(text: str) -> None:
        nonlocal n_linked
        if text and not skipped:
            words.append(text)
            if in_link:
                n_linked += len(text.strip())

    for token in _TOKEN.finditer(source):
        add(source[place : token.start()])
        place = token.end()
        tag = token[3]
        if not tag:
            continue
        tag = tag.lower()
        if skipped:
            if tag == skipped:
                depth += -1 if token[2] else 1
                if not depth:
                    skipped = ""
                continue
            if not (token[2] and tag in _BLOCKS and last({tag}, _TABLE - {tag}) is not None):
                continue
            skipped = ""  # the block around it ends
        if tag in _BLOCKS:
            end_block()
            in_link = 0
            if token[2]:
                level = last({tag}, frozenset() if tag in _TABLE else _TABLE)
                if level is None and tag in _HEADINGS:
                    level = last(_HEADINGS, _TABLE)
                if level is not None:
                    close_to(level)
                continue
            if stack and (stack[-1][0].split(".", 1)[0] == "p" or (tag in _HEADINGS and stack[-1][0][:2] in _HEADINGS)):
                close_to(len(stack) - 1)
            if tag in _ENDS and (level := last(*_ENDS[tag])) is not None:
                close_to(level)
            if len(stack) < DEPTH:
                stack.append((label_of(tag, token[4]) if token[4] else tag, []))
        elif tag in _BREAKS:
            end_block()
        elif tag == "br":
            add(" ")
        elif tag in _SKIPPED:
            if not token[2] and not token[0].endswith("/>"):
                skipped, depth = tag, 1
        elif not token[2] and token[4] and tag not in _VOID and ("class" in token[4] or "hidden" in token[4] or "none" in token[4]):
            label = label_of(tag, token[4])
            if label.endswith("@hidden") or not _INLINE_NOISE.isdisjoint(words_of(label.partition(".")[2])):
                skipped, depth = tag, 1
            else:
                in_link += tag == "a"
        elif tag == "a":
            in_link = 0 if token[2] else 1
    add(source[place:])
    end_block()
    close_to(0)
    page.items = fold(root)
    return page


def key(item: list) -> str:
    return item[2] if item[2] != GROUP else "(" + " ".join(map(key, item[3])) + ")"


def _union(a: list, b: list, low: int, high: int) -> list:
    """Both items as one; it takes over the members of `a`, which is not used any more."""
    inner = None if a[3] is None else merge(a[3], b[3])
    a[4].extend(b[4])
    return [low, high, a[2], inner, a[4]]


def _adjoining(items: list) -> list:
    out: list = []
    for item in items:
        if out and key(out[-1]) == key(item):
            out[-1] = _union(out[-1], item, out[-1][0] | item[0], MANY)
        else:
            out.append(item)
    return out


def fold(items: list) -> list:
    """Adjoining repetitions become one item that may repeat: of single items first, then of groups of items."""
    if len(items) < 2:
        return items
    out = _adjoining(items)
    for size in range(2, GROUP_ITEMS + 1):
        if len(out) < 2 * size:
            break
        keys, folded, i = [key(item) for item in out], [], 0
        while i < len(out):
            wanted, n = keys[i : i + size], 1
            while keys[i + n * size : i + (n + 1) * size] == wanted and len(wanted) == size:
                n += 1
            if n > 1:
                folded.append(_grouped(out[i : i + n * size], size))
                i += n * size
            else:
                folded.append(out[i])
                i += 1
        out = folded
    return out


def _grouped(items: list, size: int) -> list:
    inner = items[:size]
    for i in range(size, len(items), size):
        inner = [_union(a, b, min(a[0], b[0]), max(a[1], b[1])) for a, b in zip(inner, items[i : i + size])]
    return [1, MANY if len(items) > size else 1, GROUP, inner, []]


def _with_groups(items: list, groups: list) -> list:
    """`items` with stretches that are one of the `groups` turned into such groups."""
    for group in groups:
        wanted, size = [key(item) for item in group[3]], len(group[3])
        keys, out, i = [key(item) for item in items], [], 0
        while i < len(items):
            n = 0
            while keys[i + n * size : i + (n + 1) * size] == wanted:
                n += 1
            if n:
                out.append(_grouped(items[i : i + n * size], size))
                i += n * size
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def common_pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; a row of its table is one large number."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    pairs = [(i, i) for i in range(start)]
    a, b = a[start:], b[start:]
    if not a or not b:
        return pairs
    masks: dict[str, int] = {}
    for j, name in enumerate(b):
        masks[name] = masks.get(name, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for name in a:
        hit = row & masks.get(name, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    found, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not (i and not rows[i - 1] >> (j - 1) & 1):
                j -= 1
                found.append((start + i, start + j))
    return pairs + found[::-1]


def aligned(a: list, b: list) -> tuple[list, list, list[tuple[int, int]]]:
    """Both lists, with the groups of either, and the places of items that belong together."""
    groups_a, groups_b = ([item for item in items if item[2] == GROUP] for items in (a, b))
    if groups_a or groups_b:
        a, b = _with_groups(a, groups_b), _with_groups(b, groups_a)
    return a, b, common_pairs([key(item) for item in a], [key(item) for item in b])


def merge(a: list, b: list) -> list:
    """The expression of both: what belongs together is merged, what only one has becomes optional."""
    a, b, pairs = aligned(a, b)
    out, i, j = [], 0, 0
    for x, y in [*pairs, (len(a), len(b))]:
        out += [[0, *item[1:]] for item in (*a[i:x], *b[j:y])]
        if x < len(a):
            out.append(_union(a[x], b[y], min(a[x][0], b[y][0]), max(a[x][1], b[y][1])))
        i, j = x + 1, y + 1
    return out if len(out) == len(a) == len(b) else fold(out)


def bare(items: list) -> list:
    """The expression without members, as JSON can hold it."""
    return [[low, high, label, None if inner is None else bare(inner)] for low, high, label, inner, *_ in items]


def filled(items: list) -> list:
    """What `bare` made, as an expression again."""
    return [[low, high, label, None if inner is None else filled(inner), []] for low, high, label, inner in items]


def leaves(items: list, above: tuple = ()) -> list[tuple[tuple, list]]:
    """(labels above it, item) of every text slot, in order; the elements above come with their number in preorder."""
    out: list = []
    count = [0]

    def walk(items: list, above: tuple) -> None:
        for item in items:
            if item[2] == TEXT:
                out.append((above, item))
            elif item[2] == GROUP:
                walk(item[3], above)
            else:
                count[0] += 1
                walk(item[3], (*above, (count[0], item[2])))

    walk(items, above)
    return out


def place(wrapper: list, items: list, slots: dict[int, int], out: dict[int, int]) -> None:
    """The slot of each block of a page: `items` is the page, `slots` numbers the text slots of `wrapper` by identity."""
    wrapper_items, page_items, pairs = _aligned_to(wrapper, items)
    for x, y in pairs:
        own, found = wrapper_items[x], page_items[y]
        if own[2] == TEXT:
            for member in found[4]:
                out[member] = slots[id(own)]
        else:
            place(own[3], found[3], slots, out)


def _aligned_to(wrapper: list, items: list) -> tuple[list, list, list[tuple[int, int]]]:
    """Like `aligned`, but the wrapper keeps its items; groups of the page that it has not are taken apart."""
    groups = [item for item in wrapper if item[2] == GROUP]
    known = {key(group) for group in groups}
    parts = [part for item in items for part in (item[3] if item[2] == GROUP and key(item) not in known else [item])]
    items = _with_groups(_adjoining(parts) if len(parts) > len(items) else parts, groups)
    return wrapper, items, common_pairs([key(item) for item in wrapper], [key(item) for item in items])
