"""Pages as trees of block elements, with repeated siblings folded into one slot."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import xxhash

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "col", "embed", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
TEXT_LEVEL = set("p li dt dd h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption tr td th summary legend option".split())
CONTAINERS = set(
    "address article aside body center details dialog dir div dl fieldset figure footer form frameset head header hgroup "
    "html main menu nav noscript ol optgroup section select svg table tbody template tfoot thead ul button canvas object".split()
)
BLOCKS = TEXT_LEVEL | CONTAINERS
REGIONS = {"article", "main"}
NEVER_DROPPED = {"html", "body"} | REGIONS
DROPPED_TAGS = set(
    "head nav footer aside form noscript template svg canvas object button select option dialog menu fieldset".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
# Parts of class names and ids of what does not belong to an article.
DROPPED_NAMES = set(
    "ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs footer sidebar aside widget comment comments commentlist disqus respond reply replies notice "
    "notices cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended pagination pager copyright disclaimer toolbar".split()
)
HEADER_NAMES = {"header", "masthead", "banner"}
# Tags that also wrap a whole page.
WRAPPING_TAGS = {"form", "fieldset"}
# An open element that the start of another one ends, looked for up to the given container.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}


def _names(value: str) -> set[str]:
    found = set()
    for name in value.split():
        parts = [p.lower() for p in PART.findall(name)]
        if parts and parts[0] not in ("with", "has", "no", "without"):
            found.update(parts)
    return found


def _drop_mark(name: str, role: str, value: str, words: set[str]) -> str:
    """How sure a drop is: ``!!!`` by a tag or role, ``!!`` by a name of nothing but such words, ``!`` by one word among
    others, as in ``content-sidebar-wrap``, or by a tag that may wrap a page."""
    if (name in DROPPED_TAGS and name not in WRAPPING_TAGS) or name == "header" or role in DROPPED_ROLES:
        return "!!!"
    named = [found for found in map(_names, value.split()) if found]
    return "!!" if any(found <= words for found in named) else "!"


@dataclass
class PageTree:
    """Nodes in page order: key (tag and class names, marked where dropped by what it is), parent, whether dropped by what it is, whether inside an article
    or main element. Blocks: node, text, characters inside links. ``slot`` is the folded node of each node;
    ``keys`` and ``parents`` describe the folded tree."""

    blocks: list[tuple[int, str, int]]
    slot: list[int]
    keys: list[str]
    parents: list[int]

    @property
    def skeleton(self) -> str:
        return "\n".join(f"{p} {k}" for p, k in zip(self.parents, self.keys))


def read_skeleton(skeleton: str) -> tuple[list[int], list[str]]:
    rows = [row.split(" ", 1) for row in skeleton.split("\n")]
    return [int(r[0]) for r in rows], [r[1] for r in rows]


def skeleton_id(skeleton: str) -> str:
    return xxhash.xxh3_128_hexdigest(skeleton)


def parse(html: str | None) -> PageTree:
    """Reads any text as a page; unclosed, wrongly nested and cut tags are put right as browsers do in the main."""
    text = html or ""
    tag, key, parent = ["#page"], ["#page"], [-1]
    stack, open_ = [0], {"#page": 1}
    blocks: list[tuple[int, str, int]] = []
    buffer: list[str] = []
    linked = in_link = 0
    inline_drop: list[str] = []

    def add(raw: str) -> None:
        nonlocal linked
        if inline_drop:
            return
        piece = unescape(raw) if "&" in raw else raw
        buffer.append(piece)
        if in_link:
            linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if buffer:
            joined = " ".join("".join(buffer).split())
            if joined:
                blocks.append((stack[-1], joined, min(linked, len(joined))))
            buffer.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            open_[tag[stack.pop()]] -= 1

    place, end = 0, len(text)
    while place < end:
        found = TAG.search(text, place)
        if found is None:
            add(text[place:])
            break
        if found.start() > place:
            add(text[place : found.start()])
        place = found.end()
        if found[1] is not None:
            add(found[1])
        name = found[3] or found[6]
        if not name:
            continue
        name, closing = name.lower(), found[2] or found[5]
        if name == "a":
            in_link = 0 if closing else 1
            continue
        if name in ("br", "hr"):
            add(" ")
            continue
        if name in RAW and not closing:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(text, place)
            place = end if stop is None else text.find(">", stop.end()) + 1 or end
            continue
        if name in VOID or name in RAW:
            continue
        if name not in BLOCKS:  # inline: matters only when its name marks it as something to drop
            if closing:
                if name in inline_drop:
                    while inline_drop and inline_drop.pop() != name:
                        pass
            elif inline_drop or _drop_inline(name, found[4] or found[7] or ""):
                inline_drop.append(name)
            continue
        flush()
        inline_drop.clear()
        in_link = 0
        if closing:
            if open_.get(name):
                depth = len(stack) - 1
                while tag[stack[depth]] != name:
                    depth -= 1
                pop_to(depth)
            continue
        if open_.get("p") and tag[stack[-1]] == "p":
            pop_to(len(stack) - 1)
        if open_.get("head") and name != "head" and tag[stack[-1]] == "head":
            pop_to(len(stack) - 1)
        ends, within = ENDED_BY.get(name, ((), ()))
        if any(open_.get(e) for e in ends):
            depth, cut = len(stack) - 1, 0
            while depth > 0 and tag[stack[depth]] not in within:
                if tag[stack[depth]] in ends:
                    cut = depth
                depth -= 1
            if cut:
                pop_to(cut)
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(found[4] or found[7] or "")}
        inside = open_.get("article", 0) + open_.get("main", 0) > 0
        value = attributes.get("class", "") + " " + attributes.get("id", "")
        names = _names(value)
        role = attributes.get("role", "").lower()
        dropped = name not in NEVER_DROPPED and (
            name in DROPPED_TAGS
            or role in DROPPED_ROLES
            or bool(names & DROPPED_NAMES)
            or (not inside and (name == "header" or bool(names & HEADER_NAMES)))
        )
        words = DROPPED_NAMES if inside else DROPPED_NAMES | HEADER_NAMES
        mark = _drop_mark(name, role, value, words) if dropped else ""
        tag.append(name)
        key.append(".".join([mark + name, *sorted(names)]))
        parent.append(stack[-1])
        stack.append(len(tag) - 1)
        open_[name] = open_.get(name, 0) + 1
    flush()
    return _folded(tag, key, parent, blocks)


def _drop_inline(name: str, raw: str) -> bool:
    if "class" not in raw and "id" not in raw and "role" not in raw:
        return False
    attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}
    names = _names(attributes.get("class", "") + " " + attributes.get("id", ""))
    return bool(names & DROPPED_NAMES) or attributes.get("role", "").lower() in DROPPED_ROLES


def _folded(tag: list[str], key: list[str], parent: list[int], blocks: list[tuple[int, str, int]]) -> PageTree:
    """Folds siblings of one shape: text-level ones always, containers from the third in a row on."""
    shapes: dict[tuple, int] = {}
    shape, below = [0] * len(tag), [[] for _ in tag]
    for node in range(len(tag) - 1, -1, -1):
        seen = tuple(dict.fromkeys(reversed(below[node])))
        shape[node] = shapes.setdefault((key[node], seen), len(shapes))
        if node:
            below[parent[node]].append(shape[node])
    slots: dict[tuple, int] = {}
    slot, keys, parents = [0] * len(tag), [], []
    latest: dict[int, tuple[int, int, int]] = {}  # shape, run and place in the run of the last container child
    for node in range(len(tag)):
        above = -1 if node == 0 else slot[parent[node]]
        run = place = 0
        if tag[node] in CONTAINERS:
            before = latest.get(parent[node], (-1, -1, 0))
            run, place = (before[1], before[2] + 1) if before[0] == shape[node] else (before[1] + 1, 0)
            latest[parent[node]] = (shape[node], run, place)
        slots_key = (above, shape[node], run, min(place, 1))
        if slots_key not in slots:
            slots[slots_key] = len(keys)
            keys.append(key[node])
            parents.append(above)
        slot[node] = slots[slots_key]
    return PageTree(blocks, slot, keys, parents)
