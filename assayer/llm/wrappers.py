"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

Pages of one host come from few templates.  Their token streams are aligned
one after the other: where texts differ there is a slot, where tags differ
there is an optional group, and what follows itself is a repeated group.  The
expression that is left, with tags, texts, ``#text`` slots, ``( )?`` and
``( )+`` but no alternatives, is a wrapper.  Pages whose containers have little
in common are of different templates and have wrappers of their own.  Every
page counts: wrappers of parts of a template's pages are aligned like pages,
so a template of any size is inferred in many tasks.  A wrapper says which
element holds the article, and which texts around it are the same on its
pages; with that of its template each page of the host is read whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, ship

#: Pages are of one template if they share so much of their containers.
ALIKE = 0.6
#: Up to so many bytes of wrappers are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
#: Elements nested deeper count for inference as parts of the one at this depth.
DEEPEST = 100
#: On so many pages at least a text must be the same to count as part of the template, and on this share of them.
SAME_ON, SAME_SHARE = 4, 0.9
#: More siblings than this are no longer held in order, and of their keys the rarer ones by name alone.
WIDEST = 64

# Elements by their role in HTML; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table"
    " tbody td tfoot th thead title tr ul".split()
)
NOT_TEXT = frozenset(
    "head nav footer aside form menu dialog button select option datalist object canvas audio video".split()
) | RAW
# A new one of these ends an open one, unless an element of the second set stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# Words in class, id and role that mark what is not the article; fixed values.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice notices alert menu menus nav navbar navigation navigational breadcrumb breadcrumbs sidebar"
    " sidebars aside complementary comment comments commentlist disqus respond replies reply share sharing social"
    " related recommended footer contentinfo masthead newsletter subscribe subscription popup modal overlay dialog"
    " login signin signup search searchform form widget widgets copyright legal pagination pager skip toolbar".split()
)
SITE_HEADER = frozenset({"header"})
# Inside an article only these, and only by whole names of their classes or roles, are set aside; fixed values.
CONTAINERS = frozenset("div section aside ul ol dl table article header footer details figure".split())
# Words that may stand beside those in a class's name, and ids of readers' comments; fixed values.
NEUTRAL = frozenset("area bar block box button buttons container form group inner item items links list outer panel"
                    " section thread title widget wrap wrapper".split())
READERS = frozenset("comment comments commentlist disqus respond replies".split())
ARTICLE_WORDS = frozenset("article post entry story content articlebody".split())
TELLING = AROUND | SITE_HEADER

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
MARK = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


@dataclass(frozen=True)
class Tag:
    """An element as the wrapper sees it: its name and its marks, and whether these set it outside the article."""

    name: str
    signature: str
    words: frozenset
    hidden: bool
    aside: bool = False  # by whole names, as they count inside an article


_TAGS: dict[str, Tag] = {}


def tag_of(name: str, rest: str) -> Tag:
    key = f"{name} {rest}"
    if (found := _TAGS.get(key)) is None:
        if len(_TAGS) > 20_000:
            _TAGS.clear()
        name = name.lower()
        marks = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in MARK.finditer(rest)}
        words = frozenset(w for v in marks.values() for w in re.split("[^a-z0-9]+", v) if w)
        label = f".{'.'.join(marks['class'].split())}" if marks.get("class") else ""
        hidden = bool(rest and HIDDEN.search(rest))
        found = _TAGS[key] = Tag(name, name + label, words, hidden, name in CONTAINERS and set_aside(marks))
    return found


def set_aside(marks: dict[str, str]) -> bool:
    """Whether a whole class or role says so, each word of it, or an id of readers' comments."""

    def all_of(value: str, telling: frozenset) -> bool:
        parts = {w for w in re.split("[^a-z0-9]+", value) if w}
        return bool(parts & telling) and parts <= telling | NEUTRAL

    whole = [*marks.get("class", "").split(), *marks.get("role", "").split()]
    return any(all_of(value, AROUND) for value in whole) or all_of(marks.get("id", ""), READERS)


def events(html: str) -> Iterator[tuple[str, Tag | str]]:
    """("open", tag), ("close", name), ("void", tag) and ("text", raw text) of a page, elements closed as HTML has it."""
    stack: list[str] = []
    opened: dict[str, int] = {}
    position, last_end = 0, html.rfind(">")

    def close() -> tuple[str, str]:
        name = stack.pop()
        opened[name] -= 1
        return "close", name

    while position < len(html):
        if position > last_end:  # no tag ends any more
            if not html.startswith("<!", position):
                yield "text", html[position:]
            break
        match = TOKEN.match(html, position)
        position = match.end()
        if (text := match["text"]) is not None:
            yield "text", text
            continue
        if (name := match["name"]) is None:
            continue
        name = name.lower()
        if match["close"]:
            if opened.get(name):
                while stack[-1] != name:
                    yield close()
                yield close()
            elif name == "br":
                yield "void", tag_of("br", "")
            continue
        tag = tag_of(name, match["rest"])
        if name in VOID:
            yield "void", tag
            continue
        if name in ENDS or name in BLOCK:
            ended, within = ENDS.get(name, ((), ()))
            for place in range(len(stack) - 1, -1, -1):
                open_name = stack[place]
                if open_name == "p" and name in BLOCK or open_name in ended:
                    while len(stack) > place:
                        yield close()
                elif open_name in within or open_name in BLOCK:
                    break
        if name in RAW:
            # Its content is not markup; it ends at its own end tag.
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, position)
            position = end.end() if end else len(html)
            continue
        stack.append(name)
        opened[name] = opened.get(name, 0) + 1
        yield "open", tag
    while stack:
        yield close()


# ---- inference


@dataclass
class Node:
    """A part of a wrapper: an element, a group of siblings (no tag), or a text.

    ``text`` leads by ``votes`` over all others in its place; a text on the
    share of the pages that makes it the template's always does.  The children
    of a ``loose`` node are one of each key, to come in any order.
    """

    tag: Tag | None = None
    children: list[Node] = field(default_factory=list)
    is_text: bool = False
    text: str | None = None
    chars: int = 0
    pages: int = 1
    optional: bool = False
    repeated: bool = False
    votes: int = 1
    loose: bool = False

    @property
    def fixed(self) -> str | None:
        """The text that stands in this place; None in a slot."""
        return self.text if self.votes >= (2 * SAME_SHARE - 1) * self.pages else None

    @property
    def key(self) -> str:
        if self.is_text:
            return "#"
        return self.tag.signature if self.tag else "(" + " ".join(c.key for c in self.children) + ")"

    def expression(self) -> str:
        if self.is_text:
            inner = "#text" if self.fixed is None else self.fixed
        else:
            inner = "".join(c.expression() for c in self.children)
            inner = f"({inner})*" if self.loose else inner
            if self.tag:
                inner = f"<{self.tag.signature}>{inner}</{self.tag.name}>"
        mark = "+" if self.repeated else ""
        mark = "?" if self.optional and not mark else "*" if self.optional else mark
        return f"({inner}){mark}" if mark else inner


def parsed(html: str) -> Node:
    """A page as a wrapper of itself, its repeated siblings folded."""
    root = Node(Tag("", "", frozenset(), False))
    path = [root]
    for kind, value in events(html):
        if kind == "text":
            text = " ".join(unescape(value).split())
            if text:
                last = path[-1].children[-1] if path[-1].children else None
                if last is not None and last.is_text:
                    last.text, last.chars = f"{last.text} {text}", last.chars + len(text)
                else:
                    path[-1].children.append(Node(is_text=True, text=text, chars=len(text)))
        elif kind == "open":
            if len(path) > DEEPEST:
                path.append(path[-1])
                continue
            node = Node(value)
            path[-1].children.append(node)
            path.append(node)
        elif kind == "void":
            path[-1].children.append(Node(value))
        else:
            done = path.pop()
            done.children = folded(done.children)
    root.children = folded(root.children)
    return root


def folded(nodes: list[Node]) -> list[Node]:
    """Siblings in which one, two or three that follow themselves have become a repeated group."""
    found: list[Node] = []
    at = 0
    keys = [n.key for n in nodes]
    while at < len(nodes):
        for width in (1, 2, 3):
            unit = keys[at : at + width]
            times = 1
            while keys[at + times * width : at + (times + 1) * width] == unit:
                times += 1
            if times > 1 and unit != ["#"]:
                group = nodes[at : at + width]
                for k in range(1, times):
                    group = [merged(a, b) for a, b in zip(group, nodes[at + k * width : at + (k + 1) * width])]
                whole = group[0] if width == 1 else Node(None, group)
                whole.repeated = True
                found.append(whole)
                at += times * width
                break
        else:
            found.append(nodes[at])
            at += 1
    return found


def merged(a: Node, b: Node) -> Node:
    """One node for two of the same key: differing texts make a slot, children are aligned."""
    loose = a.loose or b.loose
    children = loosened(a.children + b.children) if loose else aligned(a.children, b.children)
    if not loose and len(children) > WIDEST:
        loose, children = True, loosened(children)
    text, votes = a.text, a.votes + b.votes
    if a.text != b.text:  # with as many votes for each, one leads by none
        text, votes = max((a.votes, a.text or ""), (b.votes, b.text or ""))[1], abs(a.votes - b.votes)
    return Node(
        a.tag,
        children,
        a.is_text,
        text,
        a.chars + b.chars,
        a.pages + b.pages,
        a.optional or b.optional,
        a.repeated or b.repeated,
        votes,
        loose,
    )


def loosened(nodes: list[Node]) -> list[Node]:
    """One node for each key, to come in any order and number: ``(a?b?c?)*`` has no alternatives either.

    So a wrapper does not grow with its pages.  Of too many keys (classes that
    name a page) the rarer ones become one by name; nothing of them is lost
    but their classes, and what has most of the text or pages is not rare.
    """
    singles: list[Node] = []
    for node in nodes:
        singles += node.children if node.tag is None and not node.is_text else [node]
    if any(n.tag is None and not n.is_text for n in singles):
        return loosened(singles)
    common = max((n.pages for n in singles), default=0) / 2

    def key(node: Node) -> str:
        return f"#{node.fixed or ''}" if node.is_text and node.pages >= common else node.key

    def gathered(nodes: list[Node]) -> list[Node]:
        own: dict[str, Node] = {}
        for node in nodes:
            node.optional = True
            own[place] = merged(own[place], node) if (place := key(node)) in own else node
        return list(own.values())

    found = gathered(singles)
    if len(found) > WIDEST:
        by_chars = {id(n) for n in sorted(found, key=lambda n: (-n.chars, key(n)))[: WIDEST // 4]}
        by_pages = {id(n) for n in sorted(found, key=lambda n: (-n.pages, key(n)))[: WIDEST // 4]}
        for node in found:
            if id(node) not in by_chars | by_pages:
                if node.is_text:
                    node.text, node.votes = None, 0
                else:
                    node.tag = any_class(node.tag)
        found = gathered(found)
    return found


def any_class(tag: Tag) -> Tag:
    """An element by its name, if HTML has it, and by how it is judged, whatever its class."""
    name = tag.name if tag.name in BLOCK | NOT_TEXT or tag.name in ("a", "span") else "*"
    words = frozenset([*["ad"] * bool(tag.words & AROUND), *["header"] * bool(tag.words & SITE_HEADER)])
    label = f".*{len(words)}{int('ad' in words)}{tag.hidden:d}{tag.aside:d}"
    label += ".ad" * bool(AROUND.intersection(tag.signature.split(".")[1:]))
    return Tag(name, name + label, words, tag.hidden, tag.aside)


def aligned(left: list[Node], right: list[Node]) -> list[Node]:
    """Two sequences of siblings as one; what has no counterpart is optional."""
    found: list[Node] = []
    i = j = 0
    keys, others = [n.key for n in left], [n.key for n in right]
    if keys == others:
        return [merged(x, y) for x, y in zip(left, right)]
    matcher = SequenceMatcher(None, keys, others, autojunk=False)
    for a, b, size in matcher.get_matching_blocks():
        for node in (*left[i:a], *right[j:b]):
            node.optional = True
            found.append(node)
        found += [merged(x, y) for x, y in zip(left[a : a + size], right[b : b + size])]
        i, j = a + size, b + size
    return found


def packed(node: Node) -> str:
    """A wrapper as text, to be aligned in another task."""

    def lists(node: Node) -> list:
        tag = node.tag and [node.tag.signature, *sorted(node.tag.words & TELLING)]
        marks = (node.is_text, node.optional, node.repeated, node.loose, *(node.tag and (node.tag.hidden, node.tag.aside) or ()))
        bits = sum(1 << k for k, mark in enumerate(marks) if mark)
        return [tag, bits, node.text, node.chars, node.pages, node.votes, [lists(c) for c in node.children]]

    return json.dumps(lists(node), separators=(",", ":"))


def unpacked(text: str) -> Node:
    def node(tag: list | None, bits: int, text: str | None, chars: int, pages: int, votes: int, children: list) -> Node:
        is_text, optional, repeated, loose, hidden, aside = (bool(bits >> k & 1) for k in range(6))
        own = tag and Tag(tag[0].split(".")[0], tag[0], frozenset(tag[1:]), hidden, aside)
        return Node(own, [node(*c) for c in children], is_text, text, chars, pages, optional, repeated, votes, loose)

    return node(*json.loads(text))


def infer(pages: list[str]) -> Node | None:
    """The wrapper of some pages of one host, aligned one after the other."""
    wrapper: Node | None = None
    for html in pages:
        page = parsed(html)
        wrapper = page if wrapper is None else merged(wrapper, page)
    return wrapper


OUTLINE = re.compile(r"<(body|main|article|div|section|table|header|footer|nav|aside|ul|ol|form)\b([^>]*)>", re.I)


def skeleton(html: str) -> frozenset:
    """The containers of a page, by name and class."""
    return frozenset(tag_of(m[1], m[2]).signature for m in OUTLINE.finditer(html))


def likeness(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def around(tag: Tag, in_article: bool, by_marks: bool = True) -> bool:
    """Whether an element is not part of an article by its name or marks.

    Outside an article any word of its class, id or role counts.  Inside, where
    ids and classes also name what the text is about, only containers are
    judged, by whole names; a header inside the article is part of it.
    """
    if tag.name in NOT_TEXT or tag.hidden:
        return True
    if tag.name in ("html", "body", "main"):
        return False
    if tag.name == "article":  # words like "comments-open" say nothing against it
        return bool(AROUND.intersection(tag.signature.split(".")[1:]))
    if in_article:
        return tag.aside
    if by_marks and tag.words & AROUND:
        return True
    return tag.name == "header" or bool(tag.words & SITE_HEADER)


def decided(wrapper: Node | None, pages: int) -> dict:
    """What a wrapper says: the signature of the element that holds the article, and the template's own texts.

    An ``article`` element is taken at its word, then ``main``; otherwise it
    is the innermost element with nine tenths of the text in slots, links left
    out, one whose marks call it an article first.
    """
    if wrapper is None:
        return {"container": "", "same": []}
    elements: list[tuple[int, str, str]] = []
    same: list[str] = []

    def walk(node: Node, depth: int, in_article: bool, linked: bool = False) -> int:
        if node.is_text:
            if node.fixed is not None and pages >= SAME_ON and node.pages >= SAME_SHARE * pages and not in_article:
                same.append(node.fixed)
                return 0
            return 0 if linked else node.chars  # lists of links are no article
        if node.tag and around(node.tag, in_article):
            return 0
        name = node.tag.name if node.tag else ""
        linked = linked or name == "a"
        total = sum(walk(c, depth + 1, in_article or name == "article", linked) for c in node.children)
        if node.tag and name not in ("", "html", "body", "p", "li") and ".*" not in node.tag.signature:
            elements.append((total, depth, node.tag.signature))
        return total

    total = walk(wrapper, 0, False)
    names = {}
    for chars, _, signature in elements:
        names[signature] = names.get(signature, 0) + chars
    for kind in ("article", "main"):
        own = {s: n for s, n in names.items() if s.split(".")[0] == kind and n}
        if own:
            return {"container": max(own, key=own.get) if len(own) == 1 else kind, "same": []}
    large = [(depth, signature) for chars, depth, signature in elements if chars >= 0.9 * total and total]
    named = [x for x in large if set(re.split("[^a-z0-9]+", x[1])) & ARTICLE_WORDS]
    return {"container": max(named or large, default=(0, ""))[1], "same": same}


# ---- extraction


def _is(tag: Tag, container: str) -> bool:
    return tag.signature == container or tag.name == container


def extract(html: str | None, container: str = "", same: frozenset = frozenset()) -> str:
    """The main text of a page: the texts of the container's blocks, or of all blocks where the page has none."""
    if not html:
        return ""
    for place in dict.fromkeys((container or "article", "article", "main", "")):
        if not place or re.search(f"<{place.split('.')[0]}", html, re.I):
            # If nothing is left, the marks of what stands around the article are not to be believed.
            if text := _read(html, place, same) or _read(html, place, same, by_marks=False):
                return text
    return ""


def _read(html: str, container: str, same: frozenset, by_marks: bool = True) -> str:
    blocks: list[str] = []
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text and (container or text not in same):
                blocks.append(text)
            pieces.clear()

    # (banned, inside) for each open element.
    states = [(False, not container)]
    in_article = [False]
    for kind, value in events(html):
        if kind == "text":
            if states[-1] == (False, True):
                pieces.append(value)
        elif kind == "open":
            if value.name in BLOCK:
                flush()
            banned, inside = states[-1]
            within = in_article[-1] or inside and bool(container)
            banned = banned or around(value, within, by_marks or within)
            states.append((banned, inside or not banned and _is(value, container)))
            in_article.append(in_article[-1] or value.name == "article")
        elif kind == "close":
            if value in BLOCK:
                flush()
            states.pop()
            in_article.pop()
        elif value.name in BLOCK:
            flush()
    flush()
    return " ".join(blocks)


def host(url: str = "url") -> Column:
    """The host of a URL in lower case, without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches, the last column a text that may be long."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) >= 1000 or size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    for batch in batches:
        for row in zip(*batch.columns):
            yield [cell.as_py() for cell in row]


def _small(df: DataFrame, *texts: str) -> DataFrame:
    """The same rows, to be broadcast if these columns are small."""
    size = df.agg(F.sum(sum((F.length(c) for c in texts), F.lit(0)))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def outline_of(html: str) -> str:
    return " ".join(sorted(skeleton(html)))


def like_templates(rows: Iterator[list]) -> Iterator[tuple]:
    """(host, pages, outline, template) of rows (host, outline, pages) in order of the host.

    An outline goes with the earlier template that is most like it; where none
    is alike it is a template of its own.  Templates are looked up by a prefix
    of their signatures, long ones first: of two sets with ALIKE in common
    the prefixes meet.
    """
    of, templates, holding = None, {}, {}
    for name, outline, pages in rows:
        if name != of:
            of, templates, holding = name, {}, {}
        own = frozenset(outline.split())
        ordered = sorted(own, key=lambda x: (-len(x), x)) or [""]
        prefix = ordered[: len(ordered) - int(ALIKE * len(ordered)) + 1]
        near = max(
            {t: None for x in prefix for t in holding.get(x, ())}, key=lambda t: (likeness(templates[t], own), t), default=None
        )
        if near is None or likeness(templates[near], own) < ALIKE:
            templates[near := outline] = own
            for x in prefix:
                holding.setdefault(x, []).append(outline)
        yield name, pages, outline, near


def find_templates(pages: DataFrame) -> DataFrame:
    """(host, pages, outline, template) of the outlines of all pages (host, html), those of the most pages first."""
    named = pa.schema([("host", pa.string()), ("outline", pa.string())])
    told = pa.schema([("host", pa.string()), ("pages", pa.int64()), ("outline", pa.string()), ("template", pa.string())])

    def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((name, outline_of(html)) for name, html in _cells(batches)), named)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(like_templates(_cells(batches)), told)

    counted = pages.select("host", "html").mapInArrow(outlines, "host string, outline string").groupBy("host", "outline").count()
    ranked = counted.repartition("host").sortWithinPartitions("host", F.desc("count"), "outline")
    return ranked.mapInArrow(work, "host string, pages bigint, outline string, template string")


def _aligned_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, int, Node]]:
    """(keys, pages, wrapper) of each run of rows (*keys, pages, wrapper) of equal keys."""
    keys, pages, wrapper = None, 0, None
    for *own, count, tree in _cells(batches):
        if own == keys:
            pages, wrapper = pages + count, merged(wrapper, unpacked(tree))
            continue
        if wrapper is not None:
            yield keys, pages, wrapper
        keys, pages, wrapper = own, count, unpacked(tree)
    if wrapper is not None:
        yield keys, pages, wrapper


def infer_hosts(pages: DataFrame) -> DataFrame:
    """(host, outline, template, pages, expression, said): wrappers from all pages, one row for each outline of a host.

    ``said`` is the container and the texts of the template that the outline
    goes with.  Pages are dealt to the parts of their template and ordered by
    a hash of their content, so the same pages give the same wrappers however
    they are stored.  There are as many parts as pages in a part.  No task
    holds more than one wrapper and the rows on their way, or the templates
    of one host.
    """
    ship(pages.sparkSession)
    given = pages.select(host().alias("host"), "html").where("html is not null")
    counted = cut(find_templates(given))
    parts = F.ceil(F.sqrt(F.sum("pages"))).alias("parts")
    known = counted.join(counted.groupBy("host", "template").agg(parts), ["host", "template"]).drop("pages")
    trees = pa.schema([("host", pa.string()), ("outline", pa.string()), ("place", pa.int64()), ("tree", pa.string())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((name, outline_of(html), place, packed(parsed(html))) for name, place, html in _cells(batches)), trees)

    read = given.select("host", F.xxhash64("html").alias("place"), "html")
    read = read.mapInArrow(parse, "host string, outline string, place bigint, tree string")
    dealt = read.join(_small(known, "host", "outline", "template"), ["host", "outline"])
    dealt = dealt.withColumn("part", F.pmod("place", "parts"))
    dealt = dealt.repartition("host", "template", "part").sortWithinPartitions("host", "template", "part", "place")
    dealt = dealt.select("host", "template", "part", F.lit(1).cast("bigint").alias("pages"), "tree")
    keys = [("host", pa.string()), ("template", pa.string())]
    aligned_parts = pa.schema([*keys, ("part", pa.int64()), ("pages", pa.int64()), ("tree", pa.string())])
    whole = pa.schema([*keys, ("pages", pa.int64()), ("expression", pa.string()), ("said", pa.string())])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((*own, count, packed(tree)) for own, count, tree in _aligned_runs(batches)), aligned_parts)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((*own, count, t.expression(), json.dumps(decided(t, count))) for own, count, t in _aligned_runs(batches))
        return _batches(found, whole)

    partial = dealt.mapInArrow(align, "host string, template string, part bigint, pages bigint, tree string")
    partial = partial.repartition("host", "template").sortWithinPartitions("host", "template", "part").drop("part")
    found = partial.mapInArrow(decide, "host string, template string, pages bigint, expression string, said string")
    return known.join(found, ["host", "template"]).select("host", "outline", "template", "pages", "expression", "said")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; a null or empty html gives an empty text.

    Pages without a host share their wrappers.  Repeated rows are read each,
    pages of any length whole, each by the wrapper of the template it counts
    for; without what that names, by the page's article or main element, or
    whole but for what its names and marks set aside.
    """
    given = pages.select("page_id", "url", "html")
    known = cut(infer_hosts(given).selectExpr("host as _host", "outline as _outline", "said"))
    known = _small(known, "_host", "_outline", "said")
    page_type, url_type = (given.schema[c].dataType.simpleString() for c in ("page_id", "url"))

    def outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outlines = pa.array([outline_of(html.as_py() or "") for html in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, outlines], ["page_id", "url", "html", "outline"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, tuple] = {}
        for batch in batches:
            texts = []
            for html, said in zip(*batch.columns[2:]):
                html, said = html.as_py() or "", said.as_py() or "{}"
                if said not in read:
                    if len(read) > 1000:
                        read.clear()
                    wrapper = json.loads(said)
                    read[said] = wrapper.get("container", ""), frozenset(wrapper.get("same", ()))
                texts.append(extract(html, *read[said]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    marked = given.mapInArrow(outlined, f"page_id {page_type}, url {url_type}, html string, outline string")
    followed = (host() == F.col("_host")) & (F.col("outline") == F.col("_outline"))
    joined = marked.join(known, followed, "left").select("page_id", "url", "html", "said")
    return joined.mapInArrow(work, f"page_id {page_type}, url {url_type}, text string, n_chars bigint")
