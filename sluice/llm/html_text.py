"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names and attribute words by their role (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp template noscript".split())
DROPPED = frozenset("""head script style noscript template title iframe object svg math canvas audio video map form input button select
 textarea option fieldset label nav footer aside menu dialog""".split())
BLOCKS = frozenset("""address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre search section summary table tbody td tfoot th thead tr ul aside""".split())
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}}
SCOPES = frozenset("html body table td th article main section div aside nav footer form ul ol dl blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PROSE = HEADINGS | frozenset("p blockquote pre ul ol dl table figure details".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOISE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar side-bar comment comments
 comment-list disqus respond reply replies cookie cookies consent gdpr notice banner popup modal overlay newsletter subscribe signup
 share sharing social related recommended breadcrumb breadcrumbs menu navbar navigation nav footer site-footer site-header masthead
 pagination pager toolbar widget skip-link""".split())

READERS = frozenset("comment comments comment-list disqus respond reply replies".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACES = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "parent", "parts", "dropped", "named", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: _Node | None, named: str) -> None:
        self.tag, self.parent, self.named, self.dropped = tag, parent, named, bool(named)
        self.parts: list[_Node | str] = []


def _noise(tag: str, raw: str, inside_article: bool) -> str:
    """Why an element is no part of any article: ``kind`` (its element name), ``hidden``, ``readers`` or ``name`` (its attributes); else empty.

    Words of a class or id stand between blanks, ``_`` and ``-``.
    """
    if tag in DROPPED and tag != "form" or (tag == "header" and not inside_article):
        return "kind"
    if tag in ("body", "html", "main", "article"):
        return ""
    found = "name" if tag == "form" else ""
    for name, value in _ATTRIBUTE.findall(raw) if raw else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            words = set(re.split(r"[\s_]+", value)) | set(re.split(r"[\s_-]+", value))
            if not READERS.isdisjoint(words):
                return "readers"
            if not NOISE.isdisjoint(words):
                found = "name"
        if name == "hidden" or (name, value) == ("aria-hidden", "true") or name == "style" and "display:none" in value.replace(" ", ""):
            return "hidden"
        if name == "role" and value in ROLES:
            found = "name"
    return found


def _weigh_names(root: _Node) -> None:
    """Take back what only a name has dropped where that is most of the page: more text than all that is kept.

    So a page in one form, or in an element of an unlucky class, keeps its article; reader comments come back only where nothing else is.
    """
    sizes: dict[int, int] = {}  # all text in an element that may come back, whatever its names say
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in node.parts if isinstance(p, _Node) and (not p.dropped or p.named in ("name", "readers")))
    for node in reversed(order):
        inner = [p for p in node.parts if isinstance(p, _Node) and id(p) in sizes]
        sizes[id(node)] = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str)) + sum(sizes[id(p)] for p in inner)
    open_, kept = [root], 0
    held: list[_Node] = []
    while open_:
        node = open_.pop()
        kept += sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        for part in node.parts:
            if isinstance(part, _Node) and id(part) in sizes:
                (held if part.dropped else open_).append(part)
        if not open_ and held:  # the kept text is known: look at the largest dropped element
            largest = max(held, key=lambda n: (n.named == "name", sizes[id(n)]))
            if sizes[id(largest)] > kept and (largest.named == "name" or not kept):
                held.remove(largest)
                largest.dropped = False
                open_.append(largest)


def parse(page: str) -> _Node:
    """A tree of elements and text; end tags may be missing or left over. Linear in the page, without recursion."""
    root = _Node("html", None, "")
    stack, at, size = [root], 0, len(page)

    def text(raw: str) -> None:
        if raw:
            stack[-1].parts.append(html.unescape(raw) if "&" in raw else raw)

    def close(names: set[str] | frozenset[str], bounds: frozenset[str]) -> None:
        """Close the innermost open element of these names, and all in it, unless a bound comes first."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in bounds:
                return

    while at < size:
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        text(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        found = _TAG.match(page, start)
        if not found:
            if start + 1 < size and (page[start + 1].isalpha() or page[start + 1] == "/"):
                end = page.find(">", start)  # an unfinished tag, or a stray quote in it
                at = size if end < 0 else end + 1
            else:
                text("<")
                at = start + 1
            continue
        at, tag, raw = found.end(), found[2].lower(), found[3]
        if found[1]:
            if tag == "p" or tag in BLOCKS:
                close({tag}, frozenset({"html"}) if tag in SCOPES else SCOPES - {tag})
            elif tag == "br":
                stack[-1].parts.append(" ")
            else:
                close({tag}, BLOCKS)
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P:
            close({"p"}, SCOPES)
        if tag in SIBLINGS:
            close(SIBLINGS[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
        if tag == "br" or tag == "hr":
            stack[-1].parts.append(" ")
        if tag in VOID:
            continue
        inside = any(n.tag in ("article", "main") for n in stack) if tag == "header" else False
        node = _Node(tag, stack[-1], _noise(tag, raw, inside))
        if tag in RAW:
            ending = re.compile(rf"</{tag}(?=[\s/>]|$)", re.IGNORECASE).search(page, at)
            if ending:
                end = page.find(">", ending.start())
                at = size if end < 0 else end + 1
            else:
                at = size
            continue
        stack[-1].parts.append(node)
        if not raw.endswith("/") or tag in BLOCKS:
            stack.append(node)
    return root


def _in_order(root: _Node) -> list[_Node]:
    """Elements before their descendants, without dropped ones."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(p for p in reversed(node.parts) if isinstance(p, _Node) and not p.dropped)
    return out


def _measure(root: _Node) -> list[_Node]:
    """Characters, tags, link characters, link tags, density and density sum of every element; sums go over block children."""
    order = _in_order(root)
    for node in reversed(order):
        node.chars = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        node.tags = node.link_chars = node.link_tags = 0
        for child in node.parts:
            if isinstance(child, _Node) and not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.chars if child.tag == "a" else child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
    body_share = root.link_chars / max(root.chars, 1)
    for node in reversed(order):
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        plain = max(c - node.link_chars, 1)
        base = math.log(c / plain * node.link_chars + body_share * c + math.e)
        ratio = c / lc * t / lt
        node.density = c / t * math.log(ratio) / math.log(max(base, 1.0 + 1e-9) + 1e-9 if base > 1 else math.e) if c and ratio > 1 else 0.0
        node.total = sum(p.density for p in node.parts if isinstance(p, _Node) and not p.dropped and p.tag in BLOCKS)
    return order


def _mostly_links(node: _Node) -> bool:
    return node.tag == "a" or 2 * node.link_chars > node.chars


def _dense(node: _Node, threshold: float) -> bool:
    return not node.dropped and node.density >= threshold and node.density > 0


def _prose(part: _Node | str) -> bool:
    """Whether a part beside the path is text of an article by its kind: bare text, a paragraph, or an element with a heading."""
    if isinstance(part, str):
        return not part.isspace()
    if part.dropped or not part.chars or _mostly_links(part):
        return False
    return part.tag not in BLOCKS or part.tag in PROSE or any(n.tag in HEADINGS and n.chars and not _mostly_links(n) for n in _in_order(part))


def _titled_article(chosen: _Node) -> _Node | None:
    """Where the main element around a chosen article has others beside it, the only one of them with a heading of the first level."""
    main = chosen.parent
    while main is not None and main.tag != "main":
        main = main.parent
    if main is None or chosen.tag != "article":
        return None
    articles = [n for n in _in_order(main) if n.tag == "article" and n.chars]
    titled = [a for a in articles if any(n.tag == "h1" and n.chars for n in _in_order(a))]
    return titled[0] if len(titled) == 1 else None


def _select(root: _Node) -> _Node:
    """The element that holds the article.

    That is the article or main element around the subtree with the largest density sum. Elsewhere it is the last element on the
    path from this subtree to the body that holds, beside the path, something as dense as the thinnest element on the path, or text
    of its own (:func:`_prose`). It is taken with its headings, short blocks and bare text, which are less dense than any element
    around them; only links and blocks of links that lie beside the path and are thinner than the path stay out.
    """
    _weigh_names(root)
    order = [n for n in _measure(root) if n.tag in BLOCKS]
    best = max(order, key=lambda n: n.total, default=root)
    if best.total <= 0:
        best = root
    path, node = [], best
    while node is not None:
        path.append(node)
        node = node.parent
    whole = [n for n in path if n.tag == "article"] or [n for n in path if n.tag == "main"]
    if whole:
        titled = _titled_article(whole[-1])
        return titled or whole[-1]
    threshold = min(n.density for n in path)
    last = 0
    for i in range(1, len(path)):
        beside = [p for p in path[i].parts if p is not path[i - 1]]
        if any(_prose(p) or isinstance(p, _Node) and _dense(p, threshold) for p in beside):
            last = i
    for i in range(1, last + 1):
        beside = [p for p in path[i].parts if p is not path[i - 1]]
        inline = [p for p in beside if isinstance(p, _Node) and not p.dropped and p.tag not in BLOCKS]
        linked = sum(p.chars if p.tag == "a" else p.link_chars for p in inline)
        menu = 2 * linked > sum(p.chars for p in inline) + sum(len("".join(p.split())) for p in beside if isinstance(p, str))
        for part in beside:
            if isinstance(part, _Node) and not part.dropped and _mostly_links(part) and not _dense(part, threshold):
                part.dropped = part.tag in BLOCKS or menu
    return path[last]


def main_text(page: str | None) -> str:
    """The article of a page: blocks in page order, white space inside a block as one space, blocks joined by two line ends."""
    if not page:
        return ""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        line = _SPACES.sub(" ", "".join(run)).strip()
        if line:
            blocks.append(line)
        run.clear()

    todo: list[_Node | str | None] = [_select(parse(page))]
    while todo:
        part = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            run.append(part)
        elif not part.dropped:
            if part.tag in BLOCKS:
                flush()
                todo.append(None)
            todo.extend(reversed(part.parts))
    flush()
    return "\n\n".join(blocks)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            texts = pa.array([main_text(p.as_py()) for p in part.column(0)], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[1:], texts], names=[*part.schema.names[1:], "text"])


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and ``text``, the main text of the whole page (empty if none), one row per row.

    Every element gets its composite text density: characters per tag, weighted down by the share and number of links. The
    subtree with the largest sum of its blocks' densities is the article; if it lies in an article or main element, that element
    is, and of several articles in a main element the one with the title. Elsewhere it grows to the element that holds all that is as dense as its path to the body, and all text of an article
    around it, without links and blocks of links beside that path. Scripts, forms, navigation and the like are cut out before by
    element name, role and class, unless by their name only and most of the page. A null or empty page has an empty text; repeated rows, ties (the first subtree) and broken markup
    are no errors; an empty table gives an empty result.
    """
    fields = [pages.schema[k] for k in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "text string"])
    return pages.select(html_col, *keep).mapInArrow(_texts, schema)


def code_points(text: Column) -> Column:
    return F.char_length(text).cast("long")
