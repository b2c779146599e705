"""Layout-aware text of HTML pages.

A tokenizer splits the source into tags, comments and text; a tree builder adds
implied tags (a block ends an open paragraph, an item an item, a cell a cell,
and so on); visibility rules drop what a browser would not show; a renderer
writes the rest with block spacing, list markers and table cells in aligned
columns. Pages are independent of each other, so nothing is shuffled. All
steps are linear in the page's length and use no recursion.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table caption tbody thead tfoot tr ul".split())
#: Blocks with an empty line before and after.
SPACED = frozenset("article blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
HIDDEN = frozenset(
    "head script style template title noscript noframes noembed iframe datalist audio video canvas object"
    " base link meta param source track rp area annotation annotation-xml mphantom".split())
#: Parts of a drawing that are not drawn where they stand.
SVG_HIDDEN = frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split())
#: Elements of HTML that end an open svg or math, and those inside of these that may hold HTML.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre"
    " ruby s small span strong strike sub sup table tt u ul var".split())
INTEGRATION = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
#: Kinds of input that show their value.
VALUED = frozenset(["", *"text search email url tel number submit button reset".split()])
CLOSES_P = BLOCK - frozenset("body dd dt html legend li optgroup option caption tbody thead tfoot tr summary".split()) | {"li", "dd", "dt"}
#: For a start tag: what it ends when open, and what shields an outer one of the kind.
_CELL = ({"td", "th"}, {"table"})
_ROW = ({"tr", "td", "th"}, {"table"})
_PART = ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"})
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": _CELL, "th": _CELL, "tr": _ROW, "thead": _PART, "tbody": _PART, "tfoot": _PART, "caption": _PART, "colgroup": _PART,
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}), "body": ({"head"}, {"html"}),
}
#: Start tags that may stand in a head; any other, or text, ends it, as both </head> and <body> may be left out.
IN_HEAD = frozenset("head html base basefont bgsound link meta title style script noscript noframes template".split())
#: An end tag does not reach beyond these.
SCOPE = frozenset({"table", "td", "th", "caption", "template", "html"})

_TOKEN = re.compile(r"<!--|<[!?/]?")
_NAME = re.compile(r"[^\s/>]+")
_ATTR = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_SKIP = re.compile(r"[\s/]*+")
_END = re.compile(r"[\s/]*+>")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*(?:.*?\*/|.*)|<!--|-->", re.S)
_CSS = re.compile(r""""(?:[^"\\\n]|\\.)*+"?|'(?:[^'\\\n]|\\.)*+'?|[{};]""", re.S)
_DECLARED = re.compile(r"(?:^|;)\s*+(display|visibility)\s*+:\s*+([a-z-]++)[^;!]*+(!\s*+important)?", re.I)
_COMPOUND = re.compile(r"([A-Za-z][\w-]*+|\*)?((?:[.#][\w-]++)*+)")
_RANGE = re.compile(r"(?:([\d.]+)(px|r?em)?\s*(<=?|>=?|=)\s*)?(?:(min|max)-)?(?:device-)?(width|height)(?:\s*(:|<=?|>=?|=)\s*([\d.]+)(px|r?em)?)?")
#: The screen that style sheets are judged for: its size in CSS pixels and other features.
SCREEN = {"width": 1280.0, "height": 800.0}
FEATURES = frozenset(
    ("color", "hover", "pointer", "any-hover", "any-pointer", "hover:hover", "any-hover:hover", "pointer:fine", "any-pointer:fine", "scripting", "scripting:enabled",
     "orientation:landscape", "prefers-color-scheme:light", "prefers-reduced-motion:no-preference", "grid:0", "update:fast"))


class Node:
    __slots__ = ("tag", "attrs", "parts", "parent", "foreign", "inert")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.parts, self.parent = tag, attrs, [], parent
        #: In a drawing or formula, whose tags close as in XML.
        self.foreign = tag in ("svg", "math") or parent is not None and parent.foreign and parent.tag not in INTEGRATION
        #: Where style sheets do not apply: in what only browsers without scripts read, or in a template.
        self.inert = tag in ("noscript", "template") or parent is not None and parent.inert


def _raw_end(html: str, tag: str, at: int) -> tuple[int, int]:
    m = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?+", re.I).search(html, at)
    return (m.start(), m.end()) if m else (len(html), len(html))


def parse(html: str) -> tuple[Node, list[str]]:
    """The tree of a page, and the texts of its style sheets."""
    root = Node("#root", {}, None)
    here, at, sheets, n = root, 0, [], len(html)

    def close(tags, shields):
        nonlocal here
        node, last = here, None
        while node is not root and node.tag not in shields:
            if node.tag in tags:
                last = node
            node = node.parent
        if last is not None:
            here = last.parent

    def text(s):
        nonlocal here
        if here.tag == "head" and s.strip(" \t\n\r\f"):
            here = here.parent
        here.parts.append(s)

    while at < n:
        m = _TOKEN.search(html, at)
        if not m:
            text(unescape(html[at:]))
            break
        if m.start() > at:
            text(unescape(html[at:m.start()]))
        kind, at = m.group(), m.end()
        name = _NAME.match(html, at) if html[at:at + 1].isascii() and html[at:at + 1].isalpha() else None
        if kind == "<" and not name:
            text("<")
        elif kind == "<!--":
            if html.startswith((">", "->"), at):
                at = html.index(">", at) + 1
                continue
            end = html.find("-->", at)
            at = end + 3 if end >= 0 else n
        elif kind in ("<!", "<?") or not name:
            end = html.find(">", at)
            at = end + 1 if end >= 0 else n
        else:
            tag, at = name.group().lower(), name.end()
            attrs: dict = {}
            while not (end := _END.match(html, at)):
                a = _ATTR.match(html, at)
                if not a:
                    at = _SKIP.match(html, at).end()
                    if at >= n:
                        break
                    at += 1  # a character that begins no attribute
                    continue
                value = next((x for x in a.groups()[1:] if x is not None), "")
                attrs.setdefault(a.group(1).lower(), unescape(value) if "&" in value else value)
                at = a.end()
            if not end:
                break  # the page ends inside a tag
            at = end.end()
            if kind == "</":
                node = here
                while node is not root and node.tag != tag and node.tag not in SCOPE:
                    node = node.parent
                if node is not root and node.tag == tag:
                    here = node.parent
                elif tag in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") and tag not in ("body", "html"):
                    node = here
                    while node is not root and node.tag not in (tag, "table"):
                        node = node.parent
                    if node is not root and node.tag == tag:
                        here = node.parent
                elif tag == "p":
                    here.parts.append(Node("p", {}, here))
                elif tag == "br":
                    if here.tag == "head":
                        here = here.parent
                    here.parts.append(Node("br", {}, here))
                continue
            if here.tag == "head":
                if tag in ("head", "html"):
                    continue
                if tag not in IN_HEAD:
                    here = here.parent
            if here.foreign and here.tag not in INTEGRATION and tag in BREAKOUT:
                while here.foreign and here.tag not in INTEGRATION:
                    here = here.parent
            if tag in CLOSES_P:
                close({"p"}, {"table", "td", "th", "caption", "button", "object", "template", "li", "dd"} if tag != "li" else {"ul", "ol", "table", "td", "th"})
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            if tag in ("td", "th") and here.tag in ("table", "tbody", "thead", "tfoot"):
                here.parts.append(row := Node("tr", {}, here))
                here = row
            node = Node(tag, attrs, here)
            here.parts.append(node)
            if node.foreign and "/" in end.group():
                continue
            if tag in RAW:
                a, b = _raw_end(html, tag, at)
                if tag == "style" and _for_screen(attrs.get("media", "")) and attrs.get("type", "").strip().lower() in ("", "text/css") and not node.inert:
                    sheets.append(html[at:a])
                node.parts.append(unescape(html[at:a]) if tag in ("textarea", "title") else html[at:a])
                at = b
            elif tag == "plaintext":
                node.parts.append(html[at:])
                at = n
            elif tag not in VOID:
                here = node
    return root, sheets


def _feature(text: str) -> bool:
    """Whether the screen has a feature; unknown ones it has not."""
    text = text.strip()
    m = _RANGE.fullmatch(text)
    if not m:
        return re.sub(r"\s*:\s*", ":", text) in FEATURES
    low, low_unit, low_op, bound, name, op, high, high_unit = m.groups()
    size = SCREEN[name]
    holds = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "=": lambda a, b: a == b}
    try:
        if low and not holds[low_op](float(low) * (16 if low_unit in ("em", "rem") else 1), size):
            return False
        if not high:
            return bound is None
        op = {None: "=", "min": ">=", "max": "<="}[bound] if op == ":" else op
        return holds[op](size, float(high) * (16 if high_unit in ("em", "rem") else 1))
    except ValueError:
        return False


def _for_screen(media: str) -> bool:
    """Whether a media query list holds for the screen."""
    return not media.strip() or any(map(_query, media.lower().split(",")))


def _query(query: str) -> bool:
    query = query.strip()
    negated = query.startswith("not") and query[3:4].isspace()
    if negated or query.startswith("only") and query[4:5].isspace():
        query = query[4:].strip()
    either = re.search(r"\)\s*or\s*\(", query)
    parts = [p.strip() for p in re.split(r"(?<=\))\s*or\s*(?=\()" if either else r"\band\b", query)]
    holds = (any if either else all)(_feature(p[1:-1]) if p.startswith("(") and p.endswith(")") else p in ("all", "screen") for p in parts)
    return holds != negated


def _applies(prelude: str) -> bool:
    """Whether the rules in a block of an at-rule count."""
    name, _, rest = prelude.lower().partition(" ")
    name, bracket, inner = name.partition("(")
    if name == "@media":
        return _for_screen(bracket + inner + " " + rest)
    return name == "@layer" or name == "@supports" and not rest.strip().startswith("not")


class Style:
    """What the style sheets of a page say about ``display`` and ``visibility``, by tag, class and id.

    Selectors of one tag, classes and ids are followed, others are not. At-rules that
    are not for the screen are skipped. As in a browser, the important, then the more
    specific, then the later of the rules for an element holds. ``forms``: whether
    what fields hold is text of the page.
    """

    def __init__(self, sheets: list[str], forms: bool = True):
        self.forms = forms
        self.rules: dict[str, dict[tuple, dict]] = {}
        self.n = 0
        for sheet in sheets:
            self._read(_COMMENT.sub(" ", sheet))

    def _read(self, css: str) -> None:
        blocks: list[str] = []  # open ones: the selectors, or "" for an at-rule's
        at, skipped, body = 0, 0, ""
        for m in _CSS.finditer(css):
            c = m.group()
            if c == "{":
                if skipped or blocks and blocks[-1]:
                    if not skipped:
                        body += css[at:m.start()] + ";"
                    skipped += 1
                else:
                    prelude = css[at:m.start()].strip()
                    if not prelude.startswith("@"):
                        blocks.append(prelude or "?")
                    elif _applies(prelude):
                        blocks.append("")
                    else:
                        skipped = 1
                at = m.end()
            elif c == "}":
                if skipped:
                    skipped -= 1
                elif blocks and (selectors := blocks.pop()):
                    self._add(selectors, body + css[at:m.start()])
                    body = ""
                at = m.end()
            elif c == ";" and not skipped and not (blocks and blocks[-1]):
                at = m.end()
        if not skipped and blocks and blocks[-1]:
            self._add(blocks[-1], body + css[at:])

    def _add(self, selectors: str, body: str) -> None:
        said = declared(body)
        if said:
            for s in selectors.split(","):
                m = _COMPOUND.fullmatch(s.strip())
                if m and m.group():
                    tag = (m.group(1) or "*").lower()
                    names = re.findall(r"[.#][\w-]+", m.group(2))
                    ids, classes = {x for x in names if x[0] == "#"}, {x for x in names if x[0] == "."}
                    key = next(iter(ids or classes), tag)
                    rank = (sum(x[0] == "#" for x in names), sum(x[0] == "." for x in names), int(tag != "*"), self.n)
                    best = self.rules.setdefault(key, {}).setdefault((tag, frozenset(ids | classes)), {})
                    for name, (hide, important) in said.items():
                        if (important, rank) >= best.get(name, (False, ()))[:2]:
                            best[name] = (important, rank, hide)
                    self.n += 1

    def hides(self, node: Node) -> bool:
        """Whether an element is not shown, but for its kind and its place."""
        a = node.attrs
        hidden = {"display": "hidden" in a and a["hidden"].lower() != "until-found" or node.tag == "dialog" and "open" not in a, "visibility": False}
        best: dict[str, tuple] = {}

        def weigh(name, important, rank, hide):
            if (important, rank) >= best.get(name, (False, ())):
                best[name] = (important, rank)
                hidden[name] = hide

        if self.rules:
            own = {f".{c}" for c in a.get("class", "").split()}
            if "id" in a:
                own.add(f"#{a['id']}")
            for key in ("*", node.tag, *own):
                for (tag, names), said in self.rules.get(key, {}).items():
                    if tag in ("*", node.tag) and names <= own:
                        for name, (important, rank, hide) in said.items():
                            weigh(name, important, (0, *rank), hide)
        if "style" in a:
            for name, (hide, important) in declared(a["style"]).items():
                weigh(name, important, (1,), hide)
        return hidden["display"] or hidden["visibility"]


def declared(body: str) -> dict[str, tuple[bool, bool]]:
    """Of display and visibility, what a list of declarations says last: (hide, important)."""
    out: dict[str, tuple[bool, bool]] = {}
    for name, value, important in _DECLARED.findall(body):
        name, value = name.lower(), value.lower()
        if value not in ("inherit", "revert", "revert-layer") and bool(important) >= out.get(name, (False, False))[1]:
            out[name] = (value == "none" if name == "display" else value in ("hidden", "collapse"), bool(important))
    return out


def visible(node: Node, style: Style) -> bool:
    a = node.attrs
    if node.tag in HIDDEN or node.foreign and node.tag in SVG_HIDDEN:
        return False
    if node.tag in ("textarea", "select") and not style.forms:
        return False
    if node.tag == "input" and a.get("type", "").lower() == "hidden" or style.hides(node):
        return False
    if node.tag == "details" or node.parent is not None and node.parent.tag == "details" and "open" not in node.parent.attrs and node.tag != "summary":
        return node.tag == "details"
    return True


def _options(select: Node, style: Style) -> list[Node]:
    """The options that a list shows: all if it is open, or else the selected one, or else the first."""
    found, todo = [], [iter(select.parts)]
    while todo:
        part = next(todo[-1], None)
        if part is None:
            todo.pop()
        elif isinstance(part, Node) and visible(part, style):
            if part.tag == "option":
                found.append(part)
            else:
                todo.append(iter(part.parts))
    if "multiple" in select.attrs or _int(select.attrs.get("size"), 1) > 1:
        return found
    chosen = [o for o in found if "selected" in o.attrs][-1:]
    return chosen or [o for o in found if "disabled" not in o.attrs][:1] or found[:1]


class Lines:
    """Collects lines: white space runs become one space, blocks start lines, spaced blocks leave one empty line."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = False
        self.mark = ""
        self.indent = 0

    def text(self, s: str, pre: bool = False) -> None:
        if pre:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self._put(first)
            for line in rest:
                self.line(keep=True)
                self._put(line)
            return
        words = _SPACE.sub(" ", s)
        if not words:
            return
        lead, tail, words = words[0] == " ", words[-1] == " ", words.strip(" ")
        if not words:
            self.space = True
            return
        if (lead or self.space) and self.parts:
            self.parts.append(" ")
        self._put(words)
        self.space = tail

    def _put(self, s: str) -> None:
        if s:
            self.parts.append(s)

    def line(self, gap: bool = False, keep: bool = False) -> None:
        s = "".join(self.parts)
        self.parts, self.space = [], False
        if s.strip() or keep:
            if self.gap and self.lines and self.lines[-1] and not self.mark_only():
                self.lines.append("")
            self.gap = False
            pad = "  " * self.indent
            if self.mark:
                pad, self.mark = "  " * (self.indent - 1) + self.mark, ""
            self.lines.append((pad + s).rstrip())
        self.gap = self.gap or gap

    def mark_only(self) -> bool:
        return self.indent > 1

    def block(self, lines: list[str]) -> None:
        """Ready lines of a table or the like, with an empty line around."""
        self.line(gap=True)
        if any(x.strip() for x in lines):
            if self.lines and self.lines[-1]:
                self.lines.append("")
            pad = "  " * self.indent
            self.lines.extend((pad + x).rstrip() for x in lines)
            self.gap = True


def _cells(table: Node, rules: Style) -> tuple[list[Node], list[list[Node]]]:
    """Captions and rows of a table; whatever else it holds counts as a row of its own."""
    captions, rows, todo = [], [], [iter(table.parts)]
    while todo:
        part = next(todo[-1], None)
        if part is None:
            todo.pop()
        elif isinstance(part, str):
            if part.strip():
                rows.append([_wrap(part, table)])
        elif visible(part, rules):
            if part.tag == "caption":
                captions.append(part)
            elif part.tag in ("thead", "tbody", "tfoot"):
                todo.append(iter(part.parts))
            elif part.tag == "tr":
                rows.append([c if isinstance(c, Node) else _wrap(c, part) for c in part.parts
                             if (visible(c, rules) if isinstance(c, Node) else c.strip())])
            elif part.tag not in ("col", "colgroup"):
                rows.append([part])
    return captions, rows


def _wrap(text: str, parent: Node) -> Node:
    node = Node("td", {}, parent)
    node.parts.append(text)
    return node


def _span(cell: Node) -> int:
    value = cell.attrs.get("colspan", "1").strip()
    return min(1000, max(1, int(value))) if value.isascii() and value.isdigit() and len(value) < 6 else 1


def _grid(captions: list[list[str]], rows: list[list[tuple[int, list[str]]]]) -> list[str]:
    """Rows of cells in aligned columns, two spaces apart; a cell of several lines takes several lines."""
    width: dict[int, int] = {}
    for row in rows:
        col = 0
        for span, lines in row:
            if span == 1:
                width[col] = max(width.get(col, 0), max(map(len, lines), default=0))
            col += span
    out = [line for c in captions for line in c]
    for row in rows:
        for k in range(max((len(lines) for _, lines in row), default=0)):
            parts, col = [], 0
            for span, lines in row:
                w = sum(width.get(c, 0) + 2 for c in range(col, col + span))
                parts.append((lines[k] if k < len(lines) else "").ljust(w - 2) + "  ")
                col += span
            out.append("".join(parts).rstrip())
    return out


def render(html: str, forms: bool = False) -> str:
    """All visible text of a page; with ``forms`` also what its fields hold."""
    root, sheets = parse(html)
    rules = Style(sheets, forms)
    out = Lines()
    # a stack of generators in place of recursion; a table cell is rendered into Lines of its own
    done: list = [out]
    todo = [_render(root, out, rules, 0)]
    while todo:
        step = next(todo[-1], None)
        if step is None:
            todo.pop()
        else:
            todo.append(_render(*step))
    done[0].line()
    return "\n".join(done[0].lines)


def _render(node: Node, out: Lines, rules: Style, flags: int):
    """Writes a node to ``out``; yields the calls for its children. flags: 1 within pre, 2 in a drawing outside its texts."""
    tag = node.tag
    if tag == "table":
        captions, rows = _cells(node, rules)
        texts, grid = [], []
        for c in captions:
            lines = Lines()
            yield from _inner(c, lines, rules, flags)
            lines.line()
            texts.append(lines.lines)
        for row in rows:
            cells = []
            for c in row:
                lines = Lines()
                if c.tag in ("td", "th"):
                    yield from _inner(c, lines, rules, flags)
                else:
                    yield c, lines, rules, flags
                lines.line()
                cells.append((_span(c), lines.lines))
            grid.append(cells)
        out.block(_grid(texts, grid))
        return
    if tag == "br":
        out.line(keep=bool(out.parts) or bool(flags & 1))
        return
    if tag == "hr":
        out.line(gap=True)
        return
    if tag == "input":
        if rules.forms and node.attrs.get("type", "").strip().lower() in VALUED:
            yield from _field(node, [node.attrs.get("value", "")], out, rules, 0)
        return
    if tag == "textarea":
        yield from _field(node, [p.removeprefix("\n") for p in node.parts if isinstance(p, str)], out, rules, 1)
        return
    if tag == "select":
        shown = _options(node, rules)
        for o in shown:
            if len(shown) > 1:
                out.line()
            yield from _field(o, o.parts, out, rules, 0)
        if len(shown) > 1:
            out.line()
        return
    if node.foreign and tag in ("svg", "text", "foreignobject"):
        yield from _field(node, node.parts, out, rules, flags | 2 if tag == "svg" else flags & ~2)
        return
    block = tag in BLOCK
    nested = tag in ("ul", "ol", "menu", "dir") and out.indent > 0
    if block:
        out.line(gap=tag in SPACED and not nested)
    deeper = tag in ("li", "dd", "blockquote")
    if tag == "li":
        out.indent += 1
        out.mark = "- "
        if node.parent is not None and node.parent.tag == "ol":
            out.mark = f"{_number(node)}. "
    elif deeper:
        out.indent += 1
    if tag == "pre":
        flags |= 1
    yield from _inner(node, out, rules, flags)
    if block:
        out.line(gap=tag in SPACED and not nested)
    if deeper:
        out.indent -= 1
        if tag == "li":
            out.mark = ""


def _field(node: Node, parts: list, out: Lines, rules: Style, flags: int):
    """Parts of a node, set off by spaces from what stands beside it."""
    if flags & 1 and out.parts:
        out.parts.append(" ")
        out.space = False
    else:
        out.text(" ")
    inside = Node(node.tag, node.attrs, node.parent)
    inside.parts = parts
    yield from _inner(inside, out, rules, flags)
    out.text(" ")


def _inner(node: Node, out: Lines, rules: Style, flags: int):
    n = 0
    for part in node.parts:
        if isinstance(part, str):
            if node.tag == "details" and "open" not in node.attrs or flags & 2:
                continue
            out.text(part, bool(flags & 1))
        elif visible(part, rules):
            if part.tag == "li" and node.tag == "ol":
                n = _int(part.attrs.get("value"), n + 1 if n or "start" not in node.attrs else _int(node.attrs["start"], 1))
                part.attrs["#number"] = str(n)
            yield part, out, rules, flags


def _int(text: str | None, default: int) -> int:
    text = (text or "").strip()
    return int(text) if text.lstrip("-").isdigit() and text.isascii() and len(text) < 10 and text.count("-") == (text[0] == "-") else default


def _number(node: Node) -> int:
    return int(node.attrs.get("#number", "1"))


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", carry: list[str] | None = None,
                 forms: bool = True) -> DataFrame:
    """``(page_id, the columns of carry, text)`` for every row of ``pages``; ``forms`` as for ``render``.

    A null page has a null text, an empty one an empty text. Null ids and repeated rows
    are rows of their own; other columns are not read. An empty table gives no rows.
    """
    carry = carry or []
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"), *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    schema = T.StructType([rows.schema["page_id"], T.StructField("text", T.StringType()), *[rows.schema[f"carry_{i}"] for i in range(len(carry))]])

    def run(batches):
        for batch in batches:
            texts = [None if h is None else render(h, forms) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *batch.columns[2:]], names=schema.fieldNames())

    return rows.mapInArrow(run, schema).select("page_id", *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)], "text")
