"""Visible text of web pages, laid out as a reader sees it.

A page becomes a tree and the tree becomes lines:

* Tokens come from one regular expression; comments, declarations and the contents of
  scripts, styles and other raw elements are no text.
* Implied tags: void elements have no end; a start tag that may not stand inside an open
  element closes it (``p`` before a block, ``li`` before ``li``, cells, rows, options, terms),
  but never beyond a table, list or cell it stands in; ``head`` ends at the first text or
  element of a body; a cell outside of a row starts one; an end tag closes what is open inside
  its element, or nothing if there is no such element.
* Visibility: elements that never show (script, template ...), ``hidden``, hidden inputs, what
  a closed ``details`` or ``dialog`` holds, and ``display`` and ``visibility`` by the cascade:
  of the declarations for an element the important ones win, then its ``style``, then the
  more specific selector, then the later one.  Selectors are tags, classes, ids, attributes and
  ``*``, compound or with blanks and ``>`` between; others, such as states, match nothing.
  Rules for other media, or under a condition in brackets such as a width, do not count.
  ``display:none`` hides all within, ``visibility`` is inherited and can be undone within.
* Layout: blocks start a line and paragraphs, headings, lists and tables stand apart; list
  items have their mark or number and are indented by level; cells of a column are padded
  to one width, may have several lines and span columns and rows; ``pre`` keeps its blanks;
  elsewhere white space counts once.

Nulls: a null page has a null text, an empty one an empty text.  An empty table gives an empty one.
Each row is read by itself, whatever its length, so ids, ties and repeated rows need no rule; other
columns are carried along, but for those with a name of the result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .base import query, table

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
CSS = re.compile(r"[{};]|[^{};]+")
EVERY_SCREEN = re.compile(r"(?:only\s+)?(?:all|screen)|not\s+(?!all|screen)[\w-]+|", re.I)
SELECTOR = re.compile(r"""\s*(>|\s)\s*|([.#]?)([\w-]+|\*)|\[\s*([\w-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[\w-]+)\s*)?\]""")
IMPORTANT = re.compile(r"\s*!\s*important\s*\Z", re.I)
DEEPEST = 256  # elements nested deeper become siblings there, as in browsers
BLANKS = re.compile(r"[ \t\n\r\f]+")

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes datalist object audio video canvas svg math".split())
IN_HEAD = frozenset("head base basefont bgsound link meta title noframes script style template noscript".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr article section".split())
BLOCKS = APART | frozenset("address aside center details dialog dd dir div dt fieldset figcaption footer form header hgroup html "
                           "body legend li main menu nav option optgroup search summary tr caption".split())
# A start tag closes these open elements, as far up as the elements of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
CLOSES["tbody"] = CLOSES["tfoot"] = CLOSES["thead"]
CLOSED_BY_BLOCK = BLOCKS - {"option", "optgroup", "tr", "caption", "html", "body", "legend"}
SCOPE = frozenset("table td th caption li dd dt body html button".split())


class Node:
    """An element; ``shown``: it and its contents may be seen, ``drawn``: its own text is (visibility)."""

    __slots__ = ("tag", "attributes", "children", "shown", "drawn")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes, self.shown, self.drawn = tag, attributes, True, True
        self.children: list[Node | str] = []


def _every_screen(media: str) -> bool:
    """Whether a list of media queries holds on any screen."""
    return any(EVERY_SCREEN.fullmatch(query.strip()) for query in media.split(",")) if media.strip() else True


@dataclass(slots=True)
class Compound:
    """One element of a selector; ``child``: the one before it is its parent, else any ancestor."""

    tag: str
    ids: list[str]
    classes: list[str]
    attributes: list[tuple[str, str | None]]
    child: bool

    def matches(self, node: Node, fold: bool) -> bool:
        a = node.attributes
        if self.tag and self.tag != node.tag:
            return False
        own = a.get("id", ""), a.get("class", "")
        own_id, own_classes = (own[0].lower(), own[1].lower().split()) if fold else (own[0], own[1].split())
        return (all(i == own_id for i in self.ids) and all(c in own_classes for c in self.classes)
                and all(k in a and v in (None, a[k]) for k, v in self.attributes))


def _selector(text: str, fold: bool) -> list[Compound] | None:
    """The compounds of a selector from left to right; None for one that is not understood."""
    found = [Compound("", [], [], [], False)]
    text, at, fresh = text.strip(), 0, True
    while at < len(text):
        m = SELECTOR.match(text, at)
        if m is None or m.end() == at:
            return None
        join, kind, name, key, value = m.groups()
        if join:
            if fresh:
                return None
            found.append(Compound("", [], [], [], join == ">"))
            fresh = True
        else:
            if key:
                found[-1].attributes.append((key.lower(), value[1:-1] if value and value[0] in "\"'" else value))
            elif kind:
                (found[-1].ids if kind == "#" else found[-1].classes).append(name.lower() if fold else name)
            elif not fresh:
                return None
            elif name != "*":
                found[-1].tag = name.lower()
            fresh = False
        at = m.end()
    return None if fresh else found


def _declared(text: str) -> list[tuple[str, str, bool]]:
    """``(property, value, important)`` of a declaration of display or visibility."""
    name, colon, value = text.partition(":")
    name = name.strip().lower()
    if not colon or name not in ("display", "visibility"):
        return []
    plain = IMPORTANT.sub("", value)
    return [(name, plain.strip().lower(), plain != value)] if plain.strip() else []


class Styles:
    """Rules of a page on display and visibility, filed by what the last element of a selector must have."""

    def __init__(self, fold: bool) -> None:
        self.fold, self.n = fold, 0
        self.rules: dict[str, list[tuple[list[Compound], tuple, list[tuple[str, str, bool]]]]] = defaultdict(list)

    def read(self, css: str) -> None:
        # Open blocks: the selectors of the rule they stand in, and whether they hold on every screen.
        blocks: list[tuple[str | None, bool]] = [(None, True)]
        plain = re.sub(r"""("[^"\n]*"|'[^'\n]*')|/\*.*?(?:\*/|\Z)""", lambda m: m.group(1) if re.fullmatch(r".[\w-]*.", m.group(1) or "") else
                       "''" if m.group(1) else "", css, flags=re.S)
        held = ""
        for token in [*CSS.findall(plain), ";"]:
            selectors, holds = blocks[-1]
            if token == "{":
                at = re.match(r"\s*@([\w-]+)(.*)", held, re.S)
                if at is None:
                    # A rule within a rule is for a combination of selectors, of which none is known here.
                    blocks.append((held, holds and selectors is None))
                elif at.group(1).lower() == "media":
                    blocks.append((selectors, holds and _every_screen(at.group(2))))
                else:
                    blocks.append((selectors, holds and at.group(1).lower() in ("layer", "supports")))
                held = ""
            elif token in ("}", ";"):
                if selectors is not None and holds and (declared := _declared(held)):
                    self._add(selectors, declared)
                if token == "}" and len(blocks) > 1:
                    blocks.pop()
                held = ""
            else:
                held = token

    def _add(self, selectors: str, declared: list[tuple[str, str, bool]]) -> None:
        for one in re.split(r",(?![^()]*\))", selectors):
            parts = _selector(one, self.fold)
            if parts is None:
                continue
            self.n += 1
            last = parts[-1]
            rank = (sum(len(p.ids) for p in parts), sum(len(p.classes) + len(p.attributes) for p in parts),
                    sum(p.tag != "" for p in parts), self.n)
            key = "#" + last.ids[0] if last.ids else "." + last.classes[0] if last.classes else last.tag or "*"
            self.rules[key].append((parts, rank, declared))

    def declared(self, path: list[Node]) -> dict[str, str]:
        """Winning values for the last node of ``path``."""
        a, best = path[-1].attributes, {}
        if self.rules:
            own_id, classes = a.get("id", ""), a.get("class", "")
            if self.fold:
                own_id, classes = own_id.lower(), classes.lower()
            for key in {"*", path[-1].tag, "#" + own_id, *("." + c for c in classes.split())} & self.rules.keys():
                for parts, rank, declared in self.rules[key]:
                    if self._matches(parts, path):
                        for name, value, important in declared:
                            best[name] = max(best.get(name, ((),)), ((important, False, rank), value))
        for at, text in enumerate(a["style"].split(";") if "style" in a else ()):
            for name, value, important in _declared(text):
                best[name] = max(best.get(name, ((),)), ((important, True, (at,)), value))
        return {name: value for name, (_, value) in best.items()}

    def _matches(self, parts: list[Compound], path: list[Node]) -> bool:
        if not parts[-1].matches(path[-1], self.fold):
            return False
        places = [len(path) - 1]  # where the element after the next one may stand, ascending
        for right, part in zip(reversed(parts), reversed(parts[:-1])):
            open_ = {p - 1 for p in places} if right.child else range(1, places[-1])
            places = sorted(p for p in open_ if p >= 1 and part.matches(path[p], self.fold))
            if not places:
                return False
        return True


def _sheets(node: Node, styles: Styles) -> None:
    for child in node.children:
        if isinstance(child, Node):
            if child.tag == "style":
                if _every_screen(child.attributes.get("media", "")):
                    styles.read("".join(child.children))
            elif child.tag not in ("template", "noscript"):
                _sheets(child, styles)


def _see(path: list[Node], styles: Styles) -> None:
    """Set ``shown`` and ``drawn`` below the last node of ``path``."""
    parent, headed = path[-1], False
    closed = parent.tag == "details" and "open" not in parent.attributes
    for node in parent.children:
        if isinstance(node, str):
            continue
        a = node.attributes
        here = [*path, node]
        values = styles.declared(here) if styles.rules or "style" in a else {}
        unseen = "hidden" in a or node.tag == "dialog" and "open" not in a
        node.shown = not (node.tag in UNSEEN or node.tag == "input" and a.get("type", "").lower() == "hidden"
                          or (values["display"] == "none" if "display" in values else unseen))
        if closed:
            node.shown &= node.tag == "summary" and not headed
            headed |= node.tag == "summary"
        node.drawn = {"visible": True, "initial": True, "hidden": False, "collapse": False}.get(values.get("visibility", ""), parent.drawn)
        if node.shown:
            _see(here, styles)
    if closed or not parent.drawn:
        parent.children = [c for c in parent.children if isinstance(c, Node)]


def build(html: str) -> Node:
    """The tree of a page; its nodes know whether they can be seen, and text that cannot be by visibility is gone."""
    root = Node("#root", {})
    path, at = [root], 0

    def close(tags: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        for i in range(len(path) - 1, 0, -1):
            if path[i].tag in scope:
                return
            if path[i].tag in tags:
                del path[i:]
                if not any(p.tag in tags for p in path[1:]):
                    return
                return close(tags, scope)

    def put(text: str) -> None:
        if path[-1].tag == "head" and text.strip(" \t\n\r\f"):
            path.pop()
        path[-1].children.append(unescape(text))

    for token in iter(lambda: TOKEN.search(html, at), None):
        if token.start() > at:
            put(html[at:token.start()])
        at = token.end()
        end, tag, rest = token.group(1), token.group(2), token.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for i in range(len(path) - 1, 0, -1):
                if path[i].tag == tag:
                    del path[i:]
                    break
                if path[i].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                    break
            continue
        attributes = {k.lower(): unescape(v[1:-1] if v[:1] in "\"'" else v) for k, v in ATTRIBUTE.findall(rest)} if rest.strip("/ \n\t") else {}
        if path[-1].tag == "head" and tag not in IN_HEAD:
            path.pop()
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in CLOSED_BY_BLOCK:
            close({"p"}, SCOPE)
        if tag in ("td", "th") and path[-1].tag in ("table", "thead", "tbody", "tfoot") and len(path) < DEEPEST:
            path[-1].children.append(Node("tr", {}))
            path.append(path[-1].children[-1])
        node = Node(tag, attributes)
        path[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(html, at)
            raw = html[at:stop.start() if stop else len(html)]
            node.children.append(raw if tag == "style" else unescape(raw) if tag in ("textarea", "title") else "")
            at = stop.end() if stop else len(html)
        elif tag not in VOID and (tag in BLOCKS or not rest.endswith("/")) and len(path) < DEEPEST:
            path.append(node)
    if at < len(html):
        put(html[at:])
    styles = Styles(fold=not re.match(r"\s*<!doctype", html, re.I))
    _sheets(root, styles)
    _see([root], styles)
    return root


class Page:
    """Lines of text; ``gap`` counts the line ends owed before the next text."""

    def __init__(self) -> None:
        self.lines: list[str] = [""]
        self.gap, self.indent, self.blank = 0, "", False
        self.marked = False  # the line holds a list mark only, so a block goes on in it

    def text(self, text: str, keep: bool = False) -> None:
        if keep:
            first, *others = text.expandtabs(8).replace("\r\n", "\n").split("\n")
            self._put(first)
            for line in others:
                self.lines.append(self.indent + line)
            return
        plain = BLANKS.sub(" ", text)
        if plain.strip(" "):
            self.blank |= plain[0] == " "
            self._put((" " if self.blank and not self.gap and self.lines[-1].strip() else "") + plain.strip(" "))
            self.blank = plain[-1] == " "
        elif plain:
            self.blank = True

    def _put(self, text: str) -> None:
        self.marked = False
        if self.gap:
            if any(self.lines):
                self.lines += [""] * self.gap
            self.lines[-1] = self.indent
            self.gap = 0
        self.lines[-1] += text

    def need(self, ends: int) -> None:
        """At least ``ends`` line ends before what follows: 1 for a new line, 2 for a blank one between."""
        if not self.marked:
            self.gap, self.blank = max(self.gap, ends), False

    def result(self) -> str:
        return "\n".join(line.rstrip() for line in self.lines).strip("\n")


def _span(cell: Node, name: str) -> int:
    span = cell.attributes.get(name, "1").strip()
    return int(span) if span.isdecimal() and span.isascii() and len(span) < 4 else 1


def _cells(table: Node) -> list[list[tuple[int, int, list[str]]]]:
    """Rows of the visible cells of a table: first column, columns spanned, lines."""
    rows: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}  # rows that a cell above still covers, by column
    for child in table.children:
        if isinstance(child, str) or not child.shown:
            continue
        if child.tag in ("thead", "tbody", "tfoot"):
            rows += _cells(child)
            taken = {}
        elif child.tag == "tr":
            row, at, below = [], 0, {c: n - 1 for c, n in taken.items() if n > 1}
            for cell in child.children:
                if isinstance(cell, Node) and cell.shown and cell.tag in ("td", "th"):
                    while at in taken:
                        at += 1
                    span, deep = max(1, _span(cell, "colspan")), _span(cell, "rowspan")
                    row.append((at, span, [line for line in render(cell).split("\n") if line]))
                    if deep != 1:  # 0 stands for all rows of the part
                        below |= dict.fromkeys(range(at, at + span), deep - 1 if deep else len(table.children))
                    at += span
            rows.append(row)
            taken = below
    return rows


def _table(node: Node, page: Page) -> None:
    for child in node.children:
        if isinstance(child, Node) and child.tag == "caption" and child.shown:
            page.need(1)
            _walk(child, page, [], False)
    rows, widths = _cells(node), defaultdict(int)
    wide = defaultdict(int)  # widest text of the cells over these columns
    for row in rows:
        for at, span, lines in row:
            wide[at + span - 1, span] = max(wide[at + span - 1, span], *map(len, lines), 0)
    for (last, span), width in sorted(wide.items()):
        before = sum(widths[c] for c in range(last - span + 1, last)) + 2 * (span - 1)
        widths[last] = max(widths[last], width - before)
    starts = [0]
    for c in range(max(widths, default=-1) + 1):
        starts.append(starts[-1] + widths[c] + 2)
    for row in rows:
        for k in range(max((len(lines) for *_, lines in row), default=0)):
            line = ""
            for at, _, lines in row:
                if k < len(lines):
                    line = line.ljust(starts[at]) + lines[k]
            page.need(1)
            page.text(line, keep=True)
    # Text and blocks that stand in a table outside of its cells.
    for child in node.children:
        if isinstance(child, str):
            page.text(child)
        elif child.shown and child.tag not in ("thead", "tbody", "tfoot", "tr", "caption", "colgroup", "col"):
            page.need(1)
            _walk_one(child, page, [], False)
    page.need(1)


def _walk(node: Node, page: Page, lists: list[list], keep: bool) -> None:
    for child in node.children:
        if isinstance(child, str):
            page.text(child, keep)
        elif child.shown:
            _walk_one(child, page, lists, keep)


def _whole(node: Node, name: str, otherwise: int) -> int:
    value = node.attributes.get(name, "").strip()
    return int(value) if re.fullmatch(r"[-+]?[0-9]{1,9}", value) else otherwise


def _walk_one(node: Node, page: Page, lists: list[list], keep: bool) -> None:
    tag = node.tag
    if not node.drawn and tag in ("img", "area", "input"):
        return
    if tag == "br":
        page.need(page.gap + 1 if page.gap else 1)
        return
    if tag in ("img", "area") and node.attributes.get("alt", "").strip():
        page.text(node.attributes["alt"])
        return
    if tag == "input" and node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
        page.text(node.attributes.get("value", ""))
        return
    ends = 2 if tag in APART and not (tag in ("ul", "ol") and lists) else 1 if tag in BLOCKS else 0
    if ends:
        page.need(ends)
    if tag == "table":
        _table(node, page)
    elif tag in ("ul", "ol", "menu", "dir"):
        back = "reversed" in node.attributes
        number = _whole(node, "start", sum(isinstance(c, Node) and c.tag == "li" for c in node.children) if back else 1)
        _walk(node, page, [*lists, [number if tag == "ol" else None, -1 if back else 1]], keep)
    elif tag == "li":
        mark = "- "
        if lists and lists[-1][0] is not None:
            number, step = _whole(node, "value", lists[-1][0]), lists[-1][1]
            mark, lists[-1][0] = f"{number}. ", number + step
        mark = mark if node.drawn else ""
        outer = page.indent
        page.indent = "  " * max(0, len(lists) - 1)
        page.text(mark, keep=True)
        page.indent = "  " * max(1, len(lists))
        page.blank, page.marked = False, True
        _walk(node, page, lists, keep)
        page.marked, page.indent = False, outer
    elif tag in ("dd", "blockquote"):
        outer, page.indent = page.indent, page.indent + "  "
        _walk(node, page, lists, keep)
        page.need(1)
        page.indent = outer
    elif tag in ("td", "th"):
        page.blank = True
        _walk(node, page, lists, keep)
        page.blank = True
    else:
        _walk(node, page, lists, keep or tag in ("pre", "textarea", "xmp"))
    if ends:
        page.need(ends)


def render(node: Node) -> str:
    page = Page()
    _walk(node, page, [], False)
    return page.result()


def visible_text(html: str) -> str:
    return render(build(html))


def page_title(root: Node) -> str | None:
    """The text of the first title element."""
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag == "title":
            return " ".join("".join(c for c in node.children if isinstance(c, str)).split())
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return None


def extract(pages: DataFrame, html_col: str = "html", out: str = "text", title: str = "title") -> DataFrame:
    """``pages`` with the visible text and the title of each."""
    @F.pandas_udf("struct<title:string,text:string>")
    def read(rows: pd.Series) -> pd.DataFrame:
        found = []
        for html in rows:
            root = None if html is None else build(html)
            found.append((None, None) if root is None else (page_title(root), render(root)))
        return pd.DataFrame(found, columns=["title", "text"])

    met = pages.select(F.struct("*").alias("_row"), read(html_col).alias("_read"))
    return met.select(*[F.col("_row")[c].alias(c) for c in pages.columns if c not in (title, out)],
                      F.col("_read.title").alias(title), F.col("_read.text").alias(out))


@query()
def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = extract(table(spark, folder, "pages"))
    lines = F.size(F.filter(F.split("text", "\n"), lambda line: line != ""))
    return pages.select("page_id", "url", "title", "text", F.length("text").cast("long").alias("n_chars"), lines.cast("long").alias("n_lines"))
