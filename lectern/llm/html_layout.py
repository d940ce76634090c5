"""HTML to text as a reader sees it: a tree with implied tags, visibility rules, and a layout that keeps blocks, lists and tables.

Parsing: comments, doctypes and processing instructions are dropped; script, style and the like are raw text; a start tag
closes what it implies closed (CLOSES, inside the nearest SCOPE); an end tag closes up to its element, or is ignored.
Visibility: what HIDDEN elements, `hidden`, or an inline style of display:none hold is not shown; visibility:hidden hides text until a
descendant is visible again. Layout: runs of blanks are one blank, save in `pre`; paragraphs and headings stand between blank lines,
other blocks on lines of their own; list items carry a dash or number and an indent for each level; table columns are padded to
equal width.

Pages are rows; a page is parsed and rendered with explicit stacks, whole, in time linear in its length, save the table columns of
one table. Defined results: null or empty html gives an empty text; anything else is text, however broken; repeated rows are alike.
"""
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from lectern.llm.frames import pick

#: Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes object svg math audio video canvas datalist".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset".split())
BLOCKS = PARAGRAPHS | frozenset("address article aside body caption center dd details dialog dir div dt figcaption footer form header hgroup html legend li "
                                "main menu nav optgroup option search section summary tbody td tfoot th thead tr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
          "tr": {"tr", "td", "th", "caption", "colgroup"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, "thead": {"tbody", "caption", "colgroup"},
          "tfoot": {"tbody", "thead", "tr", "td", "th", "caption", "colgroup"}, "body": {"head"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "optgroup": {"select"}}
ENDS_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"}
TABLE_PARTS = frozenset("caption colgroup col tbody thead tfoot tr td th".split())  # ignored outside tables
HEAD_ONLY = frozenset("base link meta noscript script style template title head".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def parse(html: str) -> Node:
    root = Node("html", {})
    stack, at, open_count = [root], 0, {}

    def pop_to(i: int):
        for node in stack[i:]:
            open_count[node.tag] -= 1
        del stack[i:]

    def close(wanted, scope):
        """Closes the outermost wanted element above the nearest scope element, with all inside it."""
        if not any(open_count.get(t) for t in wanted):
            return
        found = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in scope:
                break
            if stack[i].tag in wanted:
                found = i
        if found:
            pop_to(found)

    def say(text):
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                pop_to(len(stack) - 1)
            stack[-1].children.append(unescape(text))

    while at < len(html):
        m = TOKEN.search(html, at)
        if not m:
            say(html[at:])
            break
        say(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not open_count.get("p"):
                stack[-1].children.append(Node("p", {}))
            elif tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif open_count.get(tag):
                walls = {"table", "td", "th"} if tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "body", "html") else ({"table"} - {tag})
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        pop_to(i)
                        break
                    if stack[i].tag in walls:
                        break
            continue
        attributes = {}
        if m[3] and not m[3].isspace():
            for name, value in ATTRIBUTE.findall(m[3]):
                attributes.setdefault(name.lower(), unescape(value.strip("\"'")))
        if tag in ("html", "body") and (tag == "html" or open_count.get("body")):
            if tag == "html":
                root.attributes = attributes | root.attributes
            continue
        if tag in TABLE_PARTS and not open_count.get("table"):
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            pop_to(len(stack) - 1)
        if tag in ENDS_P and open_count.get("p"):
            close({"p"}, {"table", "td", "th", "button", "caption"})
        if tag in CLOSES:
            close(CLOSES[tag], SCOPE.get(tag, {"table"}) if tag != "body" else ())
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            body = html[at:end.start() if end else len(html)]
            node.children.append(unescape(body) if tag in ("textarea", "title") else body)
            at = end.end() if end else len(html)
        elif tag not in VOID:
            stack.append(node)
            open_count[tag] = open_count.get(tag, 0) + 1
    return root


class Page:
    """Lines in the making. `gap` is how many line breaks stand before the next text."""

    def __init__(self):
        self.parts, self.gap, self.blank, self.indent, self.mark = [], 0, False, 0, ""

    def lines(self, n: int):
        self.gap, self.blank = max(self.gap, n), False

    def write(self, text: str, keep: bool):
        if not keep:
            shown = BLANKS.sub(" ", text)
            if shown.startswith(" "):
                self.blank, shown = True, shown[1:]
            ends = shown.endswith(" ")
            shown = shown[:-1] if ends else shown
            if not shown:
                self.blank = self.blank or ends
                return
            self._put(shown)
            self.blank = ends
            return
        for i, line in enumerate(text.split("\n")):
            if i:
                self.gap, self.blank = self.gap + 1, False
            if line:
                self._put(line)

    def _put(self, text: str):
        if self.parts and self.gap:
            self.parts.append("\n" * self.gap)
        if not self.parts or self.gap:
            self.parts.append("  " * max(0, self.indent - bool(self.mark)) + self.mark)
            self.mark = ""
        elif self.mark:
            self.parts.append(self.mark)
            self.mark = ""
        elif self.blank:
            self.parts.append(" ")
        self.gap, self.blank = 0, False
        self.parts.append(text)

    def text(self) -> str:
        return "".join(self.parts)


def _shown(node: Node, visible: bool) -> tuple[bool, bool]:
    """(rendered at all, its text visible)"""
    style = node.attributes.get("style", "").lower().replace(" ", "")
    if node.tag in HIDDEN or "hidden" in node.attributes or "display:none" in style:
        return False, False
    if "visibility:hidden" in style or "visibility:collapse" in style:
        visible = False
    elif "visibility:visible" in style:
        visible = True
    return True, visible


def render(root: Node) -> str:
    """Frames on the stack are (children left, visible, keep blanks, what to do at the end); a table or cell has a page of its own."""
    page = Page()
    stack = [(iter(root.children), True, False, None)]
    pages, tables, lists = [page], [], []
    while stack:
        children, visible, keep, done = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if done:
                done()
            continue
        if isinstance(child, str):
            if visible:
                pages[-1].write(child, keep)
            continue
        shown, seen = _shown(child, visible)
        if not shown or (child.tag == "input"):
            continue
        tag, page = child.tag, pages[-1]
        if tag == "br":
            page.gap, page.blank = page.gap + 1, False
            continue
        if tag == "table":
            tables.append([])
            page.lines(2)
            stack.append((iter(child.children), seen, False, _end_table(pages, tables)))
            continue
        if tables and tag == "tr":
            tables[-1].append([])
            stack.append((iter(child.children), seen, False, None))
            continue
        if tables and tag in ("td", "th"):
            if not tables[-1]:
                tables[-1].append([])
            pages.append(Page())
            span = child.attributes.get("colspan", "1")
            stack.append((iter(child.children), seen, False, _end_cell(pages, tables, min(int(span), 1000) if re.fullmatch("[0-9]{1,4}", span) else 1)))
            continue
        gap = 2 if tag in PARAGRAPHS else 1 if tag in BLOCKS else 0
        if tag in ("ul", "ol", "menu", "dl"):
            start = child.attributes.get("start", "1")
            lists.append([tag, int(start) if re.fullmatch("-?[0-9]{1,9}", start) else 1])
            page.lines(1 if len(lists) > 1 else 2)
            page.indent += 1 if tag != "dl" else 0
            stack.append((iter(child.children), seen, keep, _end_list(page, lists, tag)))
            continue
        if tag == "li":
            kind = lists[-1] if lists else ["ul", 1]
            page.lines(1)
            page.mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
            kind[1] += 1
            stack.append((iter(child.children), seen, keep, _end_item(page)))
            continue
        if gap:
            page.lines(gap)
        stack.append((iter(child.children), seen, keep or tag == "pre", (lambda p=page, g=gap: p.lines(g)) if gap else None))
    return pages[0].text()


def _end_list(page: Page, lists: list, tag: str):
    def end():
        page.indent -= 1 if tag != "dl" else 0
        lists.pop()
        page.lines(1 if lists else 2)
    return end


def _end_item(page: Page):
    def end():
        page.mark = ""
        page.lines(1)
    return end


def _end_cell(pages: list, tables: list, span: int):
    def end():
        tables[-1][-1].append((BLANKS.sub(" ", pages.pop().text()), span))
    return end


def _end_table(pages: list, tables: list):
    def end():
        rows = [r for r in tables.pop() if r]
        widths: dict[int, int] = {}
        for row in rows:
            column = 0
            for text, span in row:
                if span == 1:
                    widths[column] = max(widths.get(column, 0), len(text))
                column += span
        for row in rows:
            cells, column = [], 0
            for text, span in row:
                cells.append(text.ljust(sum(widths.get(c, 0) for c in range(column, column + span)) + 3 * (span - 1)))
                column += span
            line = " | ".join(cells).rstrip()
            if line:
                pages[-1].lines(1)
                pages[-1]._put(line)
        pages[-1].lines(2)
    return end


def html_text(html: str | None) -> str:
    return render(parse(html)) if html else ""


def extracted(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) to (page_id, text)."""
    rows = pick(pages, "page_id", "html")
    kind = rows.schema["page_id"].dataType.simpleString()

    def task(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([html_text(h) for h in part.column(1).to_pylist()], pa.string())], names=["page_id", "text"])

    return rows.mapInArrow(task, f"page_id {kind}, text string")
