"""Text of web pages as laid out (operator 10).

A page is split into tags and text, a tree is built (with implied end tags and void elements), and
the tree is rendered: elements that are not laid out give nothing (what only screen readers skip stays), blocks are parted by blank lines or line
breaks, lists are marked and indented, preformatted text stays as it is, and the cells of a table
are padded to columns.

Edge cases: a null or empty page gives an empty text.  Unclosed comments, tags and raw elements go
on to the end of the page; end tags without a start are ignored; elements that are still open are
closed at the end.  Rows and cells that are not directly in a table, as in a fragment or after a surplus
end tag, are lines and words where they stand.  Very long and very deep pages are handled without recursion.  Repeated rows and
null ids give a row each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from projectpulse.llm.common import by_pandas, ship_code, table

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style template title iframe noembed noframes noscript object canvas audio video "
                   "datalist meta link base param source track area".split())
#: Elements without a layout inside these only.
FOREIGN = {"svg": frozenset("desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient filter".split()),
           "math": frozenset("annotation annotation-xml".split())}
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr".split())
BLOCK = SPACED | frozenset("html body address article aside center details dialog dd div dt figcaption footer form header "
                           "hgroup li legend main menu nav option optgroup search section select summary caption".split())
# An element that starts ends open elements of these kinds, up to a barrier.
_TABLE = frozenset(["table"])
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])), "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "td": (frozenset("td th".split()), _TABLE), "th": (frozenset("td th".split()), _TABLE),
    "tr": (frozenset("tr td th caption".split()), _TABLE),
    **{g: (frozenset("thead tbody tfoot tr td th caption colgroup".split()), _TABLE) for g in ("thead", "tbody", "tfoot")},
    "option": (frozenset(["option"]), frozenset(["select"])), "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
IN_HEAD = frozenset("head title meta link base style script noscript template".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section table ul dt dd".split())
SCOPE = frozenset("table td th caption button html body".split())

_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_ATTR = re.compile(r"""[\s/]*(?:(>)|([^\s/>=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*|)))?)""")
_DECLARATION = re.compile(r"""(?:"[^"]*"|'[^']*'|\([^)]*\)|[^;])+""")
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
_BLANKS = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def tokens(page: str):
    """("text", s), ("start", tag, attrs, closed in itself) and ("end", tag) in order.  Only elements within svg and
    math, and these, can be closed in themselves."""
    at, n, foreign = 0, len(page), 0
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            yield "text", html.unescape(page[at:])
            return
        if m.start() > at:
            yield "text", html.unescape(page[at:m.start()])
        if m[2] is None:  # a comment, a declaration or a bogus tag
            close = "-->" if m[0] == "<!--" else ">"
            k = page.find(close, m.end())
            at = n if k < 0 else k + len(close)
            continue
        tag, attrs, at = m[2].lower(), {}, m.end()
        while True:
            a = _ATTR.match(page, at)
            if a is None or a.end() == at:
                if at >= n:
                    return  # the page ends within a tag
                at += 1
                continue
            at = a.end()
            if a[1]:
                closed = a[0].endswith("/>")
                break
            attrs.setdefault(a[2].lower(), html.unescape(next((v for v in a.groups()[2:] if v is not None), "")))
        if m[1]:
            foreign -= foreign > 0 and tag in FOREIGN
            yield "end", tag
            continue
        closed = closed and (foreign > 0 or tag in FOREIGN)
        foreign += tag in FOREIGN and not closed
        yield "start", tag, attrs, closed
        if tag in RAW and not closed:
            k = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            body = page[at:k.start() if k else n]
            if body:
                yield "text", html.unescape(body) if tag in ("textarea", "title") else body
            at = k.start() if k else n


def tree(page: str) -> Node:
    root = Node("#root")
    stack = [root]
    count: dict[str, int] = {}  # open elements by tag, so that end tags without a start cost nothing

    def pop():
        count[stack.pop().tag] -= 1

    for token in tokens(page):
        kind, what = token[0], token[1]
        if kind == "text":
            if what.strip() and stack[-1].tag == "head":
                pop()
            stack[-1].children.append(what)
        elif kind == "start":
            if count.get("head") and what not in IN_HEAD:
                while count.get("head"):
                    pop()
            if what in CLOSES_P and count.get("p"):
                k = len(stack) - 1
                while k > 0 and stack[k].tag != "p" and stack[k].tag not in SCOPE:
                    k -= 1
                if stack[k].tag == "p":
                    while len(stack) > k:
                        pop()
            ended, barrier = ENDS.get(what, ((), ()))
            if any(count.get(t) for t in ended):
                k, low = len(stack) - 1, None
                while k > 0 and stack[k].tag not in barrier:
                    if stack[k].tag in ended:
                        low = k
                        if what in ("li", "option"):
                            break
                    k -= 1
                while low is not None and len(stack) > low:
                    pop()
            node = Node(what, token[2])
            stack[-1].children.append(node)
            if what not in VOID and not token[3]:
                stack.append(node)
                count[what] = count.get(what, 0) + 1
        elif what == "br":
            stack[-1].children.append(Node("br"))
        elif what == "p" and not count.get("p"):
            stack[-1].children.append(Node("p"))
        elif count.get(what):
            k = len(stack) - 1
            while stack[k].tag != what:
                if count.get("table") and stack[k].tag in ("td", "th", "table") and what not in ("table", "tr", "td", "th", "thead", "tbody", "tfoot", "body", "html"):
                    k = 0  # an end tag inside a cell does not close what is outside
                    break
                k -= 1
            while k and len(stack) > k:
                pop()
    return root


def styles(style: str) -> dict[str, str]:
    """The declared values of a style attribute by property name: the last one, or the last important one."""
    out, important = {}, set()
    for declaration in _DECLARATION.findall(_COMMENT.sub(" ", style.lower())):
        name, _, value = (x.strip() for x in declaration.partition(":"))
        value, mark, _ = value.partition("!")
        if mark or name not in important:
            out[name] = value.strip()
        if mark:
            important.add(name)
    return out


def hidden(node: Node, within: dict[str, int], style: dict[str, str]) -> bool:
    """Whether an element has no layout.  ``within`` counts the open svg and math elements."""
    if node.tag in HIDDEN or any(within[t] and node.tag in FOREIGN[t] for t in FOREIGN):
        return True
    if style.get("display"):
        return style["display"] == "none"
    return "hidden" in node.attrs or node.tag == "dialog" and "open" not in node.attrs


class Frame:
    """Lines under construction: ``gap`` is the number of line breaks owed before the next text."""

    def __init__(self, owner: Node | None = None):
        self.owner = owner
        self.parts: list[str] = []
        self.gap, self.space = 0, False
        self.rows: list[list[str]] = []
        self.header = 0

    def owe(self, lines: int) -> None:
        self.gap, self.space = max(self.gap, lines), False

    def text(self, s: str) -> None:
        words = _BLANKS.sub(" ", s)
        if words == " ":
            self.space = bool(self.parts) and not self.gap
            return
        if self.gap:
            self.parts.append("\n" * self.gap if self.parts else "")
            self.gap = 0
            words = words.lstrip(" ")
        elif self.space and not words.startswith(" "):
            words = " " + words
        if not self.parts or self.parts[-1].endswith((" ", "\n")):
            words = words.lstrip(" ")
        self.space = words.endswith(" ")
        self.parts.append(words.rstrip(" "))

    def block(self, lines: str, gap: int) -> None:
        """A finished block of lines with ``gap`` line breaks before and after it."""
        if lines:
            self.owe(gap)
            self.parts.append(("\n" * self.gap if self.parts else "") + lines)
            self.gap, self.space = gap, False

    def result(self) -> str:
        return "\n".join(line.rstrip() for line in "".join(self.parts).split("\n")).strip("\n")


def width(s: str) -> int:
    return sum((2 if unicodedata.east_asian_width(c) in "WF" else 1) for c in s if not unicodedata.combining(c)) if not s.isascii() else len(s)


def aligned(rows: list[list[str]]) -> str:
    """Rows of cells as lines, each column padded to its widest cell; cells may have several lines."""
    split = [[c.split("\n") for c in row] for row in rows]
    columns = max(map(len, split), default=0)
    wide = [max((width(line) for row in split if k < len(row) for line in row[k]), default=0) for k in range(columns)]
    out = []
    for row in split:
        for i in range(max(map(len, row), default=0)):
            cells = [(row[k][i] if i < len(row[k]) else "") if k < len(row) else "" for k in range(columns)]
            out.append("  ".join(c + " " * (wide[k] - width(c)) for k, c in enumerate(cells)).rstrip())
    return "\n".join(out)


def indented(lines: str, first: str) -> str:
    return first + lines.replace("\n", "\n" + " " * len(first))


def render(root: Node) -> str:
    """The visible text of a tree."""
    frames = [Frame()]
    lists: list[list] = []  # open lists: [ordered, next number]
    pre = 0
    within = dict.fromkeys(FOREIGN, 0)
    unseen = [False]  # visibility, which elements inside can set anew
    todo: list = [("open", root)]
    while todo:
        step, node = todo.pop()
        if step == "open":
            if isinstance(node, str):
                if unseen[-1]:
                    continue
                if pre:
                    f = frames[-1]
                    f.parts.append(("\n" * f.gap if f.parts else "") + node)
                    f.gap, f.space = 0, False
                else:
                    frames[-1].text(node)
                continue
            tag = node.tag
            style = styles(node.attrs["style"]) if "style" in node.attrs else {}
            if hidden(node, within, style):
                continue
            away = {"visible": False, "initial": False, "hidden": True, "collapse": True}.get(style.get("visibility"), unseen[-1])
            if tag == "br":
                f = frames[-1]
                f.gap, f.space = f.gap + 1 if f.parts else 0, False
                continue
            if tag == "hr":
                frames[-1].block("" if away else "---", 2)
                continue
            unseen.append(away)
            if tag in FOREIGN:
                within[tag] += 1
            in_table = frames[-1].owner is not None and frames[-1].owner.tag == "table"
            if tag in ("li", "blockquote", "table", "dd", "pre", "caption") or tag in ("td", "th") and in_table:
                frames.append(Frame(node))
            elif tag in ("td", "th") or tag == "text" and within["svg"]:
                frames[-1].text(" ")
            elif tag == "tr" and in_table:
                frames[-1].rows.append([])
            elif tag == "tr":
                frames[-1].owe(1)
            elif tag in BLOCK:
                frames[-1].owe(2 if tag in SPACED and not (lists and tag in ("ul", "ol", "dl")) else 1)
            if tag in ("ul", "ol", "menu"):
                start = node.attrs.get("start", "1")
                lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            pre += tag in ("pre", "textarea")
            todo.append(("close", node))
            todo.extend(("open", c) for c in reversed(node.children))
            continue
        tag = node.tag
        unseen.pop()
        if tag in FOREIGN:
            within[tag] -= 1
        pre -= tag in ("pre", "textarea")
        if tag in ("ul", "ol", "menu"):
            lists.pop()
        if tag in ("td", "th") and frames[-1].owner is not node or tag == "text" and within["svg"]:
            frames[-1].text(" ")
        elif tag == "tr" and not (frames[-1].owner is not None and frames[-1].owner.tag == "table"):
            frames[-1].owe(1)
        elif tag in ("td", "th"):
            cell = frames.pop().result()
            rows = frames[-1].rows
            if not rows:
                rows.append([])
            span = node.attrs.get("colspan", "1")
            rows[-1].extend([cell, *[""] * (min(int(span), 1000) - 1 if re.fullmatch(r"\d{1,4}", span) else 0)])
        elif tag == "caption":
            lines = frames.pop().result()
            frames[-1].block(lines, 1)
        elif tag == "table":
            f = frames.pop()
            loose = f.result()
            frames[-1].block("\n".join(x for x in (loose, aligned([r for r in f.rows if any(r)])) if x), 2)
        elif tag == "li":
            lines = frames.pop().result()
            mark = "- "
            if lists and lists[-1][0]:
                value = node.attrs.get("value", "")
                if re.fullmatch(r"-?\d{1,9}", value):
                    lists[-1][1] = int(value)
                mark = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            frames[-1].block(indented(lines, mark) if lines else "", 1)
        elif tag == "dd":
            frames[-2].block(indented(frames[-1].result(), "    ") if frames[-1].parts else "", 1)
            frames.pop()
        elif tag == "blockquote":
            lines = frames.pop().result()
            frames[-1].block("> " + lines.replace("\n", "\n> ") if lines else "", 2)
        elif tag == "pre":
            lines = "".join(frames.pop().parts)
            frames[-1].block(lines.removeprefix("\n").rstrip("\n"), 2)
        elif tag in BLOCK:
            frames[-1].owe(2 if tag in SPACED and not (lists and tag in ("ul", "ol", "dl")) else 1)
    while len(frames) > 1:  # every element is closed above
        frames.pop()
    return frames[0].result()


def page_text(page: str | None) -> str:
    return render(tree(page)) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text and its numbers of characters and lines, for every whole page."""
    ship_code(pages.sparkSession)

    def run(batches):
        for pdf in batches:
            texts = [page_text(h) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "text": texts, "n_chars": [len(t) for t in texts],
                                "n_lines": [t.count("\n") + 1 if t else 0 for t in texts]})
    rows = pages.select(pages[id_col].alias("page_id"), pages[html_col].alias("html"))
    return by_pandas(rows, run, "text string, n_chars long, n_lines long", "page_id")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
