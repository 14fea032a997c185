"""Main text of web pages by tree scoring.

A page becomes a tree; parts that are never article text (scripts, menus,
adverts, reader comments and the like, told by tag, role, class or id) are left
out, as are the controls of a form. A form itself goes unless it holds most of
the page's unlinked text (pages that are one form around everything). Names
that don't tell for sure ("discussion", "related") lower the points of what is
inside, and their elements go only if they hold little but links; so does an id
inside an article that repeats the words of the heading it begins with, as
generated anchors do, if nothing in it looks like reader comments. Every paragraph gives points for its length and commas: all of
them to its parent, half to its grandparent, and less further up. A
container's points are discounted by the share of its text inside links. The
best container is kept, or the ``article`` or ``main`` element around it, with
those of its siblings that score well, and the text beside it that is not mostly
links: paragraphs, lists, quotes, code, tables, figures, bare text, and headings
before anything kept.

Scale: pages are independent; one narrow pass over whole pages, in time linear
in their length.

Defined results: a null or empty page, or one without text outside the parts
left out, gives an empty text with 0 characters. Markup that ends early is
closed at the page's end. Repeated rows each get their own result.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of HTML: which elements hold no content, hold raw text, begin a new block, or are left out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td"
    " tfoot th thead tr ul br".split()
)
CLOSES_P = BLOCK - frozenset("br body html option optgroup td th tr tbody thead tfoot dd dt li legend".split())
LEFT_OUT = frozenset(
    "script style textarea title noscript iframe xmp noframes head nav footer aside button select option input label"
    " fieldset svg math canvas template dialog menu object embed video audio applet map datalist".split()
)
ROLES_OUT = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
# Words of class and id names. The first tell of boilerplate by themselves, the others only beside what the element holds;
# words of layout say nothing.
NAMES_OUT = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox adslot sponsored cookie cookies gdpr popup modal overlay"
    " newsletter sidebar sidebars nav navbar breadcrumb breadcrumbs masthead topbar toolbar footer menu menus"
    " comment comments disqus respond pager pagination login paywall widget widgets".split()
)
NAMES_DOUBTFUL = frozenset(
    "banner sponsor sponsors promo promotion promoted consent notice notices notification notifications subscribe subscription signup"
    " rail navigation header replies reply discussion related recommended recommendations share sharing social alert skip hidden".split()
)
NAMES_LAYOUT = frozenset(
    "a an the site page post posts blog article entry main content contents body top bottom left right upper lower primary secondary"
    " global inner outer wrap wrapper container box block area section panel list lists item items row col column group bar strip"
    " unit slot holder region zone link links button buttons icon icons form title text thread user users js fb google us".split()
)
NEVER_OUT = frozenset("html body article main".split())
# Names never leave these out with their text; the id of a heading is an anchor.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What stays beside the best container unless it is mostly links.
BESIDE = frozenset("p pre blockquote ul ol dl table figure figcaption hgroup address details".split())
READERS = frozenset("comment comments disqus respond".split())
# Elements that flow inside a line of text.
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
# Elements that reader comments hold and a section of an article doesn't.
DISCUSSION = frozenset("article time form textarea button input select label".split())
PARAGRAPH = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption div section".split())
# Parts of a larger block, which is kept with all of them.
PARTS = frozenset("tr td th tbody thead tfoot li dt dd p a b i em strong span u small".split())
# An element on the left ends an open one on the right, inside the nearest of the elements that bound it.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}
P_BOUNDS = frozenset("button table td th caption html object template".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r""">|=\s*(["'])""")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/][^\s=>/]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_PARTS = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_FORM_ROLE = re.compile(r"""(?:^|\s)role\s*=\s*["']?form(?=["'\s]|$)""", re.I)
DOUBT = 0.25  # what the points of a paragraph count inside an element with a doubtful name
LEAST_TEXT = 50  # unlinked characters with which such an element stays
ANCESTORS = 5  # that a paragraph's points reach
SHORT = 25


class Node:
    __slots__ = ("tag", "parent", "children", "out", "points", "size", "linked", "doubtful", "weight", "form", "anchor", "talk")

    def __init__(self, tag: str, parent: Node | None, out: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.children: list[Node | str] = []
        self.points, self.weight, self.doubtful = 0.0, 1.0, False
        self.size = self.linked = 0
        self.form = tag == "form"
        self.anchor = ""  # the id, where only the heading can tell what it names
        self.talk = False  # something in it looks like reader comments


def _is_out(tag: str, attributes: str, parent: Node) -> bool:
    if tag in LEFT_OUT:
        return True
    if tag == "header":  # a page's header; an article's own one holds its title
        return not _inside(parent, "article")
    if tag in NEVER_OUT or not attributes:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in ROLES_OUT:
            return True
    return _named(tag, attributes, parent) == 2 and not _anchor(tag, attributes, parent)


def _anchor(tag: str, attributes: str, parent: Node) -> str:
    """The id of a section inside an article, if its classes don't name it boilerplate."""
    if tag not in ("section", "div") or not (_inside(parent, "article") or _inside(parent, "main")):
        return ""
    values = {name.lower(): value.strip("\"'") for name, value in _ATTRIBUTE.findall(attributes)}
    classes = f'class="{values["class"]}"' if "class" in values else ""
    return values.get("id", "") if _named(tag, classes, parent) < 2 else ""


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _named(tag: str, attributes: str, parent: Node) -> int:
    """2: class or id names an element that is never article text; 1: perhaps not; 0: they don't tell.

    All parts of a name count. A name tells for sure if its last part does, or
    one part does beside words of layout and doubtful ones only; in
    "related-work" or "comments-on-grammar" another word says what it's about.
    """
    if tag in NEVER_OUT or not attributes or _in_text(tag, parent):
        return 0
    most = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() not in ("class", "id"):
            continue
        for token in value.strip("\"'").split():
            parts = [x.lower() for x in _PARTS.split(token) if x]
            # "has-sidebar" or "no-ads" tells of a layout, not of the element
            if not parts or parts[0] in ("has", "no", "with", "without"):
                continue
            sure = not NAMES_OUT.isdisjoint(parts)
            other = any(x not in NAMES_OUT and x not in NAMES_DOUBTFUL and x not in NAMES_LAYOUT for x in parts)
            if sure and (parts[-1] in NAMES_OUT or not other):
                return 2
            if sure or parts[-1] in NAMES_DOUBTFUL or not other and not NAMES_DOUBTFUL.isdisjoint(parts):
                most = 1
    return most


def _in_text(tag: str, parent: Node | None) -> bool:
    """Whether the element is a paragraph or heading, or inline inside one."""
    if tag in TEXT:
        return True
    while tag not in BLOCK and parent is not None:
        if parent.tag in TEXT:
            return True
        tag, parent = parent.tag, parent.parent
    return False


def _inside(node: Node | None, tag: str) -> bool:
    while node is not None:
        if node.tag == tag:
            return True
        node = node.parent
    return False


def _close(at: Node, tags: tuple[str, ...] | frozenset, bounds) -> Node:
    """The parent of the outermost open element of ``tags`` below any of ``bounds``; ``at`` if none is open."""
    found, node = None, at
    while node is not None and node.tag not in bounds:
        if node.tag in tags:
            found = node
        node = node.parent
    return found.parent if found is not None and found.parent is not None else at


def _tag_end(html: str, at: int, endless: set[int]) -> int:
    """The place of the ``>`` outside quoted values, of any length; the next one at all where a quote is never closed.

    ``endless`` keeps the stops from which no end was found, so that a page is scanned once.
    """
    place, passed = at, []
    while (stop := _STOP.search(html, place)) is not None and stop.start() not in endless:
        if stop[1] is None:
            return stop.start()
        passed.append(stop.start())
        close = html.find(stop[1], stop.end())
        if close < 0:
            break
        place = close + 1
    endless.update(passed)
    return html.find(">", at)


def parse(html: str) -> Node:
    """The page's tree; the parts left out have no children."""
    root = Node("html", None, False)
    endless: set[int] = set()
    at, place, size = root, 0, len(html)
    while place < size:
        begin = html.find("<", place)
        if begin < 0:
            begin = size
        if begin > place and not at.out:
            at.children.append(unescape(html[place:begin]))
        if begin == size:
            break
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 4)
            place = end + 3 if end >= 0 else size
            continue
        following = html[begin + 1 : begin + 2]
        if following in ("!", "?"):
            end = html.find(">", begin)
            place = end + 1 if end >= 0 else size
            continue
        tag_match = _TAG.match(html, begin)
        end = _tag_end(html, tag_match.end(), endless) if tag_match else -1
        if end < 0:
            if following == "/" or following.isalpha():  # a tag without an end
                end = html.find(">", begin)
                place = end + 1 if end >= 0 else size
            else:
                if not at.out:
                    at.children.append("<")
                place = begin + 1
            continue
        place = end + 1
        closing, tag, attributes = tag_match[1], tag_match[2].lower(), html[tag_match.end() : end]
        if closing:
            node = at
            while node is not None and node.tag != tag and not (tag not in BLOCK and node.tag in BLOCK):
                node = node.parent
            if node is not None and node.tag == tag and node.parent is not None:
                at = node.parent
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P:
            at = _close(at, ("p",), P_BOUNDS)
        if tag in IMPLIED_END:
            at = _close(at, *IMPLIED_END[tag])
        if at.tag == "head" and tag in BLOCK:
            at = at.parent
        node = Node(tag, at, at.out or _is_out(tag, attributes, at))
        named = 0 if node.out else _named(tag, attributes, at)
        node.doubtful = named > 0
        node.anchor = _anchor(tag, attributes, at) if named == 2 else ""
        node.form = node.form or _FORM_ROLE.search(attributes) is not None
        if tag in DISCUSSION or named == 2 and not node.anchor or node.out and _named(tag, attributes, at) == 2:
            at.talk = True
        if not at.out:
            at.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, place)
            stop = end.start() if end else size
            close = html.find(">", stop)
            place = close + 1 if end and close >= 0 else size
        elif tag not in VOID and not (attributes.endswith("/") and tag in ("svg", "math")):
            at = node
    return root


def _order(root: Node) -> list[Node]:
    """All kept nodes, parents before children, without recursion."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.out)
    return out


def _measure(nodes: list[Node]) -> None:
    """Sizes of all nodes; doubtful ones that turn out to hold little, and anchors that don't name a section, go."""
    for node in reversed(nodes):
        node.size = node.linked = 0
        for child in reversed(node.children):
            if isinstance(child, str):
                node.size += len(child.strip())
                continue
            if child.anchor and not child.out and not READERS.isdisjoint(_words(child.anchor)):
                child.out = node.size - node.linked < LEAST_TEXT  # readers' comments end an article
            if child.out:
                node.talk = node.talk or child.anchor != ""
            else:
                node.size += child.size
                node.linked += child.linked
                node.talk = node.talk or child.talk
        if node.tag == "a":
            node.linked = node.size
        if node.doubtful:
            node.out = node.size - node.linked < LEAST_TEXT or 2 * node.linked > node.size
        if node.anchor and not node.out:
            node.out = node.talk or not _names_section(node)


def _names_section(node: Node) -> bool:
    """Whether the node begins with a heading of the same words as its id."""
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                return False
        elif not child.out:
            return child.tag in HEADINGS and _words("".join(_text(child))) == _words(node.anchor)
    return False


def _leave_forms(root: Node) -> list[Node]:
    """The kept nodes with their sizes, without the forms that hold half of the unlinked text or less."""
    nodes = _order(root)
    _measure(nodes)
    forms = [node for node in nodes if node.form]
    whole = root.size - root.linked
    for form in forms:
        form.out = form.out or 2 * (form.size - form.linked) <= whole
    if forms:
        nodes = _order(root)
        _measure(nodes)
    return _order(root)


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        if node.parent is not None:
            node.weight = node.parent.weight * (DOUBT if node.doubtful else 1.0)
        if node.tag not in PARAGRAPH:
            continue
        text = "".join(_own(node)) if node.tag in ("div", "section", "td", "li", "dd") else " ".join(_text(node))
        size = len(text.strip())
        if not size:
            continue
        points = (1 + text.count(",") + min(size / 100, 3)) * min(1.0, size / SHORT)
        points *= node.weight * (1 - node.linked / max(node.size, 1))
        up, level = node.parent, 0
        if node.tag in ("div", "section", "td"):  # its own text is a paragraph in it
            node.points += points
            level = 1
        while up is not None and level <= ANCESTORS:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1


def _own(node: Node):
    """Text of a container outside any block in it."""
    todo = list(reversed(node.children))
    while todo:
        child = todo.pop()
        if isinstance(child, str):
            yield child
        elif not child.out and child.tag not in BLOCK:
            todo.extend(reversed(child.children))


def _text(node: Node) -> list[str]:
    """The blocks of a subtree in page order, white space as it stands."""
    out, part = [], []
    todo: list[Node | str | None] = [node]
    while todo:
        item = todo.pop()
        if item is None:
            out.append("".join(part))
            part = []
        elif isinstance(item, str):
            part.append(item)
        elif not item.out:
            block = item.tag in BLOCK
            if block:
                todo.append(None)
            todo.extend(reversed(item.children))
            if block:
                todo.append(None)
    out.append("".join(part))
    return out


def _beside(best: Node) -> list[Node]:
    """The best container and what belongs to it among its siblings, in page order."""
    least = max(10.0, 0.2 * best.points)
    kept: list[Node] = []
    followed = False
    for part in reversed(_runs(best)):
        sparse = 1 - part.linked / max(part.size, 1)
        if part.tag in HEADINGS:  # of the page, or of what follows
            keep = bool(kept) if part.tag == "h1" else followed
        elif part.tag == "run":
            keep = part.size >= SHORT and sparse > 0.5
        else:
            keep = part.points * sparse >= least or part.tag in BESIDE and sparse > 0.5
        followed = part is best or keep
        if followed:
            kept.append(part)
    return kept[::-1]


def _runs(best: Node) -> list[Node]:
    """``best`` and its siblings; text and inline elements between two others are one "run"."""
    out: list[Node] = []
    run: Node | None = None
    for child in best.parent.children:
        if isinstance(child, Node) and child.out:
            continue
        if isinstance(child, Node) and (child is best or child.tag not in INLINE):
            out.append(child)
            run = None
            continue
        if run is None:
            run = Node("run", None, False)
            out.append(run)
        run.children.append(child)
        run.size += len(child.strip()) if isinstance(child, str) else child.size
        run.linked += 0 if isinstance(child, str) else child.linked
    return out


def main_text(html: str | None) -> str:
    """The article of one page, blocks joined by single spaces."""
    if not html:
        return ""
    root = parse(html)
    nodes = _leave_forms(root)
    _score(nodes)
    best = max(nodes, key=lambda n: n.points * (1 - n.linked / max(n.size, 1)), default=root)
    if best.points <= 0:
        best = root
    while best.tag in PARTS and best.parent is not None:
        best = best.parent
    for tag in ("article", "main"):
        node = best
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None:
            best = node
            break
    kept = [best] if best.parent is None else _beside(best)
    blocks = (" ".join(block.split()) for node in kept for block in _text(node))
    return " ".join(block for block in blocks if block)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` of every page with its main text and the text's code points."""
    kept = pages.select(*keep, F.col(html).alias("__html"))
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return kept.mapInArrow(run, schema)
