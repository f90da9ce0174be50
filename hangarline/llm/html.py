"""Main text of web pages by wrapper induction.

Pages of one host are parsed to trees, in which siblings of one kind (element and marks, numbers in them left out) fold into
one node. Simple tree matching aligns the folded trees of all layouts of a host one after another with a template, which
takes in what it lacks; nodes that fewer than half of the host's pages have are pruned. Then every page of the host is
aligned with the template. Nodes match by element, so a page's own ids and classes are no obstacle; equal marks
only break ties. Text that stands at the same template node on nearly all different pages of the host is constant and belongs to
the template; nodes whose text varies are slots. Slots in regions marked as menus, headers, footers, sidebars, notices,
adverts, forms or comments, by element, role or class, or that consist of links, are dropped: no alignment can tell them from content. The
other slots, inside the article where there is one, are content.

Scale: three passes over the scan, in which pages are worked one by one. The first reduces each page to its layout and two
hashes. A host's template comes from all its layouts. Where they are more than LAYOUTS, batches of about LAYOUTS layouts of
similar frequency give a template each, in tasks of their own. A node that half of all pages have is had by half of the
pages of some batch, so no such node is lost when these templates are united, again in batches, until a host has one. All
layouts are then aligned with it and its nodes counted, and those that fewer than half of the host's pages have go.
Constant texts are counted over all pages, by a hash of node and text, 24 bytes each. Template and constants are joined to the pages by host: Spark broadcasts the written table if
it is small, else it shuffles pages, and splits a host that holds too many of them. Matching a page costs at most its nodes
times the template's, once for each layout in a batch; an element has at most CHILD_KINDS folded children.
Pages differ by title; in hosts with fewer than CONSTANT_TITLES titles, by their text.

Null or empty html gives an empty text. A null url, or one without a host, belongs to the host of the empty name. Repeated
rows are extracted one by one and count once in the template. Very long pages are read whole. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from hashlib import blake2b
from html import unescape
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hangarline.llm.common import written

#: So many layouts, as expected, are aligned in one batch; a host with more has several batches.
LAYOUTS = 32
#: An element with more kinds of children folds them by element alone, and with more elements, all into one.
CHILD_KINDS = 64
#: A matched pair of nodes outweighs any number of equal marks.
PAIR = 1 << 20
#: Text is constant if so many different pages of a host have it at its node, out of so many at least.
CONSTANT_SHARE = 0.9
CONSTANT_TITLES = 8
#: A region outside the article is a menu if so much of its text is in links.
LINK_SHARE = 0.8
#: Elements nested deeper become siblings, as browsers do at a depth of theirs.
MAX_DEPTH = 200

#: Fixed values of HTML: elements by their part in the text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe xmp noembed noframes template".split())
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
CLOSES_ITSELF |= {"td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
CONTAINERS = frozenset("html body article main section div table ul ol dl nav header footer aside form".split())
#: What marks regions that are not content.
DROPPED_ELEMENTS = frozenset(
    "head nav footer aside form script style noscript template iframe object embed svg canvas button select input "
    "textarea dialog menu audio video title".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROPPED_CLASSES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner promo promotion sponsor sponsored nav navbar "
    "navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription share sharing social related recommended comment "
    "comments commentlist respond disqus replies widget toolbar pagination pager login signup search skip copyright".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
NUMBER = re.compile(r"\d+")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Node:
    """An element: its tag, what of its attributes counts, and its children, which are nodes and strings."""

    __slots__ = ("tag", "marks", "children", "place")

    def __init__(self, tag: str, marks: str = ""):
        self.tag, self.marks = tag, marks
        self.children: list[Node | str] = []
        self.place: int | None = None

    @property
    def kind(self) -> str:
        return f"{self.tag} {NUMBER.sub('', self.marks)}" if self.marks else f"{self.tag} "


def _marks(attributes: str) -> str:
    """class, id and role of a start tag in one spelling; `hidden` if the element is not shown."""
    found = []
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            found.append("hidden")
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                found.append("hidden")
        elif value:
            found += [f"{name}={part}" for part in value.lower().split()]
    return " ".join(found)


def parse(html: str) -> Node:
    """The tree of a page, however it is closed. Text in elements such as scripts is not read."""
    root = Node("#root")
    stack, at = [root], 0

    def add_text(text: str) -> None:
        if text:
            stack[-1].children.append(unescape(text) if "&" in text else text)

    match = TOKEN.search(html)
    while match:
        add_text(html[at : match.start()])
        at = match.end()
        closing, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if tag:
            tag = tag.lower()
            if closing:
                _close(stack, tag)
            else:
                _imply_ends(stack, tag)
                node = Node(tag, _marks(attributes) if attributes else "")
                stack[-1].children.append(node)
                if tag in RAW:
                    end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
                    if tag == "title":
                        node.children.append(html[at : end.start() if end else len(html)])
                    close = html.find(">", end.start()) if end else -1
                    at = close + 1 if close >= 0 else len(html)
                elif tag not in VOID and len(stack) < MAX_DEPTH:
                    stack.append(node)
        match = TOKEN.search(html, at)
    add_text(html[at:])
    return root


def _close(stack: list[Node], tag: str) -> None:
    """An end tag closes the nearest open element of its name; one of an inline element does not reach out of a block."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag == tag:
            del stack[depth:]
            return
        if tag in INLINE and stack[depth].tag not in INLINE or tag == "p" and stack[depth].tag in CONTAINERS:
            return


def _imply_ends(stack: list[Node], tag: str) -> None:
    """A block ends an open paragraph; a list item, cell or row ends its predecessor."""
    ends = CLOSES_ITSELF.get(tag) or ({"p"} if tag not in INLINE and tag not in RAW else set())
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in ends:
            del stack[depth:]
            return
        if stack[depth].tag in CONTAINERS:
            return


def _named(path: int, part: str) -> int:
    """The name of what stands below a path: 64 bits, the same in every process."""
    digest = blake2b(f"{path} {part}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


class Place:
    """A node of a template: kind, weight of the pages that have it, and folded children."""

    __slots__ = ("kind", "tag", "weight", "children", "number")

    def __init__(self, kind: str, children: list[Place] | None = None):
        self.kind, self.tag = kind, kind.partition(" ")[0]
        self.weight, self.number = 0, -1
        self.children = children or []

    def layout(self) -> list:
        return [self.kind, [child.layout() for child in self.children]]


def _place(layout: list) -> Place:
    return Place(layout[0], [_place(child) for child in layout[1]])


def _kinds(nodes: list[Node]) -> dict[str, list[Node]]:
    """Children of some nodes by kind, in order of their first; of at most CHILD_KINDS kinds."""
    children = [x for node in nodes for x in node.children if isinstance(x, Node) and x.tag not in RAW and x.tag != "head"]
    for kind in (lambda x: x.kind, lambda x: f"{x.tag} ", lambda x: "* "):
        groups: dict[str, list[Node]] = {}
        for child in children:
            groups.setdefault(kind(child), []).append(child)
        if len(groups) <= CHILD_KINDS:
            break
    return groups


def folded(root: Node) -> tuple[list, list]:
    """The layout of a page: kind and folded children; and, in the same form, the nodes that each folded node stands for."""

    def fold(kind: str, nodes: list[Node]) -> tuple[list, list]:
        below = [fold(name, group) for name, group in _kinds(nodes).items()]
        return [kind, [x for x, _ in below]], [nodes, [x for _, x in below]]

    return fold(root.kind, [root])


def tree_match(place: Place, tree: Place, known: dict | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: weight of the largest matching that keeps order and depth, and its pairs of children.

    Each pair of nodes is matched once; `known` holds the results.
    """
    known = {} if known is None else known
    if place.tag != tree.tag:
        return 0, []
    if (id(place), id(tree)) in known:
        return known[id(place), id(tree)]
    m, n = len(place.children), len(tree.children)
    weights = [[tree_match(a, b, known)[0] for b in tree.children] for a in place.children]
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        row, above, weight = best[i], best[i - 1], weights[i - 1]
        for j in range(1, n + 1):
            row[j] = max(above[j], row[j - 1], above[j - 1] + weight[j - 1])
    pairs, i, j = [], m, n
    while i and j:
        if weights[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weights[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    known[id(place), id(tree)] = best[m][n] + PAIR + (place.kind == tree.kind), pairs[::-1]
    return known[id(place), id(tree)]


def take_in(place: Place, tree: Place, weight: int, known: dict | None = None) -> None:
    """Align a tree with the template and put what the template lacks at its position."""
    known = {} if known is None else known
    place.weight += weight
    pairs = {j: i for i, j in tree_match(place, tree, known)[1]}
    merged, at = [], 0
    for j, child in enumerate(tree.children):
        if j in pairs:
            merged += place.children[at : pairs[j]]
            at = pairs[j] + 1
            where = place.children[pairs[j]]
        else:
            where = Place(child.kind)
        take_in(where, child, weight, known)
        merged.append(where)
    place.children = merged + place.children[at:]


def united(layouts: list[tuple[list, int]]) -> Place:
    """The template of pages with these layouts and weights: what any of them has."""
    template = Place("#root ")
    for layout, weight in sorted(layouts, key=lambda x: (-x[1], json.dumps(x[0]))):
        take_in(template, _place(layout), weight)
    return template


def pruned(template: Place) -> Place:
    """The template without nodes of less than half the weight of its root."""

    def prune(place: Place) -> None:
        place.children = [child for child in place.children if 2 * child.weight >= template.weight]
        for child in place.children:
            prune(child)

    prune(template)
    return template


def induced(layouts: list[tuple[list, int]]) -> Place:
    """The template of pages with these layouts and weights: what at least half of them have."""
    return pruned(united(layouts))


class Template:
    """A numbered template; `assign` gives each node of a page the number of its template node."""

    def __init__(self, root: Place):
        self.root, self.known = root, {}
        stack, count = [root], 0
        while stack:
            place = stack.pop()
            place.number, count = count, count + 1
            stack += reversed(place.children)

    def _numbers(self, layout: list) -> list:
        known: dict = {}

        def number(place: Place, tree: Place) -> list:
            pairs = {j: i for i, j in tree_match(place, tree, known)[1]}
            below = [number(place.children[pairs[j]], x) if j in pairs else None for j, x in enumerate(tree.children)]
            return [place.number, below]

        return number(self.root, _place(layout))

    def found(self, layout: list) -> list[int]:
        """The numbers of the template nodes that a layout has."""
        out, stack = [], [self._numbers(layout)]
        while stack:
            number, below = stack.pop()
            out.append(number)
            stack += [x for x in below if x is not None]
        return out

    def pruned(self, weights: dict[int, int]) -> Place:
        """The tree without nodes of less than half the weight of its root; weights are given by number."""
        stack = [self.root]
        while stack:
            place = stack.pop()
            place.weight = weights.get(place.number, 0)
            stack += place.children
        return pruned(self.root)

    def assign(self, root: Node) -> None:
        layout, nodes = folded(root)
        key = json.dumps(layout)
        if key not in self.known:
            self.known[key] = self._numbers(layout)
        stack = [(nodes, self.known[key])]
        while stack:
            (members, below), (number, numbers) = stack.pop()
            for node in members:
                node.place = number
            stack += [(x, y) for x, y in zip(below, numbers, strict=True) if y is not None]


def _own_text(node: Node) -> str:
    return " ".join("".join(child if isinstance(child, str) else " " for child in node.children).split())


def _dropped(node: Node) -> bool:
    """The region is marked as something else than content."""
    if node.tag in ("article", "main", "body", "html"):
        return "hidden" in node.marks.split()
    if node.tag in DROPPED_ELEMENTS:
        return True
    for mark in node.marks.split():
        name, _, value = mark.partition("=")
        if name == "hidden" or (name == "role" and value in DROPPED_ROLES):
            return True
        if name in ("class", "id") and not DROPPED_CLASSES.isdisjoint(re.split(r"[-_]+", value)):
            return True
    return False


def _text_sizes(node: Node, in_link: bool = False) -> tuple[int, int]:
    """Characters of text below a node, and how many of them in links."""
    total = linked = 0
    for child in node.children:
        if isinstance(child, str):
            size = len(child.strip())
            total, linked = total + size, linked + size * in_link
        elif child.tag not in RAW:
            below = _text_sizes(child, in_link or child.tag == "a")
            total, linked = total + below[0], linked + below[1]
    return total, linked


def _find(node: Node, tags: tuple[str, ...]) -> list[Node]:
    """The outermost elements of these names that are not in dropped regions."""
    found = []
    for child in node.children:
        if isinstance(child, Node) and not _dropped(child):
            found += [child] if child.tag in tags else _find(child, tags)
    return found


def _blocks(node: Node, constants: set[int], out: list[list[str]], in_article: bool) -> None:
    """Text below a node, in blocks; constant text of the template and dropped regions are left out."""
    constant = bool(constants) and node.place is not None and _named(node.place, _own_text(node)) in constants
    for child in node.children:
        if isinstance(child, str):
            if not constant:
                out[-1].append(child)
            continue
        if _dropped(child) or (child.tag == "header" and not in_article):
            continue
        if child.tag == "br":
            out[-1].append(" ")
            continue
        block = child.tag not in INLINE
        if block and not in_article and child.tag in ("ul", "ol", "div", "section", "table", "p"):
            total, linked = _text_sizes(child)
            if total and linked >= LINK_SHARE * total:
                continue
        if block:
            out.append([])
        _blocks(child, constants, out, in_article or child.tag in ("article", "main"))
        if block:
            out.append([])


def named_texts(root: Node) -> set[int]:
    """Names of template node and text, of all aligned nodes of a page that have text."""
    found: set[int] = set()
    stack = [root]
    while stack:
        node = stack.pop()
        if node.place is not None and (text := _own_text(node)):
            found.add(_named(node.place, text))
        stack += [x for x in node.children if isinstance(x, Node)]
    return found


def main_text(root: Node, constants: set[int]) -> str:
    """The text of a parsed page, whose nodes have their places, without constants and dropped regions."""
    mains = _find(root, ("article",)) or _find(root, ("main",))
    out: list[list[str]] = [[]]
    for main in mains or [root]:
        out.append([])
        _blocks(main, constants, out, bool(mains))
    blocks = (" ".join("".join(parts).split()) for parts in out)
    return "\n".join(block for block in blocks if block)


def host_template(layouts: dict[str, int]) -> Place:
    """The template of a host with these layouts and weights; the same rules as `host_templates`."""

    def fold(trees: dict[str, int], by_weight: bool, join: Callable) -> dict[str, int]:
        batches: dict[tuple[int, int], list[tuple[str, int]]] = defaultdict(list)
        sizes = Counter(n.bit_length() if by_weight else 0 for n in trees.values())
        for tree, n in trees.items():
            size = n.bit_length() if by_weight else 0
            one = len(trees) <= LAYOUTS
            batches[(0, 0) if one else (size, crc32(tree.encode()) % -(-sizes[size] // LAYOUTS))].append((tree, n))
        out: dict[str, int] = defaultdict(int)
        for batch in batches.values():
            place = join([(json.loads(tree), n) for tree, n in batch])
            out[json.dumps(place.layout())] += place.weight
        return out

    trees = fold(layouts, True, induced)
    several = len(trees) > 1
    while len(trees) > 1:
        trees = fold(trees, False, united)
    template = Template(_place(json.loads(next(iter(trees)))))
    if several:
        weights: dict[int, int] = defaultdict(int)
        for layout, n in layouts.items():
            for number in template.found(json.loads(layout)):
                weights[number] += n
        return template.pruned(weights)
    return template.root


def extract_group(pages: list[str]) -> list[str]:
    """Main texts of the pages of one host, all of them given; the same rules as `main_texts`."""
    roots = [parse(html) for html in pages]
    titles, contents = [_title(root) for root in roots], [_whole_text(root) for root in roots]
    by_page = titles if len(set(titles)) >= CONSTANT_TITLES else contents
    different, constants = len(set(by_page)), set()
    if different >= CONSTANT_TITLES:
        layouts: dict[str, set[str]] = defaultdict(set)
        for root, content in zip(roots, contents, strict=True):
            layouts[json.dumps(folded(root)[0])].add(content)
        template = Template(host_template({layout: len(x) for layout, x in layouts.items()}))
        on: dict[int, set[str]] = defaultdict(set)
        for root, page in zip(roots, by_page, strict=True):
            template.assign(root)
            for name in named_texts(root):
                on[name].add(page)
        constants = {name for name, x in on.items() if len(x) >= CONSTANT_SHARE * different}
    return [main_text(root, constants) for root in roots]


def _title(root: Node) -> str:
    """The page's title, by which copies of one article count once."""
    stack: list[Node | str] = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, Node):
            if node.tag == "title":
                return " ".join("".join(x for x in node.children if isinstance(x, str)).split())
            stack += reversed(node.children)
    return ""


def _whole_text(node: Node) -> str:
    """All text of a page but that of the title."""
    parts = [c if isinstance(c, str) else _whole_text(c) for c in node.children if isinstance(c, str) or c.tag != "title"]
    return " ".join(" ".join(parts).split())


def _roots(pdf: pd.DataFrame) -> Iterator[Node]:
    return (parse(html if isinstance(html, str) else "") for html in pdf["html"])


def _page_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """host, title, content (64 bits of what `_title` and `_whole_text` return), layout."""
    for pdf in batches:
        found = [
            (host, _named(0, _title(root)), _named(0, _whole_text(root)), json.dumps(folded(root)[0]))
            for host, root in zip(pdf["host"], _roots(pdf), strict=True)
        ]
        yield pd.DataFrame(found, columns=["host", "title", "content", "layout"])


def _join_batch(join: Callable) -> Callable:
    def run(key: tuple, trees: pd.DataFrame) -> pd.DataFrame:
        place = join([(json.loads(tree), int(n)) for tree, n in zip(trees["layout"], trees["n"], strict=True)])
        return pd.DataFrame({"host": [key[0]], "layout": [json.dumps(place.layout())], "n": [place.weight]})

    return run


def _joined(trees: DataFrame, by_weight: bool, join: Callable) -> DataFrame:
    """host, layout, n: the trees of each host joined in batches of about LAYOUTS; by_weight: weights differ by less than twice."""
    trees = trees.withColumn("bits", F.length(F.bin("n")) if by_weight else F.lit(0))
    sizes = trees.groupBy("host", "bits").agg(F.count("*").alias("trees"))
    sizes = sizes.withColumn("all_trees", F.sum("trees").over(Window.partitionBy("host")))
    one, batches = F.col("all_trees") <= LAYOUTS, F.ceil(F.col("trees") / LAYOUTS)
    dealt = trees.join(sizes, ["host", "bits"]).select(
        "host", "layout", "n", F.when(one, 0).otherwise(F.col("bits")).alias("bits"),
        F.when(one, 0).otherwise(F.crc32("layout") % batches).alias("batch"),
    )
    batched = dealt.groupBy("host", "bits", "batch").applyInPandas(_join_batch(join), "host string, layout string, n long")
    return written(batched.groupBy("host", "layout").agg(F.sum("n").alias("n")))


def _most_trees(trees: DataFrame) -> int:
    """How many trees the host with the most has."""
    return trees.groupBy("host").count().agg(F.max("count")).first()[0] or 0


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """host, number, n: the weight of the layouts that have a template node."""
    for pdf in batches:
        templates: dict[str, Template] = {}
        weights: dict[tuple[str, int], int] = defaultdict(int)
        for host, layout, n, tree in zip(pdf["host"], pdf["layout"], pdf["n"], pdf["template"], strict=True):
            if tree not in templates:
                templates[tree] = Template(_place(json.loads(tree)))
            for number in templates[tree].found(json.loads(layout)):
                weights[host, number] += n
        yield pd.DataFrame([(*key, n) for key, n in weights.items()], columns=["host", "number", "n"])


def _prune_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for tree, numbers, weights in zip(pdf["template"], pdf["numbers"], pdf["weights"], strict=True):
            place = Template(_place(json.loads(tree))).pruned(dict(zip(map(int, numbers), map(int, weights), strict=True)))
            out.append(json.dumps(place.layout()))
        yield pd.DataFrame({"host": pdf["host"], "template": out})


def host_templates(kinds: DataFrame, hosts: DataFrame) -> DataFrame:
    """host, template, of hosts with enough different pages."""
    enough = hosts.where(F.col("pages") >= CONSTANT_TITLES).select("host")
    layouts = kinds.join(enough, "host").groupBy("host", "layout").agg(F.count_distinct("content").alias("n"))
    layouts = written(layouts)
    trees = _joined(layouts, True, induced)
    most = _most_trees(trees)
    if most <= 1:
        return trees.select("host", F.col("layout").alias("template"))
    several = written(trees.groupBy("host").count().where("count > 1").select("host"))
    alone = trees.join(several, "host", "left_anti").select("host", F.col("layout").alias("template"))
    trees = trees.join(several, "host")
    while most > 1:
        trees = _joined(trees, False, united)
        most = _most_trees(trees)
    whole = trees.select("host", F.col("layout").alias("template"))
    counted = layouts.join(whole, "host").mapInPandas(_count_batches, "host string, number long, n long")
    counted = counted.groupBy("host", "number").agg(F.sum("n").alias("n"))
    # Structs, so that number and weight stay side by side.
    listed = counted.groupBy("host").agg(F.collect_list(F.struct("number", "n")).alias("found"))
    weighed = whole.join(listed, "host").select("host", "template", F.col("found.number").alias("numbers"), F.col("found.n").alias("weights"))
    return alone.union(weighed.mapInPandas(_prune_batches, "host string, template string"))


class _Templates:
    """The templates of a task, parsed once for each batch."""

    def __init__(self):
        self.known: dict[str, Template] = {}

    def assign(self, root: Node, layout: str) -> None:
        if layout not in self.known:
            self.known[layout] = Template(_place(json.loads(layout)))
        self.known[layout].assign(root)


def _name_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows: set[tuple[int, int, int]] = set()
        templates = _Templates()
        for key, root, by_title, layout in zip(pdf["host_key"], _roots(pdf), pdf["by_title"], pdf["template"], strict=True):
            templates.assign(root, layout)
            page = _named(0, _title(root) if by_title else _whole_text(root))
            rows.update((key, name, page) for name in named_texts(root))
        yield pd.DataFrame(list(rows), columns=["host_key", "name", "page"])


def host_constants(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """host, names: constant texts of each host. hosts: host, by_title, pages (how many differ), template."""
    placed = rows.join(hosts, "host").select(F.xxhash64("host").alias("host_key"), "html", "by_title", "template")
    named = placed.mapInPandas(_name_batches, "host_key long, name long, page long")
    counts = named.groupBy("host_key", "name").agg(F.count_distinct("page").alias("on"))
    counts = written(counts.where(F.col("on") >= CONSTANT_SHARE * CONSTANT_TITLES))
    keyed = hosts.select("host", "pages", F.xxhash64("host").alias("host_key"))
    constant = counts.join(keyed, "host_key").where(F.col("on") >= CONSTANT_SHARE * F.col("pages"))
    return constant.groupBy("host").agg(F.collect_list("name").alias("names"))


def _extract_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        templates, texts = _Templates(), []
        for root, layout, names in zip(_roots(pdf), pdf["template"], pdf["names"], strict=True):
            if isinstance(layout, str):
                templates.assign(root, layout)
            texts.append(main_text(root, set(names) if isinstance(layout, str) else set()))
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text (empty if the page has none), n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.withColumn("host", host)
    # Tables by host are written, so that their size is known when the joins are planned.
    kinds = rows.select("host", "html").mapInPandas(_page_batches, "host string, title long, content long, layout string")
    kinds = written(kinds)
    titles, contents = F.count_distinct("title"), F.count_distinct("content")
    by_title = (titles >= CONSTANT_TITLES).alias("by_title")
    different = F.when(titles >= CONSTANT_TITLES, titles).otherwise(contents).alias("pages")
    hosts = written(kinds.groupBy("host").agg(by_title, different))
    hosts = written(hosts.join(host_templates(kinds, hosts), "host"))
    learned = written(hosts.select("host", "template").join(host_constants(rows, hosts), "host"))
    schema = "page_id long, url string, text string, n_chars long"
    return rows.join(learned, "host", "left").select("page_id", "url", "html", "template", "names").mapInPandas(_extract_batches, schema)
