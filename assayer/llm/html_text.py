"""Main text of web pages by wrapper induction.

Pages of one host are aligned with a reference page of that host by simple tree
matching: two trees match if their roots do, and the matching of their children,
in order, that pairs most nodes is taken. Over all pages of a host each node of
the reference counts how often it was met and how often with the same text. Nodes
that nearly always read the same are template, inside `article` and `main` as
elsewhere; the varying slots hold the content. Of a run of equal siblings each
text of the reference is counted by itself. Pages that read like the reference as
a whole are no evidence. Elements made for other things (menus, footers, forms and
the like, by tag, role, class or id) are no content either. What a page declares
by `article` or `main` is a hint: it is taken if it holds most of the varying
text, else all varying text is. Hosts of fewer than `LEAST_PAGES` different pages
have no template; there the declared text is taken, whole.

A host's pages never meet in one task: a reference is a small row that every page
of the host is joined with, and the counts are summed up per batch. References
are broadcast while they are few; else the join is a shuffle, of which adaptive
execution splits hot hosts.

NULL and empty pages have an empty text. Pages without a host are pages of the
host ''. Repeated rows are extracted one by one; extra columns are passed on, and
columns named like an output are replaced.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter, OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm import common

# The reference of a host is the page whose length is next to this.
REFERENCE_CHARS = 3000
# References that are broadcast at most.
BROADCAST_HOSTS = 20_000
# Pages a node must be met on, and the share of equal texts that makes it template.
LEAST_PAGES, CONSTANT = 3, 0.8
# Share of the varying text that a declared main text must hold.
DECLARED = 0.5
# Alignments a worker remembers.
REMEMBERED = 4096
DEEPEST = 200

# What HTML and common class names say about elements.
RAW = "script style noscript template iframe svg math textarea select object canvas".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
ASIDE = set("nav footer aside form head button dialog menu header".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
ASIDE_NAMES = set(
    "nav navbar navigation menu header masthead footer sidebar side aside ad ads advert "
    "advertisement adverts banner promo sponsor sponsored cookie cookies consent notice alert "
    "comment comments disqus reply replies related recommended share sharing social breadcrumb "
    "breadcrumbs widget popup modal overlay subscribe newsletter signup login search pagination "
    "toolbar".split()
)
COMMENTS = set("comment comments disqus reply replies".split())
# What an inline element is called that holds no part of its sentence.
INLINE_ASIDE = set("ad ads advert advertisement promo sponsored".split())
# A name that begins so says what a page has or lacks, not what the element is.
ABOUT = set("with without no has is hide show".split())
# A header of these is part of the text.
OWN = set("entry article post page content story".split())
MAIN = ("article", "main")
LISTED = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "td": "td th", "th": "td th",
          "option": "option"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?a-z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "aside", "main", "children", "comments", "unsure")

    def __init__(self, tag: str, rest: str = "") -> None:
        self.tag, self.children = tag, []
        marks = {k.lower(): v.strip("\"'").lower() for k, v in _MARKS.findall(rest)} if rest else {}
        names = aside_names(tag, f"{marks.get('class', '')} {marks.get('id', '')}") if marks else set()
        role = marks.get("role", "")
        # A reader's comment is often an article of its own.
        self.comments = bool(names & COMMENTS)
        self.main = not self.comments and (tag in MAIN or role == "main" or role == "article")
        declared = tag in ASIDE or role in ASIDE_ROLES
        self.aside = not self.main and (declared or bool(names))
        # Not if it holds most of the page after all.
        self.unsure = self.aside and not self.comments and (not declared or tag == "form")


def aside_names(tag: str, marks: str) -> set[str]:
    """What the classes and the id of an element say it is, if it is no main text."""
    found: set[str] = set()
    if tag in ("html", "body"):
        return found
    for token in marks.split():
        parts = _NAME.findall(token)
        names = ASIDE_NAMES.intersection(parts)
        if not names or parts[0] in ABOUT or (names == {"header"} and OWN.intersection(parts)):
            continue
        if tag not in INLINE or names & COMMENTS or token in INLINE_ASIDE:
            found |= names
    return found


def keep_large(root: Node) -> None:
    """Elements that only their names set aside are kept if they hold most of the text."""
    sizes: dict[int, int] = {}

    def measure(node: Node) -> int:
        size = 0
        for child in node.children:
            size += len(child.strip()) if isinstance(child, str) else measure(child)
        if node.unsure:
            sizes[id(node)] = size
        return size

    whole = measure(root)

    def decide(node: Node) -> None:
        for child in node.children:
            if not isinstance(child, str):
                if child.unsure and 2 * sizes[id(child)] > whole:
                    child.aside = False
                decide(child)

    if sizes:
        decide(root)


def parse(page: str) -> Node:
    """The tree of a page; unclosed elements end where HTML lets them end."""
    root = Node("#")
    stack = [root]

    def close(tags, stops) -> None:
        """Close the innermost open element of some tags, unless another stands before."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stops and stack[k].tag not in INLINE and stack[k].tag not in ("p", *tags):
                return

    for token in _TOKEN.finditer(page):
        if token["text"] is not None:
            stack[-1].children.append(token["text"])
            continue
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if token["end"]:
            close((tag,), tag in INLINE or tag == "p" or tag in LISTED)
            continue
        if tag not in INLINE:
            close(("p",), True)
        if tag in LISTED:
            close(tuple(LISTED[tag].split()), True)
        if tag in MAIN:  # never inside an unclosed menu or the like
            for k in range(1, len(stack)):
                if stack[k].comments:
                    break
                if stack[k].aside and not stack[k].unsure:
                    del stack[k:]
                    break
        node = Node(tag, token["rest"])
        stack[-1].children.append(node)
        if tag not in VOID and not token["rest"].endswith("/"):
            if len(stack) >= DEEPEST and not node.aside:
                # What is in it stands behind it, so that no tree is too deep to walk.
                node = Node(tag)
                node.aside = node.main = node.unsure = False
                node.children = stack[-1].children
            stack.append(node)
    keep_large(root)
    return root


def blocks(node: Node, leave=lambda node: False) -> list[str]:
    """The texts of the blocks below a node, without the elements to leave out."""
    found: list[str] = []
    own: list[str] = []

    def end() -> None:
        if own:
            text = _SPACE.sub(" ", html.unescape("".join(own))).strip()
            if text:
                found.append(text)
            own.clear()

    def walk(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str):
                own.append(child)
            elif child.tag == "br":
                own.append(" ")
            elif child.tag in INLINE:
                if not leave(child):
                    walk(child)
            else:
                end()
                if not leave(child):
                    walk(child)
                end()

    walk(node)
    end()
    return found


def main_nodes(root: Node) -> list[list[Node]]:
    """The elements that a page declares as its main text: articles, and main ones."""
    found: dict[bool, list[Node]] = {True: [], False: []}

    def walk(node: Node, outer: bool) -> None:
        for child in node.children:
            if isinstance(child, str) or child.aside:
                continue
            article = child.main and child.tag != "main"
            if child.main and not (outer and article):
                found[article].append(child)
            walk(child, outer or article)

    walk(root, False)
    return [nodes for nodes in (found[True], found[False][:1]) if nodes]


def skeleton(node: Node) -> tuple[list, list]:
    """A tree's tags as nested lists, and the nodes each entry stands for.

    Runs of equal siblings are one entry without inner ones, so that lists and
    texts of any length align alike. Inline elements are left out.
    """
    tags, parts, last = [node.tag], [], None
    for child in node.children:
        if isinstance(child, str) or child.tag in INLINE:
            continue
        tree, inner = skeleton(child)
        if tree == last:
            tags[-1] = [f"*{child.tag}"]
            parts[-1][0].append(child)
            parts[-1][1] = []
        else:
            tags.append(tree)
            parts.append([[child], inner])
        last = tree
    return tags, parts


def readings(root: Node) -> dict[int, str]:
    """The text of each node that may stand in a skeleton."""
    found: dict[int, str] = {}

    def walk(node: Node) -> str:
        parts = []
        for child in node.children:
            if isinstance(child, str):
                parts.append(child)
            elif child.tag in INLINE:
                parts.append(walk(child))
            else:
                parts.append(f"\n{walk(child)}\n")
        text = "".join(parts)
        if node.tag not in INLINE:
            found[id(node)] = " ".join(html.unescape(text).split())
        return text

    walk(root)
    return found


def align(one: list, two: list) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """Simple tree matching of two outlines: paths of the nodes that are paired."""
    memory: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def match(a: list, b: list) -> int:
        # A run of siblings may be one of a single element.
        if a[0].lstrip("*") != b[0].lstrip("*"):
            return 0
        key = (id(a), id(b))
        if key not in memory:
            # Equal entries at both ends pair up; the rest takes dynamic programming.
            m, n, low = len(a) - 1, len(b) - 1, 0
            while low < min(m, n) and a[low + 1] == b[low + 1]:
                low += 1
            while m > low and n > low and a[m] == b[n]:
                m, n = m - 1, n - 1
            ends = [*zip(range(1, low + 1), range(1, low + 1), strict=True)]
            ends += zip(range(m + 1, len(a)), range(n + 1, len(b)), strict=True)
            total = sum(match(a[i], b[j]) for i, j in ends)
            best = [[0] * (n + 1) for _ in range(m + 1)]
            pair = [[0] * (n + 1) for _ in range(m + 1)]
            for i in range(low + 1, m + 1):
                for j in range(low + 1, n + 1):
                    pair[i][j] = match(a[i], b[j])
                    best[i][j] = max(
                        best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + pair[i][j]
                    )
            total += best[m][n]
            pairs, i, j = [], m, n
            while i > low and j > low:
                if pair[i][j] and best[i][j] == best[i - 1][j - 1] + pair[i][j]:
                    pairs.append((i, j))
                    i, j = i - 1, j - 1
                elif best[i][j] == best[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
            memory[key] = (total + 1, sorted([*ends, *pairs]))
        return memory[key][0]

    found = []

    def collect(a: list, b: list, at: tuple[int, ...], bt: tuple[int, ...]) -> None:
        found.append((at, bt))
        for i, j in memory[(id(a), id(b))][1]:
            collect(a[i], b[j], (*at, i - 1), (*bt, j - 1))

    if match(one, two):
        collect(one, two, (), ())
    return found


class Wrapper:
    """A host's reference, and what is known of its nodes."""

    def __init__(self, reference: str) -> None:
        data = json.loads(reference)
        self.outline = data["outline"]
        # The number of each text of an entry; an entry without texts has none.
        self.numbers: list[dict[str, int]] = []
        size = 0
        for texts in data["texts"]:
            self.numbers.append({text: size + k for k, text in enumerate(texts)})
            size += len(texts)
        self.whole = data["texts"][0]
        self.paths: OrderedDict[str, list] = OrderedDict()

    def pairs(self, root: Node) -> list[tuple[list[Node], dict[str, int]]]:
        """Nodes of a page with the numbers of the reference's texts they are aligned with."""
        own, parts = skeleton(root)
        key = json.dumps(own)
        if key not in self.paths:
            if len(self.paths) >= REMEMBERED:
                self.paths.popitem(last=False)
            entries = {path: k for k, path in enumerate(_all_paths(self.outline))}
            self.paths[key] = [
                (mine, entries[ref])
                for mine, ref in align(own, self.outline)
                if mine and self.numbers[entries[ref]]
            ]
        return [(_nodes(parts, path), self.numbers[entry]) for path, entry in self.paths[key]]

    def constant(self, root: Node, template: set[int]) -> set[int]:
        """The ids of a page's nodes that read as the template does."""
        read, found = readings(root), set()
        for nodes, numbers in self.pairs(root):
            if not template.isdisjoint(numbers.values()):
                found.update(id(n) for n in nodes if numbers.get(read[id(n)]) in template)
        return found


def _nodes(parts: list, path: tuple[int, ...]) -> list[Node]:
    nodes: list[Node] = []
    for step in path:
        nodes, parts = parts[step]
    return nodes


def _all_paths(tree: list, at: tuple[int, ...] = ()) -> Iterator[tuple[int, ...]]:
    yield at
    for k, child in enumerate(tree[1:]):
        yield from _all_paths(child, (*at, k))


def reference(page: str) -> str:
    """A page as a reference: its skeleton, and the different texts of each entry in it."""
    root = parse(page)
    tree, parts = skeleton(root)
    read = readings(root)
    texts = [
        [t for t in dict.fromkeys(read[id(n)] for n in (_nodes(parts, path) if path else [root])) if t]
        for path in _all_paths(tree)
    ]
    return json.dumps({"outline": tree, "texts": texts})


def extract(page: str | None, wrapper: Wrapper | None, template: set[int] | None) -> str:
    """The main text of a page; `template` is None where too few pages are known."""
    root = parse(page or "")
    known = wrapper is not None and template is not None
    constant = wrapper.constant(root, template) if known and template else set()

    def texts(nodes: list[Node], constant: set[int]) -> list[str]:
        # Inside the main text a header is the text's own.
        inside = nodes != [root]
        leave = lambda n: id(n) in constant or n.aside and not (inside and n.tag == "header")
        return [b for n in nodes if id(n) not in constant for b in blocks(n, leave)]

    declared = main_nodes(root)
    if known:
        every = texts([root], constant)
        for nodes in declared:
            found = texts(nodes, constant)
            if found and sum(map(len, found)) >= DECLARED * sum(map(len, every)):
                return "\n\n".join(found)
        if every:
            return "\n\n".join(every)
    # Nothing varies, or nothing is known: what the page declares, else all.
    return "\n\n".join(texts(declared[0] if declared else [root], set()))


def _host(url: str):
    name = F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(name, r"^.*@|:\d*$", "")


def _with_wrappers(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    few = wrappers.count() <= BROADCAST_HOSTS
    return pages.join(F.broadcast(wrappers) if few else wrappers, "__host", "left")


def references(pages: DataFrame) -> DataFrame:
    """One row per host: (host, reference)."""
    size = F.abs(F.length("html") - REFERENCE_CHARS)
    least = F.struct(size.alias("far"), F.xxhash64("html").alias("hash"))
    chosen = pages.filter("html <> ''").groupBy("__host").agg(F.min(least).alias("least"))
    own = pages.filter("html <> ''").withColumn("least", least)
    rows = own.join(F.broadcast(chosen) if chosen.count() <= BROADCAST_HOSTS else chosen, ["__host", "least"])
    rows = rows.dropDuplicates(["__host"]).select("__host", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.html_text import reference

        for batch in batches:
            made = pa.array([reference(p) for p in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["__host", "reference"])

    return common.settle(rows.mapInArrow(run, "__host string, reference string"))


def templates(pages: DataFrame, refs: DataFrame) -> DataFrame:
    """Hosts' references with the numbers of their nodes that are template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.html_text import Wrapper, parse, readings

        wrappers: dict[str, Wrapper] = {}
        for batch in batches:
            met, same = Counter(), Counter()
            columns = (batch.column(c).to_pylist() for c in ("__host", "html", "reference"))
            for host, page, ref in zip(*columns, strict=True):
                wrapper = wrappers.get(host) or wrappers.setdefault(host, Wrapper(ref))
                root = parse(page)
                read = readings(root)
                if [read[id(root)]] == (wrapper.whole or [""]):
                    continue
                # One number per page that says how many pages there are.
                met[host, -1] += 1
                for nodes, numbers in wrapper.pairs(root):
                    own = {read[id(n)] for n in nodes}
                    for text, number in numbers.items():
                        met[host, number] += 1
                        same[host, number] += text in own
            rows = [(h, n, c, same[h, n]) for (h, n), c in met.items()]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            names = ["__host", "node", "met", "same"]
            arrays = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    met = _with_wrappers(pages.filter("html <> ''").select("__host", "html"), refs)
    counts = met.mapInArrow(run, "__host string, node int, met long, same long")
    counts = counts.groupBy("__host", "node").agg(F.sum("met").alias("met"), F.sum("same").alias("same"))
    # The reference itself is one page more.
    met, same = F.col("met") + 1, F.col("same") + 1
    number = F.when((F.col("node") >= 0) & (met >= LEAST_PAGES) & (same >= CONSTANT * met), F.col("node"))
    # No more numbers than the reference has nodes.
    constant = counts.groupBy("__host").agg(
        F.sort_array(F.collect_list(number)).alias("template"), F.max(met).alias("pages")
    )
    constant = constant.filter(F.col("pages") >= LEAST_PAGES).drop("pages")
    return common.settle(refs.join(constant, "__host", "left"))


def main_text(
    pages: DataFrame, url: str = "url", page: str = "html", text: str = "text"
) -> DataFrame:
    """All rows with their main text, blocks joined by two line ends."""
    common.prepare(pages.sparkSession)
    own = pages.select(_host(url).alias("__host"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    wrappers = templates(own, references(own))
    schema = common.with_columns(pages, [T.StructField(text, T.StringType())])
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assayer.llm.html_text import Wrapper, extract

        known: dict[str, Wrapper] = {}
        for batch in batches:
            for part in common.slices(batch, "__page"):
                found = []
                columns = (part.column(c).to_pylist() for c in ("__host", "__page", "reference", "template"))
                for host, body, ref, numbers in zip(*columns, strict=True):
                    if ref is not None and host not in known:
                        known[host] = Wrapper(ref)
                    template = None if numbers is None else set(numbers)
                    found.append(extract(body, known.get(host), template))
                arrays = [*(part.column(f"own_{c}") for c in kept), pa.array(found, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    # Own columns under other names, so that none clashes.
    renamed = pages.select(
        _host(url).alias("__host"), F.col(page).alias("__page"), *[F.col(c).alias(f"own_{c}") for c in kept]
    )
    return _with_wrappers(renamed, wrappers).mapInArrow(run, schema)
