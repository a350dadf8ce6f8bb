"""Main text of web pages with wrappers inferred per host, as union-free regular expressions.

A page is read as a stream of tags and texts, with left-out end tags put in. Its expression has one item per element: a name, how often it
may come (once, optional, repeated), a digest of its whole text if that is the same on all pages, and the expression of what it holds; runs of equal
elements are repeated items, texts are slots. Pages of a host are aligned item by item: equal names are merged, a mismatch is
resolved by looking ahead on both sides and making what is skipped optional, and slots with different texts become variable. What
comes out, the wrapper, matches every page it was made from.

From the wrapper follows the region of the main text: the article elements outside of boilerplate, else the main element, else the
deepest element with nothing beside it or its ancestors but links, boilerplate and texts that are the same on all pages. Boilerplate are menus, headers, footers, sidebars,
forms, what a whole class, id or role calls an advert, notice, comment and so on (words that may mean something else, and parts of a
longer class or id, only if the element is mostly links or fixed over the host), and plain boxes that say the same on all pages of a host although
the articles differ, wherever they stand. On a host with one page, or whose pages all say the same, nothing can be told to be fixed. Marks never drop html, body, main, headings or the
region itself, and an article only beside another one (comments are articles too). A header is dropped with the headings in it. Each page is then walked along its host's wrapper.

Blocks are block elements; character references are decoded; white space in a block becomes one space.

Scale: a task merges the pages it reads into one wrapper per host, so a host with a third of all pages sends a row per task; these are merged in
salted parts and then per host. Extraction is a join of the pages with what follows from the wrappers, the region and the fixed boxes, one small row per host, without a
hint: Spark sends it to all tasks while it is small and else shuffles and splits a large host.

Edge cases: NULL or empty html has an empty text; a page without the region of its host's wrapper gives its body without boilerplate; a NULL
url, or one without a host, belongs to a host of no name; broken tags and references at the end of cut-off pages are dropped or
kept as text, as browsers do; repeated rows each give a row; empty tables give an empty table; other columns than page_id, url and html are left out.
"""

import hashlib
import html
import json
import re
from bisect import bisect_right
from collections import defaultdict

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from .common import stored

PARTS = 64
HOSTS_AT_ONCE = 2000

_TAG = r"[a-zA-Z][^\s/>]*+"
_ATTRIBUTES = r"""(?:[^>"']|"[^"]*+"|'[^']*+')*+"""
_TOKENS = re.compile(
    rf"(?P<drop><!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|iframe|svg|select|textarea|title)\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*+>?)"
    rf"|<(?P<end>/?)(?P<name>{_TAG})(?P<attributes>{_ATTRIBUTES})>|(?P<broken><[a-zA-Z/][^>]*+>?)|(?P<text>[^<]++|<)",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# A start tag that ends an open element of the names given, if none of the names after it is open above that.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "body": ({"head"}, set()),
}
ENDS_P = BLOCKS - set("body caption dd dt head html legend li summary tbody td tfoot th thead tr".split())
SKIPPED = set("head nav header footer aside form button dialog menu fieldset label input option datalist audio video canvas map".split())
# Words of a class, id or role that mark boilerplate.
MARKS = set(
    "ad ads advert adverts advertisement advertising adsbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup"
    " modal overlay newsletter subscribe subscription signup login paywall sidebar side rail aside nav navbar navigation menu menubar breadcrumb breadcrumbs"
    " footer header masthead topbar toolbar pagination pager comment comments commentlist respond reply replies disqus discussion share sharing social"
    " related recommended recommendations widget search form complementary contentinfo disclaimer".split()
)
# Those that name nothing else when they are a whole class or id, apart from numbers. Others, and words within a longer class or id, are weak:
# they are slugs of headings or layout words as often ("related-work", "no-sidebar") and count only if the element confirms them.
SURE = set(
    "ad ads advert adverts advertisement adsbox sponsored cookie cookies gdpr popup modal overlay newsletter paywall sidebar aside nav navbar menubar"
    " breadcrumb breadcrumbs footer masthead topbar toolbar pagination pager comment comments commentlist respond disqus".split()
)
# As a whole class these are sure as well; an id is a slug more often.
SURE_CLASS = SURE | set("notice notices alert banner consent advertising promo promotion sponsor newsletter subscribe disclaimer".split())
WEAK, OTHER = "?", "!"
# Elements that marks never drop.
KEPT = set("html body main article h1 h2 h3 h4 h5 h6".split())
MAIN_MARKS = {"main"}
BOXES = {"div", "section", "span", "ul", "ol", "table", "blockquote", "figure"}


class Node:
    __slots__ = ("name", "marks", "kids", "link")

    def __init__(self, name, marks=(), link=False):
        self.name, self.marks, self.kids, self.link = name, marks, [], link


def _marks(attributes, name):
    found = set()
    for kind, *values in _NAMED.findall(attributes):
        kind, value = kind.lower(), next((v for v in values if v), "").lower()
        if kind == "itemprop":
            if value == "articlebody":
                found.add("articlebody")
            continue
        if kind == "role":
            found |= set(_WORD.findall(value)) & MAIN_MARKS
        if name in KEPT and name != "article":
            continue
        for token in value.split():
            words = _WORD.findall(token)
            marks = MARKS.intersection(words)
            # A token of nothing but marks ("cookie-notice") is sure as well; roles are a fixed vocabulary.
            sure = kind == "role" or len(marks) == len(set(words)) and (len(words) > 1 or marks <= (SURE_CLASS if kind == "class" else SURE))
            if name == "article":
                found |= {OTHER + m for m in marks if sure}
            else:
                found |= marks if sure else {WEAK + m for m in marks}
    return tuple(sorted(found))


def parse(page):
    """The tree of a page; texts are strings."""
    root = Node("")
    stack = [root]
    for token in _TOKENS.finditer(page or ""):
        text = token["text"]
        if text is not None:
            stack[-1].kids.append(text)
            continue
        if token["name"] is None:
            continue
        name = token["name"].lower()
        if token["end"]:
            if name == "p" and not any(n.name == "p" for n in stack):
                stack[-1].kids.append(Node("p"))
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if name not in BLOCKS and stack[depth].name in BLOCKS:
                    break
            continue
        if name in ENDS_P:
            _close(stack, {"p"}, {"td", "th", "li", "div", "section", "article", "main", "aside", "button", "table"})
        if name in ENDS:
            _close(stack, *ENDS[name])
        node = Node(name, _marks(token["attributes"], name) if token["attributes"] else (), name == "a" or stack[-1].link)
        stack[-1].kids.append(node)
        if name not in VOID and not token["attributes"].endswith("/"):
            stack.append(node)
    return root


def _close(stack, names, borders):
    while True:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                del stack[depth:]
                break
            if stack[depth].name in borders:
                return
        else:
            return


def skipped(name, marks, by_marks=True):
    return name in SKIPPED or by_marks and any(m in MARKS for m in marks) and "articlebody" not in marks


def weak(marks):
    return any(m[0] == WEAK for m in marks) and "articlebody" not in marks


def secondary(node):
    """An article element that its marks call a comment or the like; it goes where another article is."""
    return node.name == "article" and any(m[0] == OTHER for m in node.marks)


def mostly_links(node):
    """More than half of the text stands in links."""
    links = others = 0
    todo = [node]
    while todo:
        here = todo.pop()
        for kid in here.kids:
            if isinstance(kid, Node):
                todo.append(kid)
            elif here.link:
                links += len("".join(kid.split()))
            else:
                others += len("".join(kid.split()))
    return links > others


def label(node):
    """The name of an item: element and marks, so that boxes of different use are different items."""
    return node.name + "".join("." + m for m in node.marks)


def digest(text):
    """Length and digest of a text, to compare it whole."""
    return f"{len(text)}:{hashlib.blake2b(text.encode('utf-8', 'surrogatepass'), digest_size=8).hexdigest()}" if text else ""


# An item is [name, least, most (1 or 2: repeated), characters outside of links, digest of the whole text or None if it varies, items].
def expression(node, boxes=None):
    """The items of an element's content; ``boxes`` gets the label and digest of each plain box in it that has a text."""
    return _expression(node, set() if boxes is None else boxes)[0]


def _expression(node, boxes):
    items, whole = [], []
    for kid in node.kids:
        if isinstance(kid, str):
            text = " ".join(html.unescape(kid).split())
            if text:
                items.append(["#", 1, 1, 0 if node.link else len(text), digest(text), []])
        else:
            inner, text = _expression(kid, boxes)
            items.append([label(kid), 1, 1, sum(i[3] for i in inner), digest(text), inner])
            if text and (kid.name in BOXES or weak(kid.marks)):
                boxes.add((items[-1][0], items[-1][4]))
        if text:
            whole.append(text)
    return _folded(items), " ".join(whole)


def _folded(items):
    """Runs of one name become one repeated item."""
    out = []
    for item in items:
        if out and out[-1][0] == item[0]:
            last = out[-1]
            out[-1] = [item[0], min(1, last[1] + item[1]), 2, last[3] + item[3], last[4] if last[4] == item[4] else None, align(last[5], item[5])]
        else:
            out.append(item)
    return out


def merged(a, b):
    return [a[0], min(a[1], b[1]), max(a[2], b[2]), a[3] + b[3], a[4] if a[4] == b[4] else None, align(a[5], b[5])]


def _places(items):
    found = defaultdict(list)
    for n, item in enumerate(items):
        found[item[0]].append(n)
    return found


def _next(places, name, after):
    """How far ahead of ``after`` the name comes next, if it does."""
    listed = places.get(name, ())
    at = bisect_right(listed, after)
    return listed[at] - after if at < len(listed) else None


def align(a, b):
    """One expression for both lists of items."""
    if not a and not b:
        return []
    out, i, j, in_a_list, in_b_list = [], 0, 0, _places(a), _places(b)
    optional = lambda item: [item[0], 0, *item[2:]]
    while i < len(a) and j < len(b):
        if a[i][0] == b[j][0]:
            out.append(merged(a[i], b[j]))
            i, j = i + 1, j + 1
            continue
        in_a, in_b = _next(in_a_list, b[j][0], i), _next(in_b_list, a[i][0], j)
        if in_a is not None and (in_b is None or in_a <= in_b):
            out += map(optional, a[i : i + in_a])
            i += in_a
        elif in_b is not None:
            out += map(optional, b[j : j + in_b])
            j += in_b
        else:
            out += [optional(a[i]), optional(b[j])]
            i, j = i + 1, j + 1
    out += map(optional, a[i:] + b[j:])
    return _folded(out)


def wrapper_of(tree):
    """[least and greatest digest of the text of the region (to see if articles differ), items, plain boxes that are on every page] of one page."""
    boxes = set()
    items = expression(tree, boxes)
    words = digest("\n".join(blocks(tree, region(items))))
    return [words, words, items, sorted(map(list, boxes))]


def join_wrappers(a, b):
    both = {tuple(x) for x in a[3]} & {tuple(x) for x in b[3]}
    return [min(a[0], b[0]), max(a[1], b[1]), align(a[2], b[2]), sorted(map(list, both))]


def rules_of(wrapper):
    """(region, plain boxes that are no part of it) as JSON: all that the pages of the host need of its wrapper."""
    return json.dumps([region(wrapper[2], articles_differ(wrapper)), fixed_boxes(wrapper)])


def _parts(name):
    name, *marks = name.split(".")
    return name, tuple(marks)


def articles_differ(wrapper):
    """Whether what is the same on all pages of the wrapper can be told from what its articles say: not if all say the same, as those of
    a single page do."""
    return wrapper[0] != wrapper[1]


def region(items, known=False):
    """Names of the elements of the main text: "article", "main" or ("path", ...) to the element with all of the text; ``known``: what the items
    have as fixed is boilerplate."""
    found = set()

    def walk(level, by_marks):
        for item in level:
            name, marks = _parts(item[0])
            if skipped(name, marks, by_marks):
                continue
            if name == "article" or "articlebody" in marks:
                found.add("article")
            if name == "main" or "main" in marks:
                found.add("main")
            walk(item[5], by_marks)

    walk(items, True)
    if not found and not sum(map(_kept, items)):
        # All text is in elements with marks.
        walk(items, False)
    if found:
        return "article" if "article" in found else "main"
    path, level = [], items
    while True:
        usable = [i for i in level if not skipped(*_parts(i[0]))]
        best = max(usable, key=_kept, default=None)
        if best is None or best[0] == "#" or _parts(best[0])[0] not in BLOCKS or best[2] > 1:
            return ("path", *path)
        # Whatever stands beside the main text and is not known to be fixed belongs to it.
        if any(_kept(i) and not (known and i[1] == 1 and i[4]) for i in usable if i is not best):
            return ("path", *path)
        path.append(best[0])
        level = best[5]


def _kept(item):
    name, marks = _parts(item[0])
    if skipped(name, marks):
        return 0
    return item[3] if not item[5] else sum(_kept(i) for i in item[5])


def fixed_boxes(wrapper):
    """[label, digest of the text] of the plain boxes that say the same on all pages although the articles differ."""
    return wrapper[3] if articles_differ(wrapper) else []


def blocks(tree, where, fixed=frozenset(), by_marks=True):
    """The blocks of the main text of a page."""
    out, run = [], []

    def flush():
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    only = not by_marks or not _primary(tree)

    def dropped(node):
        if skipped(node.name, node.marks, by_marks) or not only and secondary(node):
            return True
        if by_marks and weak(node.marks) and mostly_links(node):
            return True
        return bool(fixed) and (node.name in BOXES or weak(node.marks)) and (label(node), _whole(node)) in fixed

    def emit(node):
        # An explicit stack, as pages may nest without end.
        todo = [(node, False)]
        while todo:
            here, ended = todo.pop()
            if isinstance(here, str):
                run.append(here)
            elif ended:
                flush()
            elif here is node or not dropped(here):
                if here.name in BLOCKS:
                    flush()
                    todo.append((here, True))
                elif here.name in ("br", "img", "input", "wbr"):
                    run.append(" " if here.name == "br" else "")
                todo += [(k, False) for k in reversed(here.kids)]

    for node in places(tree, where, dropped):
        flush()
        emit(node)
        flush()
    return out


def _primary(tree):
    """Whether the page has an article element that is not secondary."""
    todo = [tree]
    while todo:
        here = todo.pop()
        if here.name == "article" and not secondary(here):
            return True
        todo += [k for k in here.kids if isinstance(k, Node)]
    return False


def _whole(node):
    texts = []
    todo = [node]
    while todo:
        here = todo.pop()
        if isinstance(here, str):
            texts.append(" ".join(html.unescape(here).split()))
        else:
            todo += reversed(here.kids)
    return digest(" ".join(t for t in texts if t))


def places(tree, where, dropped):
    """The elements of the region on this page; without any, the whole page."""
    found = []
    if isinstance(where, str):
        todo = [tree]
        while todo:
            here = todo.pop()
            if isinstance(here, str) or dropped(here):
                continue
            if here.name == where or where == "article" and "articlebody" in here.marks or where == "main" and "main" in here.marks:
                found.append(here)
            else:
                todo += reversed(here.kids)
    elif where:
        level = tree
        for name in where[1:]:
            level = next((k for k in level.kids if isinstance(k, Node) and label(k) == name), None)
            if level is None:
                break
        found = [level] if level is not None else []
    return found or [tree]


def _infer(batches):
    part, wrappers = TaskContext.get().partitionId() % PARTS, {}

    def rows():
        names = list(wrappers)
        data = [pa.array(names, pa.string()), pa.array([part] * len(names), pa.int32()), pa.array([json.dumps(wrappers[n]) for n in names], pa.string())]
        return pa.RecordBatch.from_arrays(data, names=["host", "part", "wrapper"])

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            new = wrapper_of(_bounded(page))
            wrappers[host] = join_wrappers(wrappers[host], new) if host in wrappers else new
            if len(wrappers) > HOSTS_AT_ONCE:
                yield rows()
                wrappers.clear()
    yield rows()


def _bounded(page):
    """The tree of a page, flat below a depth at which recursion would end."""
    tree = parse(page)
    todo = [(tree, 0)]
    while todo:
        node, depth = todo.pop()
        kids = [k for k in node.kids if isinstance(k, Node)]
        if depth == 100:
            flat, rest = [], list(reversed(node.kids))
            while rest:
                here = rest.pop()
                if isinstance(here, str):
                    flat.append(here)
                else:
                    rest += reversed(here.kids)
            node.kids = flat
        else:
            todo += [(k, depth + 1) for k in kids]
    return tree


def _join(table):
    wrappers = [json.loads(w) for w in sorted(table.column("wrapper").to_pylist())]
    whole = wrappers[0]
    for other in wrappers[1:]:
        whole = join_wrappers(whole, other)
    first = table.slice(0, 1)
    return first.set_column(first.schema.get_field_index("wrapper"), "wrapper", pa.array([json.dumps(whole)], pa.string()))


def _rules(table):
    joined = _join(table)
    rules = rules_of(json.loads(joined.column("wrapper")[0].as_py()))
    return pa.Table.from_arrays([joined.column("host"), pa.array([rules])], names=["host", "rules"])


def _extract(batches):
    known = {}
    for batch in batches:
        texts = []
        for page, rules in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if rules not in known:
                if len(known) > 1000:
                    known.clear()
                where, fixed = json.loads(rules)
                known[rules] = where, {tuple(x) for x in fixed}
            where, fixed = known[rules]
            tree = parse(page)
            # A page whose whole text is in elements with marks keeps it.
            texts.append("\n".join(blocks(tree, where, fixed) or blocks(tree, where, by_marks=False)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def merged_wrappers(pages):
    """(host, part, wrapper as JSON): a few per host."""
    rows = pages.select(host_of(F.col("url")).alias("host"), "html")
    parts = rows.mapInArrow(_infer, "host string, part int, wrapper string")
    return parts.groupBy("host", "part").applyInArrow(_join, "host string, part int, wrapper string")


def wrappers_of(pages):
    """(host, wrapper) with the wrapper as JSON, stored."""
    whole = merged_wrappers(pages).groupBy("host").applyInArrow(_join, "host string, part int, wrapper string")
    return stored(whole.select("host", "wrapper"), "wrappers")


def main_texts(pages):
    """page_id, url and main text of every page."""
    pages = pages.select("page_id", "url", "html")
    rules = stored(merged_wrappers(pages).groupBy("host").applyInArrow(_rules, "host string, rules string"), "rules")
    placed = pages.withColumn("host", host_of(F.col("url"))).join(rules, "host").select("page_id", "url", "html", "rules")
    schema = pages.select("page_id", "url", F.lit("").alias("text")).schema
    return placed.mapInArrow(_extract, schema)
