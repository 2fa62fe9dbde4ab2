"""HTML extraction by wrappers: union-free regular expressions inferred from
the token streams of the pages of one host.

A page's stream of tags and texts is read as nested sibling lists. Aligning
two lists matches equal tokens in order; a token that only one side has
becomes optional, one that comes again becomes a repeated group, and texts
that differ become a text slot. Each task folds its pages into one wrapper per
host, and Spark folds those of all tasks, so a host of any size is inferred
from all its pages while only wrappers travel.

Wrappers carry sums (pages, characters, link characters, least and greatest
text hash) per token. On how many of the host's differing pages a constant
slot stands is counted by Spark from a short row a page (the page's digest and
the ids of its slots), over all pages. They decide, per host, which part of the wrapper is the
article: the part with most running text, less what is marked as boilerplate
by its tag, its class or role, by links, or, outside of an article, by one
constant text on nearly all of the host's differing pages.
Every page is then read through its host's wrapper.

Defined cases: a null or empty html has an empty text; a null url or one
without host belongs to a host of its own, the empty name; repeated rows are
read one by one; broken markup closes open elements as browsers do; extra
columns are ignored."""

from __future__ import annotations

import functools
import hashlib
import html as references
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ids

#: hosts a task holds before it hands their wrappers on
HELD_HOSTS = 2_000

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mtable mtr mtd semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: void elements that end a line of text; the others stand in it
BREAKS = frozenset("br hr".split())
RAW = frozenset("annotation annotation-xml script style noscript template svg iframe object textarea title".split())
#: an opening tag that ends an open paragraph
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: an opening tag that ends an open sibling of these names
ENDS_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
#: an element that such an implied end never reaches through
FENCES = frozenset("#root html body article section div table ul ol dl select main aside nav header footer form".split())

#: tags, class words and roles that are never part of an article
CHROME_TAGS = frozenset("aside button dialog footer form head header input menu nav option select".split())
CHROME_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert disclaimer "
    "sidebar sidenav aside menu nav navbar navigation topbar breadcrumb breadcrumbs share sharing social related recommended recommendations "
    "comment comments reply replies respond discussion disqus footer header masthead newsletter subscribe subscription signup login popup modal overlay "
    "widget toolbar pager pagination skip".split())
CHROME_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search status toolbar".split())
#: class words that tell parts of a layout apart; others are ignored, so the
#: tokens of a wrapper come from a fixed alphabet however pages name things
LAYOUT_WORDS = CHROME_WORDS | frozenset("article body byline caption card center column container content entry hero image left list lead main meta page post right row section story summary teaser text title top wrap wrapper".split())
#: elements nested deeper are read as parts of the last one at this depth
MAX_DEPTH = 150
#: allowed inside an article
ARTICLE_PARTS = frozenset(["header"])
#: never left out for a class word
WHOLE_TAGS = frozenset("#root html body main article".split())
HEADINGS = frozenset(["h1", "h2"])
#: lines of an article, which a class word styles but does not take out of it
LINES = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr caption figcaption".split())
ALL_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody tr td th figure".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {name: re.compile("</" + name, re.I | re.A) for name in RAW}
_NAME_PART = re.compile(r"[A-Za-z]+")


class Node:
    """An element of one page; ``kids`` are nodes and texts in order."""

    __slots__ = ("name", "words", "role", "kids", "key")

    def __init__(self, name: str, words: tuple = (), role: str = ""):
        self.name, self.words, self.role, self.kids, self.key = name, words, role, [], ""


class Text:
    """A run of text between two block boundaries."""

    __slots__ = ("pieces", "linked")
    key = "#text"

    def __init__(self):
        self.pieces, self.linked = [], 0

    def value(self) -> str:
        return " ".join(references.unescape("".join(self.pieces)).split())


def _attributes(raw: str) -> tuple[tuple, str]:
    if not raw or raw.isspace():
        return (), ""
    words, role = [], ""
    for m in _ATTR.finditer(raw):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role":
            role = value.strip().lower()
        elif name in ("hidden", "aria-hidden"):
            if name == "hidden" or value.lower() == "true":
                role = role or "hidden"
        else:
            words += [w.lower() for w in _NAME_PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value))]
    return tuple(w for w in dict.fromkeys(words) if w in LAYOUT_WORDS), role


def parse(page: str) -> Node:
    """The page as nested sibling lists."""
    root = Node("#root")
    stack, text, links, at = [root], None, 0, 0
    deep: list[str] = []        # open elements beyond MAX_DEPTH

    def add(piece: str) -> None:
        nonlocal text
        if text is None:
            if piece.isspace():
                return
            text = Text()
            stack[-1].kids.append(text)
        text.pieces.append(piece)
        if links:
            text.linked += len(piece)

    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.search(page, pos)
        if m is None:
            add(page[pos:])
            break
        if m.start() > pos:
            add(page[pos:m.start()])
        pos = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:-3])
            continue
        name, closing = name.lower(), bool(m[1] or m[4])
        if name in INLINE:
            if name == "a":
                links = max(0, links - 1) if closing else links + 1
            continue
        if not closing and name in VOID and name not in BREAKS:
            continue
        if not closing and name in RAW:                  # its content is no text, and ends none
            stop = _RAW_END[name].search(page, pos)
            pos = stop.start() if stop else end
            continue
        if closing and name in RAW:
            continue
        text = None
        if closing:
            if deep:
                if name in deep:
                    del deep[len(deep) - 1 - deep[::-1].index(name):]
                    continue
                deep = []
            at = len(stack) - 1
            while at and stack[at].name != name:
                if name == "p" and stack[at].name in FENCES:
                    at = 0
                    break
                at -= 1
            if at:
                del stack[at:]
                links = 0
            continue
        if name in BREAKS:
            continue
        if name in ENDS_P:
            at = len(stack) - 1
            while at and stack[at].name not in FENCES and stack[at].name != "p":
                at -= 1
            if stack[at].name == "p":
                del stack[at:]
                links = 0
        elif name in ENDS_SIBLING:
            ends, at, cut = ENDS_SIBLING[name], len(stack) - 1, 0
            while at and (stack[at].name not in FENCES):
                if stack[at].name in ends:
                    cut = at
                at -= 1
            if cut:
                del stack[cut:]
        raw = m[3] if m[2] else m[6]
        if len(stack) > MAX_DEPTH:
            if not raw.rstrip().endswith("/"):
                deep.append(name)
            continue
        node = Node(name, *_attributes(raw))
        stack[-1].kids.append(node)
        if not raw.rstrip().endswith("/"):
            stack.append(node)
    _name_keys(root)
    return root


def _name_keys(root: Node) -> None:
    """Names every element for alignment: tag, class words and role; plain
    containers also by the tags they hold."""
    todo = [root]
    while todo:
        node = todo.pop()
        node.key = node.name + "".join(f".{w}" for w in node.words) + (f"@{node.role}" if node.role else "")
        if not node.words and node.name in ("div", "section", "td", "table", "ul", "ol"):
            held = {k.name if isinstance(k, Node) else "#text" for k in node.kids}
            node.key += "[" + ",".join(sorted(held)) + "]"
        todo += [k for k in node.kids if isinstance(k, Node)]


def chrome(name: str, words, role: str, inside: bool, most: bool = False) -> bool:
    """Whether markup alone says that an element is no article text. Class
    words and forms say nothing about an element that makes up a page or holds
    most of its text (``most``): they tell how the page is laid out."""
    if inside and name in ARTICLE_PARTS:
        return False
    if role in CHROME_ROLES or role == "hidden" or (name in CHROME_TAGS and not (most and name == "form")):
        return True
    if most or name in WHOLE_TAGS:
        return False
    if inside and name in LINES:
        return False
    marked = CHROME_WORDS.intersection(words)
    return bool(marked - {"header"} if inside else marked)


# --------------------------------------------------------------------------
# Wrappers
# --------------------------------------------------------------------------

class Wrapper:
    """A token of the expression with its sums over pages."""

    __slots__ = ("key", "optional", "repeated", "pages", "chars", "linked", "lo", "hi", "most", "seen", "kids")

    def __init__(self, key: str):
        self.key, self.optional, self.repeated = key, False, False
        self.pages = self.chars = self.linked = self.hi = 0
        self.most = 0       # pages of which it holds more than half of the text outside links
        self.seen: list[str] = []       # digests of the differing pages it stands on: of the root and of constant slots (none where Spark counts them)
        self.lo, self.kids = 1 << 40, {}

    def pack(self) -> list:
        return [self.key, int(self.optional), int(self.repeated), self.pages, self.chars, self.linked, self.lo, self.hi, self.most, self.seen, [k.pack() for k in self.kids.values()]]

    @classmethod
    def unpack(cls, v: list) -> Wrapper:
        w = cls(v[0])
        w.optional, w.repeated, w.pages, w.chars, w.linked, w.lo, w.hi, w.most, w.seen = bool(v[1]), bool(v[2]), *v[3:10]
        w.kids = {k.key: k for k in map(cls.unpack, v[10])}
        return w

    def apart(self) -> bool:
        """Whether its pages are told apart."""
        return self.key == "#root" or (self.key == "#text" and not self.repeated and self.lo == self.hi)

    def unlinked(self) -> int:
        return self.chars - self.linked + sum(k.unlinked() for k in self.kids.values())

    def expression(self) -> str:
        """The union-free regular expression in a readable form."""
        if self.key == "#text":
            body = "#TEXT" if self.lo != self.hi else "#CONSTANT"
        else:
            body = f"<{self.key}>" + "".join(k.expression() for k in self.kids.values()) + "</>"
        return f"({body})" + ("+" if self.repeated else "") + ("?" if self.optional else "") if self.optional or self.repeated else body


@functools.lru_cache(1 << 16)
def slot_id(path: tuple[str, ...]) -> int:
    """Names a token of a host's wrapper by its path; () is the root."""
    return int.from_bytes(hashlib.blake2b("\n".join(path).encode(), digest_size=8).digest(), "little", signed=True)


def apart_slots(root: Wrapper) -> Iterator[tuple[int, Wrapper]]:
    """The tokens whose pages are told apart, with their ids."""
    todo: list[tuple[Wrapper, tuple[str, ...]]] = [(root, ())]
    while todo:
        w, path = todo.pop()
        if w.apart():
            yield slot_id(path), w
        todo += [(k, (*path, k.key)) for k in w.kids.values()]


def page_wrapper(page: Node) -> Wrapper:
    """The wrapper of a single page: siblings of one key fold into a
    repeated group."""
    texts = hashlib.blake2b(digest_size=16)     # of all texts of the page

    def fold(nodes: list[Node], into: Wrapper) -> None:
        for node in nodes:
            met: dict[str, list] = {}
            for kid in node.kids:
                met.setdefault(kid.key, []).append(kid)
            for key, kids in met.items():
                w = into.kids.get(key)
                if w is None:
                    w = into.kids[key] = Wrapper(key)
                w.pages = 1
                w.repeated |= len(kids) > 1 or len(nodes) > 1
                if key == "#text":
                    for t in kids:
                        value = t.value()
                        raw = value.encode("utf-8", "surrogatepass")
                        code = zlib.crc32(raw)
                        texts.update(raw + b"\n")
                        w.chars += len(value)
                        w.linked += min(t.linked, len(value))
                        w.lo, w.hi = min(w.lo, code), max(w.hi, code)
                else:
                    fold(kids, w)

    out = Wrapper("#root")
    out.pages = 1
    fold([page], out)
    for _, w in apart_slots(out):
        w.seen = [texts.hexdigest()]
    whole = out.unlinked()
    todo = [out]
    while todo:     # no part of an element without most of the text has most of it
        w = todo.pop()
        if 2 * w.unlinked() > whole:
            w.most = 1
            todo += w.kids.values()
    return out


def align(a: Wrapper, b: Wrapper) -> Wrapper:
    """Generalise ``a`` to the pages of ``b`` too. Tokens are matched in
    order of ``a``; those of ``b`` alone are placed after the token they
    follow there."""
    a.optional |= b.optional
    a.repeated |= b.repeated
    a.pages += b.pages
    a.chars += b.chars
    a.linked += b.linked
    a.most += b.most
    a.lo, a.hi = min(a.lo, b.lo), max(a.hi, b.hi)
    if not a.apart():
        a.seen = []
    elif a.seen != b.seen:
        a.seen = sorted({*a.seen, *b.seen})
    if a.kids.keys() == b.kids.keys():
        for key, kid in b.kids.items():
            align(a.kids[key], kid)
        return a
    behind: dict[str, list[str]] = {}
    last = ""
    for key, kid in b.kids.items():
        if key in a.kids:
            align(a.kids[key], kid)
        else:
            kid.optional = True
            behind.setdefault(last, []).append(key)
            continue
        last = key
    for key, kid in a.kids.items():
        kid.optional |= key not in b.kids
    if behind:
        merged = {k: b.kids[k] for k in behind.get("", ())}
        for key, kid in a.kids.items():
            merged[key] = kid
            merged.update((k, b.kids[k]) for k in behind.get(key, ()))
        a.kids = merged
    return a


def _parts(key: str) -> tuple[str, list[str], str]:
    head, _, role = key.partition("[")[0].partition("@")
    name, *words = head.split(".")
    return name, words, role


def article_paths(root: Wrapper, apart: dict[int, int] | None = None) -> tuple[tuple[str, ...], set[tuple[str, ...]]]:
    """(path of the article, paths left out of it) in a wrapper. ``apart``:
    number of differing pages by slot id; without it the wrapper's own lists
    of pages are counted."""
    left_out: set[tuple[str, ...]] = set()
    constants: set[tuple[str, ...]] = set()
    if apart is None:
        apart = {slot: len(w.seen) for slot, w in apart_slots(root)}
    differing = apart.get(slot_id(()), 0)
    weight: dict[tuple[str, ...], int] = {}
    named: list[tuple[str, ...]] = []

    def totals(w: Wrapper) -> tuple[int, int]:
        got = [(w.chars, w.linked), *(totals(k) for k in w.kids.values())]
        return sum(x[0] for x in got), sum(x[1] for x in got)

    def weigh(w: Wrapper, path: tuple[str, ...], inside: bool) -> int:
        if w.key == "#text":
            heading = len(path) > 1 and _parts(path[-2])[0] in ALL_HEADINGS
            # copies of a page count once
            constant = not inside and not heading and w.apart() and differing >= 3 and 10 * apart.get(slot_id(path), 0) >= 9 * differing
            if constant:
                constants.add(path)
            weight[path] = 0 if constant else w.chars - w.linked
            return weight[path]
        name, words, role = _parts(w.key)
        chars, linked = totals(w)
        most = 2 * w.most > w.pages and not any(p[:len(path)] != path for p in texts)
        if path and (chrome(name, words, role, inside, most) or (2 * linked > chars and name not in LEAVES)):
            left_out.add(path)
            return 0
        if name in ("article", "main") or role == "main":
            named.append(path)
            inside = True
        weight[path] = sum(weigh(k, (*path, k.key), inside) for k in w.kids.values())
        return weight[path]

    # where an article or main element tells the text, a part beside it stays marked by its class however long it is
    texts: list[tuple[str, ...]] = []

    def find(w: Wrapper, path: tuple[str, ...]) -> None:
        name, words, role = _parts(w.key)
        if path and chrome(name, words, role, False, 2 * w.most > w.pages):
            return
        if name in ("article", "main") and w.unlinked():
            texts.append(path)
            return
        for k in w.kids.values():
            find(k, (*path, k.key))

    find(root, ())
    whole = weigh(root, (), False)
    heavy = [p for p in named if 2 * weight[p] >= whole > 0]
    if heavy:
        return max(heavy, key=len), left_out
    at, path = root, ()
    while True:
        kids = [k for k in at.kids.values() if (*path, k.key) not in left_out and k.key != "#text"]
        if any(_parts(k.key)[0] in HEADINGS for k in kids):
            break
        best = max(kids, key=lambda k: weight.get((*path, k.key), 0), default=None)
        if best is None or _parts(best.key)[0] in LEAVES or 10 * weight.get((*path, best.key), 0) < 7 * weight.get(path, 0):
            break
        at, path = best, (*path, best.key)
    if not path or _parts(path[-1])[0] in WHOLE_TAGS:       # no part was chosen: the page is the article and its boilerplate
        left_out |= constants
    return path, left_out


def read_page(page: Node, article: tuple[str, ...], left_out: set[tuple[str, ...]]) -> list[str]:
    """Text blocks of a page that its wrapper says belong to the article."""
    blocks: list[str] = []

    def walk(node: Node, path: tuple[str, ...]) -> None:
        for kid in node.kids:
            here = (*path, kid.key)
            if here in left_out:
                continue
            if isinstance(kid, Text):
                if path[:len(article)] == article and (value := kid.value()):
                    blocks.append(value)
            elif here[:len(article)] == article[:len(here)]:
                walk(kid, here)

    walk(page, ())
    return blocks


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------

def host_of(url: str | Column = "url") -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


_FOLDED = "host string, wrapper string, page binary, slots array<long>"
_WRAPPED = "host string, wrapper string, constant array<long>"


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a page: its digest and the slots it has; and the wrappers of
    the task's hosts, which hold no list of pages."""
    held: dict[str, Wrapper] = {}

    def rows(hosts: list, packed: list, pages: list, slots: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(packed, pa.string()), pa.array(pages, pa.binary()), pa.array(slots, pa.list_(pa.int64()))],
                                          ["host", "wrapper", "page", "slots"])

    def out() -> pa.RecordBatch:
        return rows(list(held), [json.dumps(w.pack()) for w in held.values()], [None] * len(held), [None] * len(held))

    for batch in batches:
        hosts, pages, slots = [], [], []
        for host, page in zip(ids(batch, "host"), ids(batch, "html")):
            host, one = host.as_py(), page_wrapper(parse(page.as_py() or ""))
            hosts.append(host)
            pages.append(bytes.fromhex(one.seen[0]))
            found = list(apart_slots(one))
            slots.append([slot for slot, _ in found])
            for _, w in found:
                w.seen = []
            held[host] = align(held[host], one) if host in held else one
            if len(held) > HELD_HOSTS:
                yield out()
                held = {}
        yield rows(hosts, [None] * len(hosts), pages, slots)
    if held:
        yield out()


def _fold_wrappers(part: pa.Table) -> pa.Table:
    """One wrapper of those of a host, smaller ones aligned to larger."""
    got = sorted(part.column("wrapper").to_pylist(), key=lambda w: (-len(w), w))
    whole = Wrapper.unpack(json.loads(got[0]))
    for w in got[1:]:
        whole = align(whole, Wrapper.unpack(json.loads(w)))
    return pa.table([pa.array([part.column("host")[0].as_py()], pa.string()), pa.array([json.dumps(whole.pack())], pa.string()),
                     pa.array([[slot for slot, _ in apart_slots(whole)]], pa.list_(pa.int64()))], ["host", "wrapper", "constant"])


def infer(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, wrapper, apart) from all pages (url, html); ``apart``: on how
    many differing pages each constant slot stands."""
    folded = scratch.write(pages.select(host_of().alias("host"), "html").mapInArrow(_fold_pages, _FOLDED), "folded")
    some = folded.where("wrapper IS NOT NULL").select("host", "wrapper", F.pmod(F.spark_partition_id(), F.lit(64)).alias("part"))
    some = some.groupBy("host", "part").applyInArrow(_fold_wrappers, _WRAPPED)
    wrappers = scratch.write(some.select("host", "wrapper").groupBy("host").applyInArrow(_fold_wrappers, _WRAPPED), "whole")
    met = folded.where("page IS NOT NULL").select("host", "page", "slots").join(wrappers.select("host", "constant"), "host")
    # pages of the same texts are one page, which has the slots that any of them has
    each = met.groupBy("host", "page").agg(F.collect_set(F.array_sort(F.array_intersect("slots", "constant"))).alias("slots"))
    each = each.select("host", F.explode(F.array_distinct(F.flatten("slots"))).alias("slot"))
    apart = each.groupBy("host", "slot").agg(F.count(F.lit(1)).alias("n")).groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("apart"))
    return wrappers.join(apart, "host").select("host", "wrapper", "apart")


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple] = {}
    for batch in batches:
        texts = []
        for host, wrapper, apart, page in zip(*[ids(batch, c) for c in ("host", "wrapper", "apart", "html")]):
            host = host.as_py()
            if host not in known:
                if len(known) > HELD_HOSTS:
                    known = {}
                known[host] = article_paths(Wrapper.unpack(json.loads(wrapper.as_py())), dict(apart.as_py()))
            tree = parse(page.as_py() or "")
            blocks = read_page(tree, *known[host])
            if not blocks:      # a page unlike its host's others is its own wrapper
                blocks = read_page(tree, *article_paths(page_wrapper(tree)))
            texts.append("\n".join(blocks))
        yield pa.RecordBatch.from_arrays([ids(batch, "page_id"), ids(batch, "url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and article text of every page."""
    kinds = dict(pages.dtypes)
    scratch = Scratch(pages.sparkSession, "wrappers")
    wrappers = scratch.write(infer(pages, scratch), "wrappers")
    met = pages.select("page_id", "url", "html", host_of().alias("host")).join(wrappers, "host")
    return met.mapInArrow(_read_pages, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
