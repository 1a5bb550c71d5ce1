"""Main text of web pages by wrapper induction.

Pages of one host come from one or several layouts.  A page's layout is the set of its
structural elements (tag and class).  Each layout of enough distinct pages has a reference page of
typical length; pages of rarer layouts go with the host's most frequent layout.  The
reference is aligned with every page of its layout by simple tree matching (STM); each aligned pair of
nodes tells whether the two texts agree.  Over all these pages, a node
of the reference whose text is the same on nearly all distinct pages is template;
other nodes are slots that hold content.

The content region of a page is its article (``article``, else ``main``, else
the body); inside it elements whose tag, role, class or id says menu,
header, footer, sidebar, notice, advert, form, script, style or comment
are left out, and so are blocks that the alignment showed to be template.

Evidence is summed over all pages with partial aggregation, so a host may hold any share
of the pages; the reference pages join by host and layout, sent to all tasks only if
their measured size is small.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.common import read_table, shared_table, small_side, text_or_empty

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "script style noscript template iframe object embed svg canvas math head title nav header footer aside "
    "form button select option textarea input label fieldset menu dialog audio video map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("br option optgroup body html caption tbody td tfoot th thead tr legend".split())
#: start tags that end an open element of these names, up to the given scope
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split()
)
#: words of class and id names that mark an element as no part of the article
FOREIGN_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion "
    "comment comments respond disqus discussion replies related recommended recommendations "
    "notice notices cookie cookies consent gdpr popup modal alert newsletter".split()
)
#: words that do so too, but may also name a layout that holds the article
LAYOUT_NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer bottom "
    "sidebar aside widget widgets banner overlay subscribe subscription signup login share sharing social "
    "pagination pager toolbar skip form search".split()
)
#: how an element is left out: by a layout name, or for certain
BY_LAYOUT, FOR_CERTAIN = 1, 2

#: tables of two child lists up to so many cells are kept whole, larger ones halved
TABLE_CELLS = 1 << 18
#: references a task keeps parsed, and scores of pairs of shapes each keeps from page to page
KEPT_REFERENCES, KEPT_SCORES = 64, 1 << 14
#: elements whose tags and classes make a layout
LAYOUT_TAG = r"<(?:body|main|article|section|header|nav|aside|footer|div)\b[^<>]*"
#: share of a layout's distinct pages on which a template text is the same, and least pages
TEMPLATE_SHARE, LEAST_PAGES = 0.9, 12
#: reference pages are sent to all tasks up to so many bytes
BROADCAST_BYTES = 8_000_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)",
    re.S,
)
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[a-z0-9]+")


class Node:
    """An element: tag, label (tag and class), children (nodes and strings)."""

    __slots__ = ("dropped", "kids", "label", "role", "tag", "up")

    def __init__(self, tag, label, role, dropped, up):
        self.tag, self.label, self.role, self.dropped, self.up = tag, label, role, dropped, up
        self.kids = []


def _element(tag: str, attrs: str, up: Node) -> Node:
    label, role, dropped = tag, "", FOR_CERTAIN if tag in DROPPED else 0
    if attrs and "=" in attrs:
        for m in ATTR.finditer(attrs):
            key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower()
            if key == "role":
                role = value
                if value in DROPPED_ROLES:
                    dropped = FOR_CERTAIN
                continue
            if key == "class":
                label = f"{tag}.{value}"
            if tag in ("html", "body", "main"):
                continue
            names = NAME.findall(value)
            if not FOREIGN_NAMES.isdisjoint(names):
                dropped = FOR_CERTAIN
            elif tag != "article" and not LAYOUT_NAMES.isdisjoint(names):
                dropped = max(dropped, BY_LAYOUT)
    return Node(tag, label, role, dropped, up)


def parse(page: str) -> Node:
    """A DOM-like tree; unclosed and misnested tags are repaired as browsers do.

    Text is kept with its character references decoded; a tag cut off at the
    end of the page is dropped."""
    root = Node("#root", "#root", "", False, None)
    at, here, n = 0, root, len(page)
    opened: dict[str, int] = {}
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            here.kids.append(html.unescape(page[at:]))
            break
        m = TOKEN.match(page, lt)
        if m is None:
            nxt = page.find("<", lt + 1)
            nxt = n if nxt < 0 else nxt
            here.kids.append(html.unescape(page[at:nxt]))
            at = nxt
            continue
        if lt > at:
            here.kids.append(html.unescape(page[at:lt]))
        at = m.end()
        slash, name, attrs, end = (m[1], m[2], m[3], m[4]) if m[2] else (m[5], m[6], m[7], m[8])
        if not name:
            continue
        if end != ">":
            break
        tag = name.lower()
        if slash:
            if not opened.get(tag):
                continue
            up = here
            while up is not root and up.tag != tag:
                if up.tag in ("article", "main", "body") and tag not in ("html", "body", "article", "main"):
                    break
                up = up.up
            if up is not root and up.tag == tag:
                while here is not up.up:
                    opened[here.tag] -= 1
                    here = here.up
            continue
        if tag in CLOSES_P and opened.get("p"):
            up = here
            while up is not root and up.tag != "p":
                up = up.up
            while here is not up.up and here is not root:
                opened[here.tag] -= 1
                here = here.up
        if tag in IMPLIED and any(opened.get(t) for t in IMPLIED[tag][0]):
            ends, scope = IMPLIED[tag]
            up, found = here, None
            while up is not root and up.tag not in scope:
                if up.tag in ends:
                    found = up
                up = up.up
            if found is not None:
                while here is not found.up:
                    opened[here.tag] -= 1
                    here = here.up
        node = _element(tag, attrs, here)
        here.kids.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            if close is None:
                if tag in ("textarea", "title"):
                    node.kids.append(html.unescape(page[at:]))
                break
            gt = page.find(">", close.end())
            at = n if gt < 0 else gt + 1
            continue
        if tag in VOID or (attrs or "").endswith("/"):
            continue
        here = node
        opened[tag] = opened.get(tag, 0) + 1
    return root


def regions(root: Node) -> list[Node]:
    """The article elements; else ``main``; else articles inside an element that
    only has a layout's name; else the whole page."""
    article = lambda x: x.tag == "article"
    main = lambda x: x.tag == "main" or x.role == "main"
    for want, least in ((article, BY_LAYOUT), (main, BY_LAYOUT), (article, FOR_CERTAIN), (main, FOR_CERTAIN)):
        found, stack = [], [root]
        while stack:
            x = stack.pop()
            if x.dropped >= least:
                continue
            if want(x):
                found.append(x)
                continue
            stack.extend(k for k in reversed(x.kids) if not isinstance(k, str))
        if found:
            return found
    return [root]


def blocks(root: Node) -> list[tuple[str, str]]:
    """(label, text) of each block of the content region, in page order."""
    out: list[tuple[str, str]] = []
    held: list[str] = []

    def end(label):
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append((label, text))

    def walk(region):
        stack = [(iter(region.kids), region.label, False)]
        while stack:
            kids, label, block = stack[-1]
            for k in kids:
                if isinstance(k, str):
                    held.append(k)
                elif not k.dropped:
                    if k.tag in BLOCKS:
                        end(label)
                        stack.append((iter(k.kids), k.label, True))
                    else:
                        stack.append((iter(k.kids), label, False))
                    break
            else:
                stack.pop()
                if block:
                    end(label)

    for r in regions(root):
        walk(r)
        end(r.label)
    return out


# ------------------------------------------------------- simple tree matching


def _children(x: Node) -> list[Node]:
    """Element children; neighbours of one label form runs when aligned."""
    return [k for k in x.kids if not isinstance(k, str) and k.tag not in RAW]


def _runs(kids: list[Node]) -> list[list[Node]]:
    out: list[list[Node]] = []
    for k in kids:
        if out and out[-1][0].label == k.label:
            out[-1].append(k)
        else:
            out.append([k])
    return out


class Shapes:
    """Trees up to their texts: equal shapes have one number, so the score of
    two shapes is computed once however often they occur."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.labels: list[str] = []
        self.runs: list[tuple[tuple[int, ...], ...]] = []
        self.sizes: list[int] = []
        self.scores: dict[tuple[int, int], int] = {}

    def of(self, tree: Node) -> dict[int, int]:
        """Shape of every node under ``tree``, by ``id``."""
        order = [(tree, _children(tree))]
        for _, kids in order:
            order.extend((k, _children(k)) for k in kids)
        out: dict[int, int] = {}
        for x, kids in reversed(order):  # children before their parents
            key = (x.label, tuple(tuple([out[id(k)] for k in run]) for run in _runs(kids)) if kids else ())
            number = self.numbers.get(key)
            if number is None:
                number = self.numbers[key] = len(self.labels)
                self.labels.append(x.label)
                self.runs.append(key[1])
                self.sizes.append(1 + sum(self.sizes[k] for run in key[1] for k in run))
            out[id(x)] = number
        return out

    def _weight(self, r, s) -> int:
        """Matched nodes of two runs, paired from the left."""
        if self.labels[r[0]] != self.labels[s[0]]:
            return 0
        return sum([self.sizes[x] if x == y else self.scores[x, y] for x, y in zip(r, s, strict=False)])

    def _open(self, p, q) -> list[tuple[int, int]]:
        """Pairs of shapes whose scores two lists of runs need and lack."""
        by_label: dict[str, list] = {}
        for s in set(q):
            by_label.setdefault(self.labels[s[0]], []).append(s)
        return [
            pair for r in set(p) for s in by_label.get(self.labels[r[0]], ())
            for pair in zip(r, s, strict=False) if pair[0] != pair[1] and pair not in self.scores
        ]

    def fill(self, p, q) -> None:
        """Scores of all pairs of two lists of runs, children first."""
        stack = self._open(p, q)
        while stack:
            x, y = stack[-1]
            if (x, y) in self.scores:
                stack.pop()
                continue
            u, v = self.runs[x], self.runs[y]
            i, j, k = equal_ends(u, v)
            mid_u, mid_v = u[i:j], v[i:k]
            more = self._open(mid_u, mid_v) if mid_u and mid_v else []
            if more:
                stack.extend(more)
                continue
            same = sum([self.sizes[m] for run in u[:i] + u[j:] for m in run])
            self.scores[x, y] = 1 + same + Chain(self, mid_u, mid_v).best()
            stack.pop()


def equal_ends(p, q) -> tuple[int, int, int]:
    """``(i, j, k)``: ``p[:i] == q[:i]`` and ``p[j:] == q[k:]``, as long as can be.

    Equal runs at both ends match each other in a best alignment: no other
    partner gives either more."""
    least, i = min(len(p), len(q)), 0
    while i < least and p[i] == q[i]:
        i += 1
    e = 0
    while e < least - i and p[-1 - e] == q[-1 - e]:
        e += 1
    return i, len(p) - e, len(q) - e


class Chain:
    """Best alignment in order of two lists of runs; scores are there."""

    def __init__(self, shapes: Shapes, p, q):
        self.shapes, self.p = shapes, p
        self.kinds: dict[tuple, int] = {}
        self.codes = np.array([self.kinds.setdefault(s, len(self.kinds)) for s in q], np.int64)
        self.rows: dict[tuple, np.ndarray] = {}

    def best(self) -> int:
        """Score of the best alignment."""
        m, n = len(self.p), len(self.codes)
        if m == 0 or n == 0:
            return 0
        return int(self.last(0, m, 0, n)[-1])

    def weights(self, i: int) -> np.ndarray:
        r = self.p[i]
        if r not in self.rows:
            if len(self.rows) * len(self.kinds) > TABLE_CELLS:
                self.rows.clear()
            self.rows[r] = np.array([self.shapes._weight(r, s) for s in self.kinds], np.int64)
        return self.rows[r][self.codes]

    def last(self, i0: int, i1: int, j0: int, j1: int, back: bool = False) -> np.ndarray:
        """Best scores of ``p[i0:i1]`` with each prefix (``back``: suffix) of ``q[j0:j1]``."""
        row = np.zeros(j1 - j0 + 1, np.int64)
        for i in reversed(range(i0, i1)) if back else range(i0, i1):
            w = self.weights(i)[j0:j1]
            row = self._next(row, w[::-1] if back else w)
        return row[::-1] if back else row

    @staticmethod
    def _next(row, w):
        out = np.zeros_like(row)
        np.maximum.accumulate(np.maximum(row[1:], row[:-1] + w), out=out[1:])
        return out

    def path(self) -> list[tuple[int, int]]:
        """Aligned positions; a table too large to keep is split where the best
        alignment crosses its middle row, so memory stays linear."""
        out, stack = [], [(0, len(self.p), 0, len(self.codes))]
        while stack:
            i0, i1, j0, j1 = stack.pop()
            if i0 == i1 or j0 == j1:
                continue
            if i1 - i0 > 1 and (i1 - i0) * (j1 - j0) > TABLE_CELLS:
                mid = (i0 + i1) // 2
                cut = j0 + int(np.argmax(self.last(i0, mid, j0, j1) + self.last(mid, i1, j0, j1, back=True)))
                stack += [(i0, mid, j0, cut), (mid, i1, cut, j1)]
                continue
            table = [np.zeros(j1 - j0 + 1, np.int64)]
            for i in range(i0, i1):
                table.append(self._next(table[-1], self.weights(i)[j0:j1]))
            i, j = i1 - i0, j1 - j0
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((i0 + i, j0 + j))
        return out


def align(a: Node, b: Node, shapes: Shapes | None = None, known: dict[int, int] | None = None) -> list[tuple[Node, Node]]:
    """Pairs of nodes matched by simple tree matching.

    Roots must have one label.  Children are aligned in order by dynamic
    programming that maximises the number of matched nodes, over lists of any length; neighbours of one
    label are one run whose members pair up from the left, which keeps
    repeated records together.  ``shapes`` may hold the scores of earlier calls, ``known``
    the shapes in it of the nodes under ``a``."""
    shapes = shapes or Shapes()
    left = known or shapes.of(a)
    right = shapes.of(b)
    out: list[tuple[Node, Node]] = []
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if x.label != y.label:
            continue
        out.append((x, y))
        sx, sy = left[id(x)], right[id(y)]
        p, q = shapes.runs[sx], shapes.runs[sy]
        if not p or not q:
            continue
        u, v = _runs(_children(x)), _runs(_children(y))
        if sx == sy:  # the same shape: every node matches
            for r, s in zip(u, v, strict=True):
                stack.extend(zip(r, s, strict=True))
            continue
        i, j, k = equal_ends(p, q)
        for r, s in zip(u[:i] + u[j:], v[:i] + v[k:], strict=True):
            stack.extend(zip(r, s, strict=True))
        if i == j or i == k:
            continue
        shapes.fill(p[i:j], q[i:k])
        for m, n in Chain(shapes, p[i:j], q[i:k]).path():
            stack.extend(zip(u[i + m], v[i + n], strict=False))
    return out


def own_text(x: Node) -> str:
    """Text of an element without its block descendants."""
    held: list[str] = []

    stack: list[Node | str] = [x]
    while stack:
        y = stack.pop()
        if isinstance(y, str):
            held.append(y)
        elif y is x or (y.tag not in BLOCKS and not y.dropped):
            stack.extend(reversed(y.kids))
    return " ".join("".join(held).split())


def digest(*parts: str) -> int:
    """A signed 64-bit digest of strings."""
    h = hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(h.digest(), "big", signed=True)


EVIDENCE_SCHEMA = "host string, layout bigint, node int, text bigint, page bigint"


class Reference:
    """A parsed reference page: its nodes' numbers and shapes."""

    def __init__(self, page: str):
        self.tree = parse(page)
        self.number: dict[int, int] = {}
        stack = [self.tree]
        while stack:
            x = stack.pop()
            self.number[id(x)] = len(self.number)
            stack.extend(reversed(_children(x)))
        self.renew()

    def renew(self) -> None:
        self.shapes = Shapes()
        self.known = self.shapes.of(self.tree)

    def align(self, page: Node) -> list[tuple[Node, Node]]:
        if len(self.shapes.scores) + len(self.shapes.labels) > KEPT_SCORES:
            self.renew()
        return align(self.tree, page, self.shapes, self.known)


def _evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each page: reference nodes with text that align, and the page's text there.

    ``page`` is a digest of the page's whole content, so copies count once."""
    cached: dict[tuple[str, int], Reference] = {}
    for batch in batches:
        out = []
        batch = batch.sort_values(["host", "layout"])  # one reference after the other
        for host, layout, ref, page in zip(batch["host"], batch["layout"], batch["ref"], batch["html"], strict=True):
            key = (host, int(layout))
            if key not in cached:
                if len(cached) >= KEPT_REFERENCES:
                    del cached[next(iter(cached))]
                cached[key] = Reference(ref)
            mine = parse(page)
            whole = digest(*[t for _, t in blocks(mine)])
            for x, y in cached[key].align(mine):
                if y.tag in BLOCKS and not y.dropped:
                    text = own_text(y)
                    if text:
                        out.append((*key, cached[key].number[id(x)], digest(text), whole))
        yield pd.DataFrame(out, columns=["host", "layout", "node", "text", "page"])


def with_host(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.lower(F.regexp_extract(text_or_empty(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host.alias("host"), text_or_empty(html_col).alias("html")
    )


def layout_of(html_col: str):
    """Digest of the set of a page's structural elements, each tag with its class, numbers alike."""
    named = F.transform(
        F.regexp_extract_all(F.lower(F.col(html_col)), F.lit(LAYOUT_TAG), F.lit(0)),
        lambda m: F.concat_ws(
            ".", F.regexp_extract(m, r"^<([a-z]+)", 1),
            F.regexp_replace(F.regexp_extract(m, r"\bclass\s*=\s*[\"']?([^\"']*)", 1), "[0-9]+", "0"),
        ),
    )
    return F.xxhash64(F.array_sort(F.array_distinct(named)))


def reference_pages(pages: DataFrame, least_pages: int = LEAST_PAGES) -> tuple[DataFrame, DataFrame]:
    """``(refs, own)``: a reference for each layout of ``least_pages`` or more distinct pages, and for
    each host of so many its main one (``layout`` 0: the most frequent layout's); ``own`` names the (host, layout)
    pairs with a reference of their own.  Blank pages are none.

    A reference is the page nearest to its layout's geometric mean length, ties by digest."""
    size = F.floor(F.log2(F.octet_length("html").cast("double")) * 256)
    distinct = shared_table(
        pages.where(F.trim("html") != "").select("host", "layout", F.xxhash64("html").alias("_d"), size.alias("_s"))
        .groupBy("host", "layout", "_d").agg(F.min("_s").alias("_s")),
        "html-layouts",
    )
    layouts = distinct.groupBy("host", "layout").agg(
        F.count(F.lit(1)).alias("_n"), (F.sum("_s") / F.count(F.lit(1))).alias("_mean")
    )
    mains = layouts.groupBy("host").agg(
        F.max_by("layout", F.struct("_n", "layout")).alias("_main"), F.sum("_n").alias("_all")
    ).where(F.col("_all") >= least_pages).withColumnRenamed("host", "_mh")
    chosen = layouts.join(mains, F.col("host") == F.col("_mh")).where(
        (F.col("layout") == F.col("_main")) | (F.col("_n") >= least_pages)
    ).select(
        F.col("host").alias("_ch"), F.col("layout").alias("_cl"), "_mean",
        F.when(F.col("layout") == F.col("_main"), F.lit(0)).otherwise(F.col("layout")).cast("bigint").alias("_key"),
    )
    typical = distinct.join(chosen, (F.col("host") == F.col("_ch")) & (F.col("layout") == F.col("_cl"))).groupBy(
        F.col("host").alias("_fh"), F.col("layout").alias("_fl"), F.col("_key")
    ).agg(F.min_by("_d", F.struct(F.abs(F.col("_s") - F.col("_mean")), F.col("_d"))).alias("_fd"))
    typical = shared_table(typical, "html-typical")
    refs = pages.withColumn("_d", F.xxhash64("html")).join(
        small_side(typical, 100_000),
        (F.col("host") == F.col("_fh")) & (F.col("layout") == F.col("_fl")) & (F.col("_d") == F.col("_fd")),
    ).select(F.col("host").alias("_rh"), F.col("_key").alias("_rl"), F.col("html").alias("ref")).dropDuplicates(["_rh", "_rl"])
    own = typical.where("_key != 0").select(F.col("_fh").alias("_oh"), F.col("_fl").alias("_ol"))
    return shared_table(refs, "html-refs"), own


def induce_templates(
    pages: DataFrame, share: float = TEMPLATE_SHARE, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """Template texts per host: ``host``, ``texts`` (sorted digests).

    ``pages`` has ``host`` and ``html``.  Every page is aligned with its layout's reference, or
    the host's main one where its layout is rare.  A text is template if it stands at one reference node on at least
    ``share`` of the distinct pages that align there, of which there are ``least_pages`` or more."""
    pages = pages.select("host", "html", layout_of("html").alias("layout"))
    refs, own = reference_pages(pages, least_pages)
    size = refs.agg(F.coalesce(F.sum(F.octet_length("ref") + 64), F.lit(0))).first()[0]
    keyed = pages.join(
        small_side(own, 100_000), (F.col("host") == F.col("_oh")) & (F.col("layout") == F.col("_ol")), "left"
    ).select("host", F.coalesce("_ol", F.lit(0)).alias("layout"), "html")
    joined = keyed.join(
        F.broadcast(refs) if size <= BROADCAST_BYTES else refs,
        (F.col("host") == F.col("_rh")) & (F.col("layout") == F.col("_rl")),
    )
    seen = joined.select("host", "layout", "ref", "html").mapInPandas(_evidence, EVIDENCE_SCHEMA)
    node = ["host", "layout", "node"]
    texts = seen.groupBy(*node, "text", "page").agg(F.lit(1).alias("_o")).groupBy(*node, "text").agg(
        F.count(F.lit(1)).alias("_k")
    )
    texts = shared_table(texts, "html-evidence")
    nodes = texts.groupBy(*node).agg(F.sum("_k").alias("_all"), F.max("_k").alias("_top"))
    nodes = nodes.where((F.col("_all") >= least_pages) & (F.col("_top") >= share * F.col("_all"))).select(
        F.col("host").alias("_nh"), F.col("layout").alias("_nl"), F.col("node").alias("_nn"), F.col("_top").alias("_nk")
    )
    fixed = texts.join(
        nodes,
        (F.col("host") == F.col("_nh")) & (F.col("layout") == F.col("_nl")) & (F.col("node") == F.col("_nn"))
        & (F.col("_k") == F.col("_nk")),
    )
    return fixed.groupBy("host").agg(F.sort_array(F.collect_set("text")).alias("texts"))


OUT_SCHEMA = "_id bigint, _url string, text string, n_blocks int, n_template int"


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, counts, fixed = [], [], []
        for page, known in zip(batch["html"], batch["texts"], strict=True):
            found = blocks(parse(page))
            template = frozenset(known) if known is not None else ()
            kept = [t for _, t in found if not template or digest(t) not in template]
            texts.append(" ".join(kept))
            counts.append(len(kept))
            fixed.append(len(found) - len(kept))
        yield pd.DataFrame({
            "_id": batch["_id"].astype("Int64"), "_url": batch["_url"], "text": texts, "n_blocks": counts, "n_template": fixed,
        })


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    share: float = TEMPLATE_SHARE, least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """Main text of every page: ``_id``, ``_url``, ``text``, ``n_blocks``, ``n_template``.

    Defined cases: a null or empty page has an empty text; a page whose url has no host
    belongs to the host ``""``; hosts of fewer than ``least_pages`` pages have no template texts;
    copies of a page count once as evidence; repeated rows are extracted each; an empty table
    gives none; other columns are not read."""
    rows = with_host(pages, id_col, url_col, html_col)
    templates = shared_table(induce_templates(rows, share, least_pages), "html-templates").withColumnRenamed("host", "_th")
    held = templates.agg(F.coalesce(F.sum(F.size("texts") * 8 + F.octet_length("_th") + 64), F.lit(0))).first()[0]
    side = F.broadcast(templates) if held <= BROADCAST_BYTES else templates
    joined = rows.join(side, F.col("host") == F.col("_th"), "left").select("_id", "_url", "html", "texts")
    return joined.mapInPandas(_extract, OUT_SCHEMA)


def op1_html_wrapper(spark, sf_dir: str) -> DataFrame:
    """Main text of all ``pages``."""
    out = extract_main_text(read_table(spark, sf_dir, "pages"))
    return out.select(
        F.col("_id").alias("page_id"), F.col("_url").alias("url"), "text",
        F.char_length("text").cast("bigint").alias("n_chars"), "n_blocks", "n_template",
    )
