"""Main text of HTML pages by wrapper induction.

Pages of one host are made by one template. One page of each host, of a typical size, is its pivot. Every page's DOM
tree is aligned with the pivot's by simple tree matching: two nodes match if they have the same tag, more so with the
same class and id or the same text, and the best order-preserving matching of their children is found by dynamic
programming. From these alignments each text place of the pivot is told to be

* template: all but a few of the host's pages have the pivot's very text there;
* chrome: the text varies, but all but a few pages mark the place as a menu, header, footer, side bar, notice, advert,
  form or reader comment, by tag, role or class words;
* else a slot for content.

A page is read by this wrapper, whether it marks its article (``article``, ``main``) or not: what it has at template
places that is equal, and what it has at chrome places, goes. Places that the pivot does not have are judged by the
page's own marks, and so is a page without a wrapper. A page's own marks of chrome always count.

What all pages of a host repeat may also be an article that all of them are copies of. So pages whose blocks are the
pivot's are no evidence, pages that have the same text of their own are one witness, and where a page marks its article,
one that is the pivot's by more than half is a copy: it is kept whole and is no evidence. A wrapper needs two witnesses.

Defined cases: null html is empty and gives the empty text; a null or odd url has the empty host; a host with one page
or two has no wrapper; unclosed and stray tags are repaired as browsers do in the common cases; elements nested deeper
than 256 levels lose their tree but not their block ends and marks; very long pages are read whole; repeated rows are
treated each for itself; extra columns, whatever their names, are never read; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import html as html_lib
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.llm.common import materialize, table

#: A place is template or chrome if so great a share of at least so many witnesses say so.
SHARE, LEAST = 0.9, 2
#: Stands before a page's evidence.
WITNESS = -1
#: Pivots are broadcast if all of them together are no larger than this; else they are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

# fixed values: names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp desc metadata".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "body", "html"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}}
LEFT_OUT = frozenset("nav header footer aside form button select menu input label audio video canvas head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
WORDS_OUT = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead topbar footer sidebar aside widget notice notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social comment comments commentlist disqus respond reply replies related recommended pagination pager toolbar skip "
    "adbox adbanner adslot adunit adcontainer advertbox sitenav topnav mainnav navmenu cookiebar usercomments siteheader sitefooter pageheader pagefooter".split()
)
ARTICLE_WORDS = frozenset("article entry post story content".split())

# a quote opens a value only behind an equals sign; nothing is tried twice, so odd tags cost no more than others
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|<[!?][^>]*>", re.S)
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
#: Elements nested deeper become siblings; their texts stay where they are.
DEPTH = 256
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An element, or a text leaf (tag ``#``)."""

    __slots__ = ("attrs", "children", "kids", "label", "leaf", "size", "sum", "tag", "text")

    def __init__(self, tag: str, label: str, attrs: dict | None = None, text: str = ""):
        self.tag, self.label, self.attrs, self.text, self.children, self.leaf = tag, label, attrs, text, [], -1
        self.kids, self.sum, self.size = None, 0, 0


def parse(page: str) -> Node:
    """The tree of a page; texts are decoded and not yet stripped."""
    root = Node("#root", "#root")
    stack, at, last, size = [root], 0, page.rfind(">") + 1, len(page)
    if cut := UNFINISHED.search(page, last):  # a tag or comment that never ends
        size = cut.start()
    flat: dict[str, int] = {}  # elements that were not nested, by tag
    while at < size:
        m = TOKEN.search(page, at, last) if at < last else None
        end = m.start() if m else size
        if end > at:
            text = page[at:end]
            if "&" in text:
                text = html_lib.unescape(text)
            stack[-1].children.append(Node("#", "#", text=text))
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:
            continue
        tag = name.lower()
        if m[1]:
            if flat.get(tag):
                flat[tag] -= 1
                if tag in BLOCKS:  # an empty element ends the block
                    stack[-1].children.append(Node(tag, tag))
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        attrs = {k.lower(): a or b or c or "" for k, a, b, c in ATTRIBUTE.findall(m[3])} if m[3].strip(" /\n\t\r") else None
        label = f"{tag}.{attrs.get('class', '')}#{attrs.get('id', '')}" if attrs else tag
        if tag in CLOSES_P:
            _close(stack, {"p"}, {"button", "table", "td", "th"})
        if tag in CLOSES:
            _close(stack, CLOSES[tag], SCOPES[tag])
        node = Node(tag, label, attrs)
        stack[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else size
        elif tag not in VOID and (tag in BLOCKS or not m[3].endswith("/")):  # a slash does not close a block
            if len(stack) < DEPTH or (len(stack) == DEPTH and left_out(node, True)):
                stack.append(node)
            else:
                flat[tag] = flat.get(tag, 0) + 1
    return root


def _close(stack: list[Node], tags: set, scope: set) -> None:
    for i in range(len(stack) - 1, 0, -1):
        tag = stack[i].tag
        if tag in tags:
            del stack[i:]
            if len(stack) > 1 and stack[-1].tag in tags:
                _close(stack, tags, scope)
            return
        if tag in scope or (tag in BLOCKS and "p" in tags):
            return


# --- simple tree matching


#: Larger tables of children are cut at the children that are alike and occur once on both sides.
CELLS = 40_000


def _weigh(node: Node) -> None:
    """Sets the children but for blank texts, a digest of tags and texts, and what a match with an equal tree scores."""
    if node.tag == "#":
        node.kids, node.sum, node.size = [], hash(tuple(node.text.split())), 2
        return
    node.kids = [c for c in node.children if c.tag != "#" or c.text.strip()]
    for c in node.kids:
        _weigh(c)
    node.sum, node.size = hash((node.tag, *[c.sum for c in node.kids])), 2 + sum(c.size for c in node.kids)


def _segments(xs: list[Node], ys: list[Node]) -> list[tuple[list[Node], list[Node]]]:
    """``xs`` and ``ys`` cut at the longest increasing row of children that are equal and occur once on both sides."""
    once = lambda nodes: {k: i for i, k in enumerate(n.sum for n in nodes) if counts[k] == 1}
    counts = Counter(n.sum for n in xs)
    left = once(xs)
    counts = Counter(n.sum for n in ys)
    right = once(ys)
    tops: list[int] = []
    row: list[tuple[int, int, int]] = []  # (place in xs, place in ys, the pair before)
    ends: list[int] = []
    for k, i in left.items():
        if (j := right.get(k)) is not None:
            at = bisect.bisect_left(tops, j)
            tops[at:], ends[at:] = [j, *tops[at + 1 :]], [len(row), *ends[at + 1 :]]
            row.append((i, j, ends[at - 1] if at else -1))
    cuts, at = [], ends[-1] if ends else -1
    while at >= 0:
        cuts.append(row[at][:2])
        at = row[at][2]
    out, i, j = [], 0, 0
    for a, b in reversed(cuts):
        out += [(xs[i:a], ys[j:b]), (xs[a : a + 1], ys[b : b + 1])]
        i, j = a + 1, b + 1
    return [*out, (xs[i:], ys[j:])]


def match_trees(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """The text leaves of ``a`` and ``b`` that a best matching of the two trees pairs."""
    return best_match(a, b)[1]


def best_match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """The score of a best matching of the two trees, and the text leaves that it pairs.

    Nodes match by tag. A pair of texts scores 1, of elements 1; equal texts and equal names (class, id) score 1 more,
    so names that change from page to page do not keep the trees apart; trees of equal tags and texts score in full.
    No pair scores more than either tree has nodes twice, so pairing equal children at both ends loses nothing.
    Children of up to ``CELLS`` pairs are matched in the best way; longer lists are cut first at children that are alike.
    """
    scores: dict[tuple[int, int], tuple[int, list]] = {}
    for root in (a, b):
        if root.kids is None:
            _weigh(root)

    def match(x: Node, y: Node) -> tuple[int, list]:
        if x.tag == "#":
            return 1 + (x.sum == y.sum), [(x, y)]
        if x.sum == y.sum:
            return x.size, [(x, y)]
        key = (id(x), id(y))
        if key not in scores:
            n, pairs = align(x.kids, y.kids)
            scores[key] = n + 1 + (x.label == y.label), pairs
        return scores[key]

    def align(xs: list[Node], ys: list[Node]) -> tuple[int, list]:
        if not xs or not ys:
            return 0, []
        if len(xs) == 1 == len(ys):
            return match(xs[0], ys[0]) if xs[0].tag == ys[0].tag else (0, [])
        total, out, lo = 0, [], 0
        # equal children from the front or the back on are paired in order
        while lo < len(xs) and lo < len(ys) and xs[lo].sum == ys[lo].sum:
            lo += 1
        hi = 0
        while hi < len(xs) - lo and hi < len(ys) - lo and xs[-1 - hi].sum == ys[-1 - hi].sum:
            hi += 1
        for i in [*range(lo), *range(-hi, 0)]:
            total += xs[i].size
            out.append((xs[i], ys[i]))
        xs, ys = xs[lo : len(xs) - hi], ys[lo : len(ys) - hi]
        for us, vs in [(xs, ys)] if len(xs) * len(ys) <= CELLS else _segments(xs, ys):
            if not us or not vs:
                continue
            if len(us) * len(vs) > CELLS:  # nothing alike to hold on to: in order
                for x, y in zip(us, vs, strict=False):
                    if x.tag == y.tag:
                        n, pairs = match(x, y)
                        total += n
                        out += pairs
                continue
            rows = [[0] * (len(vs) + 1)]
            for x in us:
                above, row, last = rows[-1], [0], 0
                for j, y in enumerate(vs):
                    best = above[j + 1] if above[j + 1] >= last else last
                    if x.tag == y.tag:
                        n = above[j] + match(x, y)[0]
                        best = n if n > best else best
                    row.append(best)
                    last = best
                rows.append(row)
            i, j = len(us), len(vs)
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out += match(us[i], vs[j])[1]
            total += rows[-1][-1]
        return total, out

    if a.tag != b.tag:
        return 0, []
    score, found = match(a, b)
    found, leaves = list(found), []
    while found:  # equal trees were paired as a whole
        x, y = found.pop()
        if x.tag == "#":
            leaves.append((x, y))
        else:
            found.extend(zip(x.kids, y.kids, strict=True))
    return score, leaves


# --- roles and blocks


@functools.lru_cache(maxsize=20_000)
def _words(name: str) -> frozenset:
    """The words of a class name or id, and all of them in one (``side-bar`` is a ``sidebar``)."""
    words = [w.lower() for w in NAME_WORDS.findall(name)]
    return frozenset([*words, "".join(words)])


def left_out(node: Node, in_article: bool) -> bool:
    """Whether an element's tag, role or names say that it is no part of the article."""
    if node.tag in LEFT_OUT:
        return not (node.tag == "header" and in_article) and not (node.tag == "form" and _has_article(node))
    if node.tag == "dialog" and not (node.attrs and "open" in node.attrs):
        return True
    if not node.attrs or node.tag in ("html", "body", "main"):
        return False
    a = node.attrs
    if a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return True
    if "style" in a and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a["style"], re.I):
        return True
    for name in (*a.get("class", "").split(), a.get("id", "")):
        words = _words(name)
        if words & WORDS_OUT and not (words & ARTICLE_WORDS and words & WORDS_OUT <= {"header"}):
            return not _has_article(node)
    return False


def _has_article(node: Node) -> bool:
    return any(c.tag == "main" or (c.attrs and c.attrs.get("role") == "main") or (c.tag == "article" and not (c.attrs and _words(c.attrs.get("class", "")) & WORDS_OUT)) or _has_article(c) for c in node.children)


IN, OUT, HEAD = 0, 1, 2
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())


def blocks(root: Node) -> tuple[list[tuple[str, list[Node], bool]], bool]:
    """Blocks (text, leaves, whether the page's own marks leave it out) in page order, and whether an article was marked.

    In a header inside an article only headings count.
    """
    out: list[tuple[str, list[Node], bool]] = []
    line: list[Node] = []
    marked: list[Node] = []

    def seek(node: Node, tags: tuple) -> None:
        for c in node.children:
            if (c.tag in tags or (c.attrs and c.attrs.get("role") in tags)) and not (c.attrs and left_out(c, False)):
                marked.append(c)
            elif c.tag not in RAW and c.tag != "#" and not left_out(c, False):
                seek(c, tags)

    def close(mode: int) -> None:
        text = " ".join("".join(x.text for x in line).split())
        if text:
            out.append((text, [x for x in line if x is not _SPACE and x.text.strip()], mode != IN))
        line.clear()

    def walk(node: Node, article: bool, mode: int) -> None:
        for c in node.children:
            tag = c.tag
            if tag == "#":
                line.append(c)
            elif tag in RAW:
                if tag in BLOCKS:
                    close(mode)
            elif tag in VOID:
                if tag in ("br", "hr"):
                    line.append(_SPACE)
                if tag == "hr":
                    close(mode)
            else:
                if id(c) in starts:
                    own = IN
                elif mode == OUT or left_out(c, article):
                    own = OUT
                elif mode == HEAD:
                    own = IN if tag in HEADINGS else HEAD
                else:
                    own = HEAD if tag == "header" and article else mode
                held = None
                if tag in BLOCKS:
                    close(mode)
                elif own != mode:  # part of a line: its text is a block of its own
                    held = line.copy()
                    line.clear()
                walk(c, article or tag in ("article", "main"), own)
                if tag in BLOCKS or held is not None:
                    close(own)
                if held is not None:
                    line.extend(held)

    seek(root, ("main",))
    if not marked:
        seek(root, ("article",))
    starts = {id(m) for m in marked}
    mode = OUT if marked else IN
    walk(root, bool(marked), mode)
    close(mode)
    return out, bool(marked)


_SPACE = Node("#", "#", text=" ")


@functools.lru_cache(maxsize=256)
def _pivot(page: str) -> tuple[Node, list[str]]:
    """The tree with its leaves numbered, and the texts of its blocks."""
    root = parse(page)
    n, todo = 0, [root]
    while todo:
        node = todo.pop()
        if node.tag == "#":
            node.leaf = n
            n += 1
        todo += reversed(node.children)
    return root, [t for t, _, out in blocks(root)[0] if not out]


def _one(page: str | None, pivot: str | None) -> tuple[list, list[int], str | None, bool]:
    """Blocks (text, out, leaves' places in the pivot as twice the place, one more if equal, -1 for none), evidence
    (four times the place, plus 1 if equal, plus 2 if left out; WITNESS first), a digest of what is the page's own, and
    whether an article was marked.

    A page whose blocks are the pivot's, or whose marked article is by more than half, is no evidence and has no digest.
    """
    if not page:
        return [], [], None, False
    root = parse(page)
    place = {}
    if pivot:
        tree, told = _pivot(pivot)
        place = {id(x): 2 * y.leaf + (x.sum == y.sum) for x, y in match_trees(root, tree)}
    found, marked = blocks(root)
    found = [(text, out, [place.get(id(x), -1) for x in leaves]) for text, leaves, out in found]
    evidence, key = [], None
    told_here = [(t, leaves) for t, out, leaves in found if not out]
    own = [t for t, leaves in told_here if any(x < 0 or x % 2 == 0 for x in leaves)]
    if pivot and [t for t, _ in told_here] != told and not (marked and 2 * sum(map(len, own)) < sum(len(t) for t, _ in told_here)):
        key = hashlib.md5("\n".join(own).encode("utf-8", "surrogatepass")).hexdigest()
        evidence = [WITNESS, *[2 * (x - x % 2) + x % 2 + 2 * out for _, out, leaves in found for x in leaves if x >= 0]]
    return [{"text": t, "out": out, "leaves": leaves} for t, out, leaves in found], evidence, key, marked


# --- over tables


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def pivots(pages: DataFrame) -> DataFrame:
    """``(host, pivot)``: the shortest page that is not shorter than a quarter of its host's; none for single pages."""
    slim = pages.select("host", F.length("html").alias("n"), F.xxhash64("html").alias("h")).where(F.col("n") > 0)
    # written tables have no partitioning, so the joins do not gather a large host's pages in one task
    hosts = slim.groupBy("host").agg(F.percentile_approx("n", 0.25).alias("q"), F.count("*").alias("c")).where(F.col("c") > 1)
    hosts = materialize(hosts.select(F.col("host").alias("q_host"), "q"), "html-hosts")
    long_enough = slim.join(hosts, (F.col("host") == F.col("q_host")) & (F.col("n") >= F.col("q")))
    chosen = long_enough.groupBy("host").agg(F.min(F.struct("n", "h")).alias("m"))
    chosen = materialize(chosen.select(F.col("host").alias("p_host"), F.col("m.h").alias("p_h")), "html-chosen")
    found = pages.select("host", "html").join(chosen, (F.xxhash64("html") == F.col("p_h")) & (F.col("host") == F.col("p_host")))
    return found.groupBy("host").agg(F.min("html").alias("pivot"))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, blocks array<string>)``: the article's blocks of every row, in page order."""
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    chosen = materialize(pivots(pages), "html-pivots")
    total = chosen.agg(F.coalesce(F.sum(F.octet_length("pivot")), F.lit(0))).first()[0]
    small = total <= BROADCAST_BYTES
    joined = pages.join(F.broadcast(chosen) if small else chosen, "host", "left").select("id", "url", "host", "html", "pivot")
    kind = dict(joined.dtypes)["id"]

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                part = pdf.iloc[at : at + 1000]
                done = [_one(h, p) for h, p in zip(part["html"], part["pivot"], strict=True)]
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(),
                        "url": part["url"].to_numpy(),
                        "host": part["host"].to_numpy(),
                        "blocks": [d[0] for d in done],
                        "evidence": [d[1] for d in done],
                        "own": [d[2] for d in done],
                        "marked": [d[3] for d in done],
                    }
                )

    texts = joined.withColumn("id", F.col("id").cast("string")).mapInPandas(
        run, "id string, url string, host string, blocks array<struct<text:string,out:boolean,leaves:array<int>>>, evidence array<int>, own string, marked boolean"
    )
    texts = materialize(texts.withColumn("id", F.col("id").cast(kind)), "html-blocks")
    # pages that have the same of their own are copies and one witness; min, since copies need not agree elsewhere
    told = texts.where("own is not null").groupBy("host", "own").agg(F.min("evidence").alias("evidence")).select("host", F.explode("evidence").alias("e"))
    equal, out = F.col("e") % 2 == 1, F.shiftright("e", 1) % 2 == 1
    seen = told.groupBy("host", F.shiftright("e", 2).alias("leaf")).agg(F.count("*").alias("n"), F.count_if(equal & ~out).alias("same"), F.count_if(out).alias("out"))
    often = seen.where((F.col("leaf") == WITNESS) | (F.greatest("same", "out") >= LEAST))
    wrapper = often.groupBy("host").agg(F.max(F.when(F.col("leaf") == WITNESS, F.col("n"))).alias("w"), F.collect_list(F.when(F.col("leaf") != WITNESS, F.struct("leaf", "n", "same", "out"))).alias("t"))
    places = lambda kind: F.transform(F.filter("t", lambda x: x[kind] >= SHARE * (F.col("w") if kind == "same" else x["n"])), lambda x: x["leaf"])
    wrapper = wrapper.select("host", places("same").alias("template"), places("out").alias("chrome"))
    if small:  # no more leaves than the pivots have, so the same bound holds
        wrapper = F.broadcast(wrapper)
    rows = texts.join(wrapper, "host", "left")
    # the wrapper's word on a block's leaves; a marked article's own parts are not taken for chrome
    constant = lambda x: (x % 2 == 1) & F.array_contains("template", F.shiftright(x, 1))
    framed = lambda x: (x >= 0) & ~F.col("marked") & F.array_contains("chrome", F.shiftright(x, 1))
    body = F.filter("blocks", lambda b: ~b["out"])
    kept = F.filter(body, lambda b: F.exists(b["leaves"], lambda x: ~(constant(x) | framed(x))))
    chars = lambda found: F.aggregate(found, F.lit(0), lambda n, b: n + F.length(b["text"]))
    # a marked article that is the template's by more than half is a copy of the pivot's
    rows = rows.select("id", "url", "marked", body.alias("body"), F.when(F.col("template").isNotNull(), kept).alias("kept"))
    copy = F.col("kept").isNull() | (F.col("marked") & (2 * chars("kept") < chars("body")))
    return rows.select("id", "url", F.transform(F.when(copy, F.col("body")).otherwise(F.col("kept")), lambda b: b["text"]).alias("blocks"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = extract(table(spark, sf_dir, "pages"))
    text = F.array_join("blocks", "\n")
    return e.select(F.col("id").alias("page_id"), "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
