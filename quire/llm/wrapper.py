"""Main text of web pages by wrapper induction.

Pages of one host and layout are aligned with one page of them by simple tree
matching of their DOM trees. A layout is a set of structural elements with their
classes; one with fewer than MIN_PAGES pages goes with the host's largest. The
page aligned with is one with the most frequent sequence of such elements (then
the longest sequence, then the smallest page_id), so an empty or odd page does
not stand for others. A node of that page whose
own text is the same in nearly all aligned pages is template; a node whose
text varies is a slot. The wrapper of a host is the lowest place under which
most of its slots' text lies (an article or main element where pages have one), and
the template nodes. A page's text is what lies at that place, without
template nodes and without the parts that are never article by element or
class (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, comments). Inside an article element nothing is taken for template on
account of its text, because copies of one article look constant as well.

Every page is aligned and counted; per host only counts by node meet.

Defined results: null, empty and tagless pages give the text that is there
("" if none); a null url is a host of its own; an empty page is no layout of others; repeated pages are extracted
each; a host with fewer than MIN_PAGES pages has no template nodes.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_PAGES = 4       # aligned pages from which a constant node counts as template
PLACE = 0.8         # share of a host's varying text that lies under its place
CONSTANT = 0.9      # share of them that agree on its text

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option "
                  "p pre section select summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"},
            "tfoot": {"tbody", "tr", "td", "th"}}
NEVER = frozenset("nav header footer aside form script style noscript template textarea title svg iframe head button "
                  "select input menu dialog".split())
NEVER_NAMED = frozenset("ad ads advert adverts advertisement adbox banner sponsor sponsored promo menu nav navbar "
                        "navigation breadcrumb breadcrumbs sidebar side widget header masthead footer foot cookie "
                        "cookies consent notice notices popup modal newsletter subscribe signup social share sharing "
                        "comment comments respond disqus related recommended form search login pagination pager "
                        "copyright toolbar".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
ROOTS = ("article", "main")

PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                  r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))")
NAME = re.compile(r"[A-Za-z]+")


class Tree:
    """DOM tree in document order; node 0 is the root.

    label: element name with its class; parent, children; parts: the node's
    own text and child nodes in order (str or int); never: not article, by
    element, class, id or role.
    """

    def __init__(self, html: str | None):
        self.tag, self.label, self.parent, self.never = ["#root"], ["#root"], [-1], [False]
        self.parts: list[list] = [[]]
        html = html or ""
        stack, at, end = [0], 0, len(html)
        while at < end:
            m = PART.search(html, at)
            stop = m.start() if m else end
            if stop > at:
                self.parts[stack[-1]].append(html[at:stop])
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(stack, tag)
                continue
            self._implied(stack, tag)
            node = self._add(stack[-1], tag, m[3])
            if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW:
                continue
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = close.end() if close else end
                continue
            stack.append(node)

    def _add(self, parent: int, tag: str, attrs: str) -> int:
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.parts.append([])
        self.parts[parent].append(node)
        if not attrs:
            self.label.append(tag)
            self.never.append(tag in NEVER)
            return node
        named = {k.lower(): a or b or c for k, a, b, c in ATTR.findall(attrs)} if "=" in attrs else {}
        words = {w.lower() for k in ("class", "id") for w in re.split(r"[\s_-]+", named.get(k, ""))}
        words |= {w.lower() for w in named.get("class", "").split()}
        self.label.append(f"{tag}.{named['class']}" if named.get("class") else tag)
        self.never.append(tag in NEVER or bool(words & NEVER_NAMED) or named.get("role", "").lower() in NEVER_ROLES
                          or "hidden" in attrs.split())
        return node

    def _close(self, stack: list[int], tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] == tag:
                del stack[i:]
                return
            if tag not in BLOCK and self.tag[stack[i]] in BLOCK:
                return  # an inline end tag does not close a block

    def _implied(self, stack: list[int], tag: str) -> None:
        """Close what a start tag ends: an open paragraph, or an earlier item of the same list or row."""
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[i]]
                if t == "p":
                    del stack[i:]
                    break
                if t in BLOCK:
                    break
        ends = SIBLINGS.get(tag)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[i]]
                if t in ends:
                    del stack[i:]
                elif t in BLOCK:
                    break

    def kids(self) -> list[list[int]]:
        """Child nodes of every node."""
        return [[p for p in parts if not isinstance(p, str)] if parts else parts for parts in self.parts]

    def own_text(self, node: int) -> str:
        """The node's own text as it stands in the page."""
        return " ".join([p for p in self.parts[node] if isinstance(p, str)]).strip()

    def path(self, node: int) -> str:
        out = []
        while node > 0:
            out.append(self.label[node])
            node = self.parent[node]
        return "/".join(reversed(out))

    def blocks(self, node: int, skip: set[int]) -> list[str]:
        """Texts of the blocks below a node, in page order."""
        out: list[str] = []
        held: list[str] = []

        def flush() -> None:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append(text)

        todo: list = [iter(self.parts[node])]
        ends: list[bool] = [True]
        while todo:
            part = next(todo[-1], None)
            if part is None:
                todo.pop()
                if ends.pop():
                    flush()
            elif isinstance(part, str):
                held.append(part)
            elif part in skip or self.never[part]:
                if self.tag[part] in BLOCK:
                    flush()
            elif self.tag[part] == "br":
                held.append(" ")
            else:
                block = self.tag[part] in BLOCK
                if block:
                    flush()
                todo.append(iter(self.parts[part]))
                ends.append(block)
        return out


def align(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Node pairs of the largest simple tree matching of two trees.

    Children are matched in order, so two leaves of one label at the same end
    of both lists can be paired at once; the table is only filled between.
    """
    memo: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    kids_a, kids_b, label_a, label_b = a.kids(), b.kids(), a.label, b.label

    def match(x: int, y: int) -> list[tuple[int, int]]:
        """Child pairs still to be matched first; without any, the pair's own matching goes into memo."""
        xs, ys, chosen = kids_a[x], kids_b[y], []
        lo, n, m = 0, len(xs), len(ys)
        while lo < n and lo < m and _leaves(xs[lo], ys[lo]):
            chosen.append((xs[lo], ys[lo]))
            lo += 1
        while n > lo and m > lo and _leaves(xs[n - 1], ys[m - 1]):
            n, m = n - 1, m - 1
            chosen.append((xs[n], ys[m]))
        inner = [v for v in ys[lo:m] if kids_b[v]]
        first = [(u, v) for u in xs[lo:n] if kids_a[u] for v in inner if label_a[u] == label_b[v] and (u, v) not in memo]
        if first:
            return first
        total = len(chosen) + 1
        xs, ys = xs[lo:n], ys[lo:m]
        n, m = len(xs), len(ys)
        if n and m:
            best = [[0] * (m + 1) for _ in range(n + 1)]
            names = [label_b[v] for v in ys]
            for i in range(1, n + 1):
                row, above, u = best[i], best[i - 1], xs[i - 1]
                name, leaf = label_a[u], not kids_a[u]
                for j in range(1, m + 1):
                    up = above[j] if above[j] >= row[j - 1] else row[j - 1]
                    if name == names[j - 1]:
                        v = ys[j - 1]
                        w = above[j - 1] + (1 if leaf or not kids_b[v] else memo[u, v][0])
                        if w > up:
                            up = w
                    row[j] = up
            total += best[n][m]
            i, j = n, m
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    chosen.append((xs[i], ys[j]))
        memo[x, y] = (total, chosen)
        return []

    def _leaves(u: int, v: int) -> bool:
        return label_a[u] == label_b[v] and not kids_a[u] and not kids_b[v]

    waiting = [(0, 0)]  # a stack of its own, as trees may be very deep
    while waiting:
        pair = waiting[-1]
        more = [] if pair in memo else match(*pair)
        if more:
            waiting += more
        else:
            waiting.pop()
    out, todo = [], [(0, 0)]
    while todo:
        pair = todo.pop()
        out.append(pair)
        if pair in memo:
            todo += memo[pair][1]
    return out


def root_of(tree: Tree, wanted: str | None) -> int:
    """The node that holds the article: an article or main element, else the host's place, else the page."""
    for tag in ROOTS:
        at = [i for i, t in enumerate(tree.tag) if t == tag and not _under_never(tree, i)]
        if len(at) == 1:
            return at[0]
        if at:
            return max(at, key=lambda i: (sum(map(len, tree.blocks(i, set()))), -i))
    if wanted:
        end = wanted.rpartition("/")[2]
        at = [i for i in range(1, len(tree.tag)) if tree.label[i] == end and tree.path(i) == wanted]
        if at:  # of several such nodes the one with most text
            return max(at, key=lambda i: (sum(map(len, tree.blocks(i, set()))), -i))
    return 0


def _under_never(tree: Tree, node: int) -> bool:
    while node > 0:
        if tree.never[node]:
            return True
        node = tree.parent[node]
    return False


def extract(html: str | None, place: str | None = None, seed: Tree | None = None, template: set[int] = frozenset()) -> str:
    """Main text of one page under its host's wrapper."""
    tree = Tree(html)
    root = root_of(tree, place)
    skip: set[int] = set()
    if seed is not None and template and tree.tag[root] not in ROOTS:
        skip = {y for x, y in align(seed, tree) if x in template and seed.own_text(x) == tree.own_text(y)}
    return "\n".join(tree.blocks(root, skip))


def host_of(url) -> F.Column:
    """Host part of an address, lower case, without port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1),
                              F.lit("")))


STRUCTURE = (r"(?i)<((?:body|div|section|article|main|header|footer|nav|aside|table|form)\b"
             r"(?:\s+class\s*=\s*(?:\"[^\"]*\"|'[^']*'))?)")


def with_layout(pages: DataFrame) -> DataFrame:
    """host: host and layout that a page goes with; _seq, _n: hash and length of its sequence of structural elements."""
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(STRUCTURE), F.lit(1))
    rows = pages.withColumn("_found", found).withColumns({
        "_n": F.size("_found"), "_seq": F.xxhash64("_found"),
        "_layout": F.xxhash64(F.array_sort(F.array_distinct("_found")))}).drop("_found")
    sizes = rows.groupBy("host", "_layout", (F.col("_n") > 0).alias("_any")).agg(F.count("*").alias("_pages"))
    largest = sizes.groupBy("host").agg(F.max_by("_layout", F.struct("_any", "_pages", "_layout")).alias("_largest"))
    goes = sizes.join(largest, "host").select(
        "host", "_layout", F.when(F.col("_any") & (F.col("_pages") >= MIN_PAGES), F.col("_layout")).otherwise(
            F.col("_largest")).alias("_with"))
    goes = C.checked_broadcast(C.staged(goes, "layouts"), 96)
    return rows.join(goes, ["host", "_layout"]).withColumn(
        "host", F.concat_ws(" ", "host", F.col("_with").cast("string"))).drop("_layout", "_with")


def seeds(pages: DataFrame) -> DataFrame:
    """(host, seed html) with one page of the most frequent sequence of each host and layout."""
    seq = pages.groupBy("host", "_seq", "_n").agg(F.count("*").alias("_pages"), F.min("page_id").alias("_first"))
    first = seq.groupBy("host").agg(F.max_by(F.struct("_seq", "_first"), F.struct(
        F.col("_n") > 0, "_pages", "_n", F.col("_first").isNull(), -F.col("_first"), "_seq")).alias("_pick")).select(
            "host", "_pick.*")
    return pages.join(C.checked_broadcast(first.withColumnRenamed("_seq", "_of"), 64), "host").where(
        "page_id <=> _first AND _seq = _of").groupBy("host").agg(F.min("html").alias("seed"))


def wrappers(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, place, template nodes of the seed) from all pages of each host."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, int], list[int]] = {}
        trees: dict[str, Tree] = {}
        for b in batches:
            for host, html, seed in zip(b["host"], b["html"], b["seed"], strict=True):
                if host not in trees:
                    if len(trees) >= 256:
                        trees.clear()
                    trees[host] = Tree(seed)
                seed_tree, tree = trees[host], Tree(html)
                for x, y in align(seed_tree, tree):
                    text = tree.own_text(y)
                    if not text:
                        continue
                    s = seen.setdefault((host, x), [0, 0, 0])
                    s[0] += 1
                    s[1] += text == seed_tree.own_text(x)
                    s[2] += len(text)
            if len(seen) > 200_000:
                yield _rows(seen)
                seen = {}
        yield _rows(seen)

    counts = pages.join(hosts, "host").select("host", "html", "seed").mapInPandas(
        count, "host string, node int, n long, same long, chars long")
    by_node = counts.groupBy("host", "node").agg(F.sum("n").alias("n"), F.sum("same").alias("same"),
                                                F.sum("chars").alias("chars"))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for host, seed, nodes in zip(b["host"], b["seed"], b["nodes"], strict=True):
                tree, fixed, slots = Tree(seed), [], []
                for r in nodes if nodes is not None else []:
                    if r["n"] >= MIN_PAGES and r["same"] >= CONSTANT * r["n"]:
                        fixed.append(int(r["node"]))
                    elif not _under_never(tree, r["node"]):
                        slots.append((int(r["node"]), int(r["chars"])))
                place = tree.path(_place(tree, slots)) if slots else None
                out.append((host, seed, place, sorted(fixed)))
            yield pd.DataFrame(out, columns=["host", "seed", "place", "fixed"])

    lists = by_node.groupBy("host").agg(F.collect_list(F.struct("node", "n", "same", "chars")).alias("nodes"))
    return hosts.join(lists, "host", "left").mapInPandas(
        decide, "host string, seed string, place string, fixed array<int>")


def _place(tree: Tree, slots: list[tuple[int, int]]) -> int:
    """The lowest node that has most (PLACE) of the slots' text under it."""
    under = [0] * len(tree.tag)
    for node, chars in slots:
        under[node] += chars
    for node in range(len(tree.tag) - 1, 0, -1):  # children come after their parents
        under[tree.parent[node]] += under[node]
    at = max((i for i in range(len(under)) if under[i] >= PLACE * under[0]), default=0)
    return tree.parent[at] if tree.tag[at] not in BLOCK and at else at


def _rows(seen: dict) -> pd.DataFrame:
    return pd.DataFrame([(h, x, *s) for (h, x), s in seen.items()], columns=["host", "node", "n", "same", "chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """All columns of `pages` (page_id, url, html, ...) plus text and n_chars."""
    spark = C.prepare(pages.sparkSession)
    base = pages.drop(*[c for c in ("text", "n_chars") if c in pages.columns])
    given = base.columns
    base = with_layout(base.withColumnsRenamed({c: f"_in_{i}" for i, c in enumerate(given) if c not in ("page_id", "html")})
                       .withColumn("host", host_of(F.col(_renamed(given, "url")))))
    keyed = base.select("page_id", "html", "host", "_seq", "_n")
    hosts = C.staged(seeds(keyed), "seeds")
    wrap = C.staged(wrappers(keyed, _small(hosts)), "wrappers")
    known = _small(wrap).withColumnsRenamed({"host": "_host", "seed": "_seed", "place": "_place", "fixed": "_fixed"})
    joined = base.join(known, F.col("host") == F.col("_host"), "left").select(
        *[F.col(_renamed(given, c)).alias(c) for c in given], F.col("host").alias("_key"), "_seed", "_place", "_fixed")
    return C.by_rows(joined, ["html", "_key", "_seed", "_place", "_fixed"], "text string, n_chars long", _extract_rows,
                     drop=["_key", "_seed", "_place", "_fixed"])


def _renamed(given: list[str], column: str) -> str:
    """Name of an input column while columns of the wrapper's own stand beside it."""
    return column if column in ("page_id", "html") else f"_in_{given.index(column)}"


def _small(hosts: DataFrame) -> DataFrame:
    """The host table, broadcast when its bytes fit the bound."""
    size = hosts.agg(F.sum(F.length("seed") + 200)).first()[0] or 0
    return F.broadcast(hosts) if size <= C.BROADCAST_BYTES // 4 else hosts


_SEEDS: dict[tuple[str, str], tuple[Tree, set[int]]] = {}


def _extract_rows(cols: dict[str, list]) -> dict:
    out = []
    for html, key, seed, place, fixed in zip(*(cols[k] for k in ("html", "_key", "_seed", "_place", "_fixed")), strict=True):
        tree = None
        if fixed:
            if (key, seed) not in _SEEDS:
                if len(_SEEDS) >= 256:
                    _SEEDS.clear()
                _SEEDS[key, seed] = (Tree(seed), set(fixed))
            tree = _SEEDS[key, seed][0]
        out.append(extract(html, place, tree, set(fixed or ())))
    return {"text": out, "n_chars": [len(t) for t in out]}
