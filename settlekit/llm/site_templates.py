"""Main text of web pages by removing what a site repeats.

Every block element's subtree is hashed; Spark counts, for each host, the pages
that hold a hash; a page then loses the subtrees that recur across many pages of
its host, and the elements whose kind says that they are no article (menus,
forms, scripts, adverts, reader comments), which a host with a single page
can't show by repetition. What is left is the text.

Two shares decide. Around the article a subtree goes when it is on ``frame_share``
of the host's pages (three pages at least). Inside the article (an ``article``
or ``main`` element, else the element that holds most of the text) copies of one
text on several pages of a host repeat as well, so there a subtree must be on
``main_share`` of the pages (ten at least), and if such subtrees make up half of
the article, it is a copied article and stays whole. Where a page marks its
article, the text is that of the article alone.

Cases: a null or empty page has an empty text; so has one without an article's
words. A page without a host (null or odd url) belongs to no site: nothing is
counted for it. A repeated row counts as a page of its own and gives a row of
its own. Text that isn't HTML is its own text. Columns of other names are
ignored, whatever they are called.

Scale: one row for each (host, subtree) and task goes through the shuffle, the
templates of a host are at most (subtrees a page) / ``frame_share``. They reach
the pages by broadcast while they are proven small, else each host's list is
dealt to ``SALTS`` partitions of that host's pages, so a host with a third of all
pages is split.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm.markup import BLOCK, Node, nodes, parse, signed, text_of
from settlekit.operators.joins import fits
from settlekit.session import stage_table

MIN_FRAME_PAGES, FRAME_SHARE = 3, 0.01
MIN_MAIN_PAGES, MAIN_SHARE = 10, 0.5
DENSE = 0.6                    # share of the text that makes a child the article's element
BROADCAST_ROWS = 500_000       # templates (24 bytes each) sent to every task
SALTS = 32
OUT_BYTES = 8 << 20            # texts held before they are handed to Spark

# kinds of elements that are no article (fixed values)
NEVER = frozenset(
    "script style noscript template svg iframe object embed canvas audio video map head title nav aside footer form"
    " button select textarea datalist dialog menu search frameset noframes xmp".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar"
                  " tablist".split())
NAMES = frozenset(
    "ad ads adbox adslot advert advertisement advertising adverts banner banners breadcrumb breadcrumbs comment comments"
    " commentlist consent cookie cookies disqus footer masthead menu menus nav navbar navigation newsletter notice notices"
    " popup promo promos promotion related respond share sharebar sharing sidebar sidebars signup skyscraper social sponsor"
    " sponsored subscribe subscription toolbar widget widgets".split())
READER = frozenset("comment comments commentlist disqus related respond sidebar widget".split())
CONTAINERS = frozenset("article center div main section table tbody td tr".split())

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+")
_TOLD = re.compile(r"class|id|role|hidden|style|itemprop", re.I)


def attributes(node: Node) -> dict[str, str]:
    if not node.attrs or not _TOLD.search(node.attrs):
        return {}
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(node.attrs):
        out.setdefault(name.lower(), a or b or c)
    return out


def is_marked_main(node: Node, attrs: dict[str, str]) -> bool:
    return (node.tag in ("article", "main") or attrs.get("role", "").lower() in ("main", "article")
            or attrs.get("itemprop", "").lower() == "articlebody")


def is_furniture(node: Node, attrs: dict[str, str], in_main: bool) -> bool:
    """Whether the element's kind, role, class or id says that it is no part of an article."""
    if node.tag in NEVER or (node.tag == "header" and not in_main):
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if attrs.get("role", "").lower() in ROLES:
        return True
    named = set(_NAME.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
    return bool(named & NAMES) or (not in_main and "header" in named)


def subtrees(root: Node) -> set[int]:
    """Hashes of the block elements that hold text, furniture included."""
    return {signed(n.digest) for n in nodes(root) if n.size and n.tag in BLOCK and n is not root
            and n.tag not in ("head", "title")}


class Page:
    """A parsed page: which elements are furniture, where the article is."""

    def __init__(self, html: str):
        self.root = parse(html)
        marked, furniture = [], set()
        # (element, its path) with the furniture above it; an element above a marked article stays
        todo = [(self.root, None, False, False)]
        parent = {}
        while todo:
            node, above, out, inside = todo.pop()
            parent[id(node)] = above
            attrs = attributes(node)
            mine = is_furniture(node, attrs, inside)
            if mine:
                furniture.add(id(node))
            main = is_marked_main(node, attrs)
            # a reader's comment may be an article element too: then it lies in, or is, furniture
            hard = node.tag in NEVER and node.tag != "form"
            blocked = out or hard or (mine and (main or _reader(attrs)))
            if main and not blocked:
                marked.append(node)
            for k in reversed(node.kids):
                if type(k) is not str:
                    todo.append((k, node, blocked, inside or (main and not blocked)))
        arts = [m for m in marked if m.tag == "article"] or marked
        ids = {id(m) for m in arts}
        self.mains = []
        for m in arts:   # outermost ones only
            up = parent[id(m)]
            while up is not None and id(up) not in ids:
                up = parent[id(up)]
            if up is None:
                self.mains.append(m)
        self.above = set()   # nothing that holds the article is furniture, or a template
        for m in self.mains:
            up = m
            while up is not None and id(up) not in self.above:
                self.above.add(id(up))
                up = parent[id(up)]
        self.furniture = furniture - self.above

    def _left(self, root: Node, frame: set[int]) -> dict[int, int]:
        """Text length below each element without furniture and templates."""
        left, todo = {}, [(root, False)]
        while todo:
            node, done = todo.pop()
            if id(node) in self.furniture or (frame and node is not root and node.tag in BLOCK
                                              and node.size and signed(node.digest) in frame):
                left[id(node)] = 0
            elif done:
                left[id(node)] = sum(len(k.strip()) if type(k) is str else left[id(k)] for k in node.kids)
            else:
                todo.append((node, True))
                todo.extend((k, False) for k in node.kids if type(k) is not str)
        return left

    def densest(self, frame: set[int]) -> list[Node]:
        """The path to the element that holds most of the text, where none is marked as the article."""
        left, path = self._left(self.root, frame), [self.root]
        while True:
            here = left[id(path[-1])]
            for k in path[-1].kids:
                if (type(k) is not str and k.tag in CONTAINERS and left[id(k)] >= DENSE * here > 0
                        and any(type(c) is not str and c.tag in BLOCK for c in k.kids)):
                    path.append(k)
                    break
            else:
                return path

    def text(self, frame: set[int], main: set[int]) -> tuple[str, int]:
        """The main text, and how many subtrees of the page are known as templates of its site."""
        path = [] if self.mains else self.densest(frame)
        mains = self.mains or path[-1:]
        cut: set[int] = set()
        if main:   # templates inside the article, outermost ones
            for m in mains:
                hits, size, todo = [], 0, [k for k in m.kids if type(k) is not str]
                while todo:
                    node = todo.pop()
                    if id(node) in self.furniture or not node.size:
                        continue
                    if node.tag in BLOCK and signed(node.digest) in main:
                        hits.append(id(node))
                        size += node.size
                    else:
                        todo.extend(k for k in node.kids if type(k) is not str)
                if 2 * size < m.size:
                    cut.update(hits)
        if frame:   # templates around the article, outermost ones
            inside, above = {id(m) for m in mains}, {id(n) for n in path}
            todo = [self.root]
            while todo:
                node = todo.pop()
                if id(node) in inside:
                    continue
                if node.size and node.tag in BLOCK and id(node) not in above and signed(node.digest) in frame:
                    cut.add(id(node))
                else:
                    todo.extend(k for k in node.kids if type(k) is not str)

        def drop(node: Node) -> bool:
            return id(node) in self.furniture or id(node) in cut

        if self.mains:
            cut -= self.above
            return " ".join(t for t in (text_of(m, drop) for m in mains) if t), len(cut)
        return text_of(self.root, drop), len(cut)


def _reader(attrs: dict[str, str]) -> bool:
    """Whether an element is about reader comments, related items or the like: no article inside counts.

    The kind must open a name: ``comments-area`` is one, ``has-comments`` is a page that has some.
    """
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()
    return any(m and m.group() in READER for m in map(_NAME.match, names))


def _columns(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), _HOST, 1))
    return pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        host.alias("host"), F.col(f"`{html}`").cast("string").alias("html"))


def subtree_counts(rows: DataFrame) -> DataFrame:
    """(host, node, n): pages of the host that hold the subtree; node 0 counts all its pages."""
    schema = pa.schema([("host", pa.string()), ("node", pa.int64()), ("n", pa.int64())])

    def task(batches):
        for batch in batches:
            counts = defaultdict(Counter)
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = counts[host]
                c[0] += 1
                c.update(subtrees(parse(html)) - {0} if html else ())
            yield pa.RecordBatch.from_arrays([
                pa.array([h for h, c in counts.items() for _ in c], pa.string()),
                pa.array([k for c in counts.values() for k in c], pa.int64()),
                pa.array([n for c in counts.values() for n in c.values()], pa.int64())], schema=schema)

    return (rows.filter("host <> ''").select("host", "html")
            .mapInArrow(task, "host string, node long, n long")
            .groupBy("host", "node").agg(F.sum("n").alias("n")))


def templates(counts: DataFrame, min_frame: int = MIN_FRAME_PAGES, frame_share: float = FRAME_SHARE,
              min_main: int = MIN_MAIN_PAGES, main_share: float = MAIN_SHARE) -> DataFrame:
    """(host, node, in_main): subtrees that recur across many pages of their host."""
    staged = stage_table(counts.filter((F.col("n") >= min_frame) | (F.col("node") == 0)), "subtrees")
    pages = staged.filter("node = 0").select("host", F.col("n").alias("pages"))
    often = (staged.filter("node <> 0").join(pages, "host")
             .filter((F.col("n") >= min_frame) & (F.col("n") >= frame_share * F.col("pages"))))
    return stage_table(often.select("host", "node", (
        (F.col("n") >= min_main) & (F.col("n") >= main_share * F.col("pages"))).alias("in_main")), "templates")


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
                  ("n_templates", pa.int64())])
_OUT_DDL = "page_id long, url string, text string, n_chars long, n_templates long"


class _Out:
    """Rows gathered for one Arrow batch."""

    def __init__(self):
        self.rows, self.bytes = [], 0

    def add(self, page_id, url, html, sites) -> None:
        text, gone = Page(html).text(*sites) if html else ("", 0)
        self.rows.append((page_id, url, text, len(text), gone))
        self.bytes += len(text)

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [()] * 5
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)
        self.rows, self.bytes = [], 0
        return out


_NONE = (frozenset(), frozenset())


def _with_broadcast(rows: DataFrame, found: DataFrame) -> DataFrame:
    frame, main = defaultdict(set), defaultdict(set)
    for r in found.toLocalIterator():   # at most BROADCAST_ROWS
        frame[r.host].add(r.node)
        if r.in_main:
            main[r.host].add(r.node)
    sent = rows.sparkSession.sparkContext.broadcast({h: (s, main.get(h, frozenset())) for h, s in frame.items()})

    def task(batches):
        out, sites = _Out(), sent.value
        for batch in batches:
            for page_id, url, host, html in zip(*(c.to_pylist() for c in batch.columns)):
                out.add(page_id, url, html, sites.get(host, _NONE))
                if out.bytes > OUT_BYTES:
                    yield out.batch()
            yield out.batch()

    return rows.mapInArrow(task, _OUT_DDL)


def _with_shuffle(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Pages and their host's templates meet in (host, salt) partitions, templates first."""
    lists = (found.groupBy("host").agg(F.collect_list("node").alias("frame"), F.collect_list(
        F.when(F.col("in_main"), F.col("node"))).alias("main"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    none = F.lit(None)
    both = (lists.select("host", "salt", F.lit(0).alias("kind"), none.cast("long").alias("page_id"),
                         none.cast("string").alias("url"), none.cast("string").alias("html"), "frame", "main")
            .unionByName(rows.select("host", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("salt"),
                                     F.lit(1).alias("kind"), "page_id", "url", "html",
                                     none.cast("array<long>").alias("frame"), none.cast("array<long>").alias("main"))))

    def task(batches):
        out, at, sites = _Out(), None, _NONE
        for batch in batches:
            for host, _, kind, page_id, url, html, frame, main in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    at, sites = host, (set(frame), set(main))
                    continue
                out.add(page_id, url, html, sites if host == at else _NONE)
                if out.bytes > OUT_BYTES:
                    yield out.batch()
            yield out.batch()

    return (both.repartition("host", "salt").sortWithinPartitions("host", "salt", "kind")
            .mapInArrow(task, _OUT_DDL))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            broadcast_rows: int = BROADCAST_ROWS, **limits) -> DataFrame:
    """(page_id, url, text, n_chars, n_templates) of every page.

    ``limits`` are those of ``templates``; ``n_templates`` counts the subtrees of
    the page that were known as templates of its host.
    """
    rows = _columns(pages, page_id, url, html)
    found = templates(subtree_counts(rows), **limits)
    if fits(found, broadcast_rows):
        return _with_broadcast(rows, found)
    return _with_shuffle(rows, found)
