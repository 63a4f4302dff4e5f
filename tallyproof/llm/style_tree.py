"""Main-text extraction with a site style tree.

All pages of a host are merged into one tree of element paths (tags with their
classes and ids).  A path's presentation importance is the entropy of the
child layouts it has among its pages; its content importance is one minus the
mean entropy, over those pages, of the text blocks at most ``LEVELS`` levels below it: a block that every
page repeats tells nothing.  Both are mixed as 1 - g^s to g^s for s layouts
(g = 0.9).  Branches of low importance, whatever their names, are cut from each page; the
bar is higher outside of articles, where all stories of a site rarely repeat each other.

The tree is only ever held as counts of (host, path, feature), summed where
pages are read before they are shuffled, so a host with a third of all pages is
as many small rows as any other.  Of the finished tree only the paths to be cut
are kept; they are broadcast if there are at most ``broadcast_paths`` of them,
and joined to the pages by host otherwise.

A site with few pages has no tree to speak of, and a menu may differ from page to
page, so a check follows that needs one page only.  Elements that are no text
by what HTML says of them (scripts, forms, nav, aside, footer, roles of the like, hidden ones)
go; if a page has an article or main element, what lies outside of it is not part of the text.
A class or id that as a whole is one of a few names (``ad``, ``comments``) is a prior:
such a branch goes unless it is an article or main element, holds nine tenths of the page's text
(of the articles, if there are any) or, in an article, its h1.  Parts of names say nothing.

Defined results: null or empty html gives an empty text; a null url is a host
of its own; character references are decoded; white space inside a block is
one space, blocks are joined by a line feed; unclosed elements end with their
parent, unclosed comments and tags with the page; if all that the check keeps were of low importance, it
stays.  Repeated pages count as often as they are there; an empty table gives no rows; ties don't
matter; columns other than the three are left out, whatever their names.  Time grows with
the length of a page, however deeply it is nested.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.storage import checkpointed, lean, stored

GAMMA = 0.9
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Kinds of elements.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote address li dt dd tr td th caption figcaption summary option".split())
NOISE_TAGS = frozenset("head nav footer aside form script style noscript template button select input textarea iframe object embed canvas svg audio video dialog menu map datalist".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar status".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion nav navbar navigation menu menubar submenu topbar toolbar breadcrumb breadcrumbs sidebar side aside rail footer foot masthead header "
    "notice notices cookie cookies consent gdpr alert popup modal overlay comment comments commentlist reply replies respond disqus share sharing social related recommended subscribe newsletter signup login search pagination pager widget widgets tags legal copyright disclaimer".split()
)
MAIN_NAMES = frozenset(["articlebody"])
#: Inside an article these name its own title, as the header element does.
TITLE_NAMES = frozenset(["header"])
#: The share of a page's text from which a class or id doesn't cut.
NAME_SHARE = 0.9
#: How many levels below a branch its text is counted.
LEVELS = 8
_NAME = re.compile(r"[a-z]+")
_TAG = re.compile(r"<[^>]*>")
_ARTICLE = re.compile(r"<(?:article|main|h1)\b|\barticlebody\b", re.I)


class Bare:
    """How much of a source is not tags, and where its articles begin."""

    def __init__(self, source: str) -> None:
        self.ends, self.tags = [0], [0]
        for m in _TAG.finditer(source):
            self.ends.append(m.end())
            self.tags.append(self.tags[-1] + m.end() - m.start())
        self.articles = [m.start() for m in _ARTICLE.finditer(source)]

    def size(self, a: int, b: int) -> int:
        """From one end of a tag, or of the source, to another."""
        return b - a - self.tags[bisect_right(self.ends, b) - 1] + self.tags[bisect_right(self.ends, a) - 1]

    def holds_article(self, a: int, b: int) -> bool:
        return bisect_left(self.articles, a) < bisect_left(self.articles, b)


class Page:
    """One pass over a page: its blocks with the branch each lies in, and each branch's parent and child layout."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[str, int]] = []  # text, innermost branch or -1
        self.paths: list[int] = []  # branch number -> path
        self.parent: list[int] = []  # a branch's parent has a lesser number
        self.noise: list[bool] = []
        self.named: set[int] = set()  # branches with a noise name
        self.headings: set[int] = set()
        self.main: list[bool] = []
        self.inside: list[bool] = []  # in a main branch
        self.children: list[list[str]] = []
        self.stack: list[tuple[str, int]] = []  # tag, branch number
        self.open: dict[str, int] = {}
        self.words: list[str] = []
        self.read(source)
        self.judge_names()

    def flush(self) -> None:
        if self.words:
            text = " ".join(html.unescape("".join(self.words)).split())
            self.words = []
            if text:
                self.blocks.append((text, self.stack[-1][1] if self.stack else -1))

    def push(self, tag: str, attributes: str) -> None:
        names, role, gone, main = "", "", False, tag in ("article", "main")
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                k, v = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if k in ("class", "id"):
                    names += f" {v}"
                elif k == "role":
                    role = v.strip()
                elif k == "itemprop":
                    main = main or v in MAIN_NAMES
                elif k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v):
                    gone = True
        over = self.stack[-1][1] if self.stack else -1
        main = main or role == "main"
        inside = over >= 0 and (self.inside[over] or self.main[over])
        noise = gone or tag in NOISE_TAGS or role in NOISE_ROLES or tag == "header" and not inside
        label = tag
        if names:
            label = f"{tag}.{'.'.join(sorted(set(_NAME.findall(names))))}"
            if not main and tag not in ("html", "body"):
                bad = NOISE_NAMES.intersection(names.split())
                if bad and not (inside and bad <= TITLE_NAMES):
                    self.named.add(len(self.paths))
        if tag == "h1":
            self.headings.add(len(self.paths))
        if over >= 0:
            self.children[over].append(label)
        path = hashlib.blake2b(f"{self.paths[over] if over >= 0 else ''}/{label}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
        self.stack.append((tag, len(self.paths)))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.paths.append(int.from_bytes(path, "little", signed=True))
        self.parent.append(over)
        self.noise.append(noise)
        self.main.append(main and not noise)
        self.inside.append(inside)
        self.children.append([])

    def drop(self) -> None:
        self.open[self.stack.pop()[0]] -= 1

    def pop(self, tag: str) -> None:
        if self.open.get(tag):
            while self.stack[-1][0] != tag:
                self.drop()
            self.drop()

    def read(self, source: str) -> None:
        at, n, bare = 0, len(source), None
        pairs: dict[str, dict[int, int]] = {}
        while at < n:
            m = _TOKEN.search(source, at)
            if m is None:
                self.words.append(source[at:])
                break
            if m.start() > at:
                self.words.append(source[at : m.start()])
            at = m.end()
            group = 2 if m[2] else 5 if m[5] else 0
            if not group:
                continue
            tag = m[group].lower()
            if m[group - 1]:  # an end tag
                if tag not in INLINE:
                    self.flush()
                    self.pop(tag)
                elif self.open.get(tag):
                    self.flush()
                    self.pop(tag)
                continue
            attributes = m[group + 1]
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else n
                continue
            if tag in VOID:
                if tag == "br":
                    self.words.append(" ")
                elif tag == "hr":
                    self.flush()
                continue
            if tag in INLINE:
                if attributes and ("class" in attributes or "hidden" in attributes or "style" in attributes or "role" in attributes or "id" in attributes):
                    depth = len(self.paths)
                    held = self.words
                    self.push(tag, attributes)
                    named, end = depth in self.named, at
                    self.named.discard(depth)
                    if named and not self.noise[depth]:  # it has no blocks of its own, so its source is measured
                        end = self.skip(source, at, tag, pairs)
                        bare = bare or Bare(source)
                        self.noise[depth] = 2 * bare.size(at, end) < bare.size(0, n) and not bare.holds_article(at, end)
                    if self.noise[depth]:  # a branch of its own; text before it stays one block with what follows only if nothing is cut
                        self.drop()
                        self.words = held
                        at = self.skip(source, at, tag, pairs)
                    else:
                        self.drop()
                continue
            self.flush()
            if tag == "body":
                self.pop("head")
            while self.stack and self.stack[-1][0] in PARAGRAPHS and (self.stack[-1][0] == "p" or self.stack[-1][0] == tag or tag in ("dt", "dd") and self.stack[-1][0] in ("dt", "dd") or tag in ("td", "th") and self.stack[-1][0] in ("td", "th") or tag == "tr" and self.stack[-1][0] in ("td", "th")):
                self.drop()
            self.push(tag, attributes)
            if attributes.endswith("/") and tag not in PARAGRAPHS and tag in NOISE_TAGS:
                self.drop()
        self.flush()

    def down(self, own: list[bool]) -> list[bool]:
        """Of each branch, whether it or one above is marked; of no branch (-1) it is not."""
        out: list[bool] = []
        for mark, over in zip(own, self.parent):
            out.append(mark or over >= 0 and out[over])
        return [*out, False]

    def judge_names(self) -> None:
        """Make noise of the branches with a noise name, but for those that hold most of the text or an article's h1."""
        if not self.named:
            return
        noise = self.down(self.noise)
        inside = [m or i for m, i in zip(self.main, self.inside)] + [False]
        seen = [(text, b) for text, b in self.blocks if not noise[b]]
        seen = [x for x in seen if inside[x[1]]] or seen
        held = [0] * len(self.paths)
        title = [False] * len(self.paths)
        for text, b in seen:
            if b >= 0:
                held[b] += len(text)
                title[b] = inside[b] and b in self.headings
        for b in range(len(self.paths) - 1, -1, -1):
            if (over := self.parent[b]) >= 0:
                held[over] += held[b]
                title[over] = title[over] or title[b]
        of_path: dict[int, int] = {}  # branches of one path count together
        for b in self.named:
            of_path[self.paths[b]] = of_path.get(self.paths[b], 0) + held[b]
        total = sum(len(text) for text, _ in seen)
        for b in self.named:
            if not title[b] and (not of_path[self.paths[b]] or of_path[self.paths[b]] < NAME_SHARE * total):
                self.noise[b] = True

    @staticmethod
    def skip(source: str, at: int, tag: str, pairs: dict[str, dict[int, int]]) -> int:
        """Past the end tag of an inline branch that is cut; if it has none, past its opening tag only."""
        if tag not in pairs:
            found, waiting = pairs.setdefault(tag, {}), []
            for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(source):
                if not m[1]:
                    waiting.append(m.end())
                elif waiting:
                    found[waiting.pop()] = m.end()
        return pairs[tag].get(at, at)

    def votes(self) -> Iterator[tuple[int, int, bool, bool]]:
        """(path, feature, is it text, is it in an article) of all branches but articles and what holds them, each once a page."""
        may = [not m for m in self.main]
        for b in range(len(may) - 1, -1, -1):
            if not may[b] and self.parent[b] >= 0 and not self.inside[b]:
                may[self.parent[b]] = False
        features: set[tuple[int, int]] = set()
        for text, b in self.blocks:
            digest = _digest(text)
            for _ in range(LEVELS):
                if b < 0:
                    break
                if may[b]:
                    features.add((self.paths[b], digest))
                b = self.parent[b]
        styles: dict[int, set[str]] = {}
        with_text = {p for p, _ in features}
        inside = {}
        for b, path in enumerate(self.paths):
            if may[b] and path in with_text:
                inside[path] = self.inside[b]
                styles.setdefault(path, set()).add(",".join(dict.fromkeys(self.children[b])))
        for path, layouts in styles.items():
            yield path, _digest("|".join(sorted(layouts))), False, inside[path]
        for path, digest in features:
            yield path, digest, True, inside[path]

    def low(self, cut: frozenset[int] | set[int]) -> list[bool]:
        """Whether each branch lies in one that is cut; an article is not cut with what is around it."""
        out: list[bool] = []
        for path, main, over in zip(self.paths, self.main, self.parent):
            out.append(not main and (path in cut or over >= 0 and out[over]))
        return [*out, False]

    def text(self, cut: frozenset[int] | set[int]) -> str:
        """Blocks in no branch that is cut, and in no noise; within articles, if there are any."""
        low, noise = self.low(cut), self.down(self.noise)
        inside = [m or i for m, i in zip(self.main, self.inside)] + [False]
        kept = [(text, b) for text, b in self.blocks if not noise[b]]
        kept = [x for x in kept if inside[x[1]]] or kept
        return "\n".join([t for t, b in kept if not low[b]] or [t for t, _ in kept])


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url: Column) -> Column:
    """What stands between the slashes and the path, in lower case, without a user; empty if there is none."""
    place = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_extract(place, r"([^@]*)$", 1))


def low_branches(pages: DataFrame, url: str = "url", source: str = "html", least_pages: int = 4, threshold: float = 0.25, outside: float = 0.7) -> DataFrame:
    """(host, path, importance) of the branches whose importance over at least ``least_pages`` pages is under ``threshold`` in articles, under ``outside`` elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, features, texts, insides = [], [], [], [], []
            for host, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for path, feature, is_text, inside in Page(h).votes() if h else ():
                    hosts.append(host)
                    paths.append(path)
                    features.append(feature)
                    texts.append(is_text)
                    insides.append(inside)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(features, pa.int64()), pa.array(texts, pa.bool_()), pa.array(insides, pa.bool_())], ["host", "path", "feature", "is_text", "inside"])

    votes = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{source}`").alias("html")).mapInArrow(lean(run), "host string, path long, feature long, is_text boolean, inside boolean")
    counted = votes.groupBy("host", "path", "is_text", "feature").agg(F.count(F.lit(1)).alias("n"), F.max("inside").alias("inside"))
    style, n = ~F.col("is_text"), F.col("n").cast("double")
    sums = counted.groupBy("host", "path").agg(
        F.sum(F.when(style, n)).alias("m"),
        F.count(F.when(style, n)).alias("layouts"),
        F.sum(F.when(style, n * F.log(n))).alias("spread"),
        F.count(F.when(~style, n)).alias("blocks"),
        F.sum(F.when(~style, F.log(n))).alias("shared"),
        F.max("inside").alias("inside"),
    )
    rated = sums.filter((F.col("m") >= least_pages) & (F.col("blocks") > 0))
    shown = 1 - F.col("spread") / (F.col("m") * F.log("m"))
    told = 1 - F.col("shared") / (F.col("blocks") * F.log("m"))
    weight = F.pow(F.lit(GAMMA), F.col("layouts"))
    rated = rated.select("host", "path", "inside", F.round((1 - weight) * shown + weight * told, 9).alias("importance"))
    return rated.filter(F.col("importance") < F.when(F.col("inside"), threshold).otherwise(outside)).drop("inside")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", broadcast_paths: int = 200_000, least_pages: int = 4, threshold: float = 0.25, outside: float = 0.7) -> DataFrame:
    """One row per page: key, url, text and n_chars."""
    low = checkpointed(low_branches(pages, url, source, least_pages, threshold, outside).select("host", "path"))
    kind = pages.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, url string, text string, n_chars long"
    rows = pages.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").alias("url"), F.col(f"`{source}`").alias("html"), host_of(F.col(f"`{url}`")).alias("host"))

    def table(part: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [key, "url", "text", "n_chars"])

    if len(some := low.limit(broadcast_paths + 1).collect()) <= broadcast_paths:
        cut: dict[str, set[int]] = {}
        for r in some:
            cut.setdefault(r["host"], set()).add(r["path"])
        shared = pages.sparkSession.sparkContext.broadcast(cut)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by_host, none = shared.value, frozenset()
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    yield table(part, [Page(h).text(by_host.get(host, none)) if h else "" for host, h in zip(part.column(3).to_pylist(), part.column(2).to_pylist())])

        return rows.mapInArrow(lean(run), schema)

    by_host = stored(low.groupBy("host").agg(F.collect_set("path").alias("paths")), "branches")  # stored, so that a large host's pages can be split
    joined = rows.join(by_host, "host", "left").select("_key", "url", "html", "paths")

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield table(part, [Page(h).text(set(p or ())) if h else "" for h, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist())])

    return joined.mapInArrow(lean(run_joined), schema)
