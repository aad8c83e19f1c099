"""HTML extraction with a site style tree.

The DOMs of a host's pages are merged: an element stands for its path of tags
with class and id, and the merged tree counts on how many pages a path occurs.

* Presentation importance of a path with m pages: the entropy (base m, ``STYLES`` at
  most) of the styles it shows, 1 at most.  A page's style of a path is how many such elements it has, their
  child sequences and the magnitude of their text (``MAGNITUDE``).  One page: 1.
* Content importance of a text-bearing path: 1 minus the mean log_m of the number
  of pages its texts occur on; a text on every page gives 0.
* An element's importance mixes its presentation with its children's importance
  (``GAMMA`` to the children), bottom up in the host's tree.  Inline elements and other
  children without text of their own have no say.

Two mixtures are used.  With nearly all weight on content (``GAMMA``, ``LOW``) a branch
is low if it says the same on most pages; such branches go everywhere.  With equal
weights (``EVEN``, ``UNIFORM``) it is also low if its words differ but always come in
one shape: menus, notices, footers.  Where no article is marked, such lists go
(``SEVERAL`` texts of one path); without marks at all, all that is uniform goes.  A
heading has its container's importance there.

Before that, each element has a prior from its own mark-up: menus, page headers,
footers, sidebars, adverts, notices, forms, scripts, styles and comments have none.
Branches whose every element is below ``LOW`` are removed from each page, and the
text of the remaining blocks is the main text.  Where a page marks its article,
what stands outside goes too, and an article whose own branch is low keeps its text,
because copies of an article on one host are still an article.  If important text
outside is longer than all marked text, the marks mean something else (teasers),
and the statistics decide alone.  A form or a name such as menu above an article or
main part (or, on a page without other text, above an important branch) shuts it out
only where a page has another article or more text elsewhere.

Pages are parsed twice; between the passes only path statistics move: one row
per (host, path, feature), combined in the task first, and for the second pass
a list of removed and one of important paths a host.  Hot hosts spread by feature.

Cases: null or empty html gives an empty text; a null or hostless url has a tree
of its own page only (nothing removed by statistics); cut-off or wrongly nested
mark-up is closed as a browser would, roughly; if statistics would remove all
text of a page, they remove nothing there; repeated rows are extracted each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stored, table

GAMMA = 0.9
LOW = 0.3
EVEN = 0.5
UNIFORM = 0.72
SEVERAL = 3
#: So many equally frequent styles are full diversity, however many pages a host has.
STYLES = 16
#: Texts of a path on a page are of one magnitude up to this factor in their number of words.
MAGNITUDE = 16
#: Content importance from which on a text outside the marked article counts as important.
HIGH = 0.5
#: Pages of a host that a path must stand on before statistics may remove it; a rarer one has importance 1.
ENOUGH = 4

#: Element names by role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead tr ul video audio canvas".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
NO_TEXT = frozenset("nav footer aside form head script style textarea title noscript template iframe svg math button select "
                    "dialog menu object audio video canvas datalist label input".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NO_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe subscription paywall signup login social share sharing related recommended comments comment commentlist "
    "disqus respond reply replies pagination pager toolbar widget skip".split())
#: Of these, other people's words and adverts: an article inside them is no article of the page.
FOREIGN_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion related recommended comments comment "
    "commentlist disqus respond reply replies".split())
ARTICLE_NAMES = frozenset("article-body articlebody article-content post-content post-body entry-content story-body".split())
#: Start tags that end an open element of these names first.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody")}
#: Elements that an implied end does not reach through.
HOLDS = frozenset("html body div article section main aside nav header footer form table td th ul ol dl blockquote figure".split())

#: A quote only counts after an equals sign, as in browsers; what is cut off at the end is no text.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z0-9_-]+")


class Element:
    """prior: may hold text by its mark-up; rank: 2 in an article, 1 in a main part; low: in a removed branch; flat: in
    one of uniform shape;
    spared: in an article or main part that is low as a whole; rated: in an important branch.
    shut: without a prior for good; opened: without one only by a form or a name above, and since then 2 in an
    article or main part, 1 in an important branch."""

    __slots__ = ("tag", "path", "parent", "prior", "rank", "low", "flat", "spared", "rated", "shut", "opened", "children")

    def __init__(self, tag, path, parent, prior, rank, low, flat, spared, rated, shut, opened):
        self.tag, self.path, self.parent, self.prior, self.rank, self.low = tag, path, parent, prior, rank, low
        self.flat = flat
        self.spared, self.rated, self.shut, self.opened = spared, rated, shut, opened
        self.children: list[str] = []


def _names(values: str) -> list[str]:
    return _NAME.findall(values.lower())


def _label(tag: str, attributes: str) -> tuple[str, frozenset, str]:
    """(tag with class and id, names in class and id, role)."""
    if not attributes or "=" not in attributes:
        return tag, frozenset(), ""
    found = {m.group(1).lower(): m.group(2) or m.group(3) or m.group(4) or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = _names(found.get("class", "")) + _names(found.get("id", ""))
    if found.get("itemprop", "").lower() == "articlebody":
        names.append("articlebody")
    return ".".join([tag, *sorted(names)]), frozenset(names), found.get("role", "").lower()


class Page:
    """One walk over a page: text blocks with their element, and every element's child sequence.
    Without ``marks``, names of elements, classes and roles say nothing."""

    def __init__(self, html: str, removed: frozenset = frozenset(), rated: frozenset = frozenset(),
                 uniform: frozenset = frozenset(), marks: bool = True):
        self.blocks: list[tuple[Element, str]] = []
        self.elements: list[Element] = []
        self._removed, self._rated, self._uniform, self._marks = removed, rated, uniform, marks
        self._stack = [Element("", 0, 0, True, 0, False, False, False, False, False, 0)]
        # Places in the stack by tag and of block elements, so that no tag walks over all open elements.
        self._places: dict[str, list[int]] = {}
        self._open_blocks: list[int] = [0]
        self._text: list[str] = []
        self._walk(html)

    def _flush(self) -> None:
        if self._text:
            words = unescape("".join(self._text)).split()
            self._text = []
            if words:
                self.blocks.append((self._block(), " ".join(words)))

    def _block(self) -> Element:
        return self._stack[self._open_blocks[-1]]

    def _open(self, tag: str, attributes: str) -> Element:
        label, names, role = _label(tag, attributes)
        parent = self._stack[-1]
        path = xxhash.xxh64_intdigest(label, parent.path) >> 1
        rank = parent.rank
        if not self._marks:
            names, role = frozenset(), ""
        elif tag == "article" or role == "article" or names & ARTICLE_NAMES:
            rank = 2
        elif rank == 0 and (tag == "main" or role == "main"):
            rank = 1
        kept_out = self._marks and (tag in NO_TEXT and tag != "form") or (role in NO_TEXT_ROLES and role != "form") \
            or bool(names & FOREIGN_NAMES) or (self._marks and tag == "header" and rank == 0)
        closed = kept_out or (self._marks and tag == "form") or role == "form" or bool(names & NO_TEXT_NAMES)
        shut = parent.shut or kept_out
        low = parent.low or path in self._removed
        flat = parent.flat or (path in self._uniform and tag not in HEADINGS)
        spared = low if rank > parent.rank else parent.spared
        rated = not low and (parent.rated or path in self._rated)
        opened = 0
        if not closed and not shut and not parent.prior:
            opened = 2 if rank > parent.rank == 0 else parent.opened or int(path in self._rated)
        element = Element(tag, path, parent.path, parent.prior and not closed, rank, low, flat, spared, rated, shut, opened)
        parent.children.append(label)
        self.elements.append(element)
        return element

    def _push(self, element: Element) -> None:
        self._places.setdefault(element.tag, []).append(len(self._stack))
        if element.tag in BLOCK:
            self._open_blocks.append(len(self._stack))
        self._stack.append(element)

    def _close(self, keep: int) -> None:
        for element in self._stack[keep:]:
            self._places[element.tag].pop()
        while self._open_blocks[-1] >= keep:
            self._open_blocks.pop()
        del self._stack[keep:]

    def _implied_end(self, tag: str) -> int | None:
        """The lowest open element that a start of ``tag`` ends: a p or one of its ``ENDS`` above what holds them."""
        ends = ("p", *ENDS.get(tag, ()))
        hold = max((at[-1] for name in HOLDS if name not in ends and (at := self._places.get(name))), default=0)
        found = [at[k] for name in ends if (at := self._places.get(name)) and (k := bisect_right(at, hold)) < len(at)]
        return min(found, default=None)

    def _walk(self, html: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(html, at)
            if not m:
                self._text.append(html[at:])
                break
            if m.start() > at:
                self._text.append(html[at:m.start()])
            at = m.end()
            tag = (m.group(2) or "").lower()
            if not tag:
                continue
            if m.group(1):
                if tag == "br":
                    self._text.append(" ")
                    continue
                places = self._places.get(tag)
                if places:
                    if self._open_blocks[-1] >= places[-1]:
                        self._flush()
                    self._close(places[-1])
                continue
            if tag in VOID:
                if tag in BLOCK:
                    self._flush()
                else:
                    self._text.append(" " if tag in ("br", "wbr") else "")
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            if tag in BLOCK:
                self._flush()
                ended = self._implied_end(tag)
                if ended is not None:
                    self._close(ended)
            self._push(self._open(tag, m.group(3)))
            if m.group(3).endswith("/") and tag not in BLOCK:
                self._close(len(self._stack) - 1)
        self._flush()

    def text(self) -> str:
        """The blocks of the main text in page order."""
        allowed = [b for b in self.blocks if b[0].prior]
        kept = self._main(allowed)
        # An article that a form or a name above it shut, on a page without another and longer than the rest.
        opened = [b for b in self.blocks if b[0].opened == 2]
        if not opened and not kept:
            opened = [b for b in self.blocks if b[0].opened]
        if all(e.rank == 0 for e, _ in allowed) and _length(opened) > _length(allowed):
            chosen = {id(b) for b in kept + self._main(opened)}
            kept = [b for b in self.blocks if id(b) in chosen]
        return "\n".join(t for _, t in kept)

    def _main(self, blocks: list[tuple[Element, str]]) -> list[tuple[Element, str]]:
        rank = max((e.rank for e, _ in blocks), default=0)
        marked = [b for b in blocks if b[0].rank >= rank]
        if rank and _length(marked) >= _length([b for b in blocks if b[0].rank < rank and b[0].rated]):
            important = [b for b in marked if b[0].spared or not b[0].low]
            return important if any(e.tag not in HEADINGS for e, _ in important) else marked
        lively = [b for b in blocks if not b[0].low] or blocks
        if not self._marks:
            return [b for b in lively if not b[0].flat] or lively
        lists = self._lists()
        lists = [b for b in lively if b[0].path in lists]
        # A list longer than the rest of the page is its text.
        if not lists or 2 * _length(lists) > _length(lively):
            return lively
        out = {id(b) for b in lists}
        return [b for b in lively if id(b) not in out]

    def _lists(self) -> set[int]:
        """Paths of uniform shape with several texts on this page; a single line of one shape may be a date or a byline."""
        count: dict[int, int] = {}
        for element, _ in self.blocks:
            count[element.path] = count.get(element.path, 0) + element.flat
        return {path for path, n in count.items() if n >= SEVERAL}

    def styles(self) -> dict[int, str]:
        """Path -> its style on this page."""
        words: dict[int, int] = {}
        for element, text in self.blocks:
            words[element.path] = words.get(element.path, 0) + text.count(" ") + 1
        shapes: dict[int, list[str]] = {}
        for element in self.elements:
            shapes.setdefault(element.path, []).append(" ".join(element.children))
        size = lambda path: int(log(words[path], MAGNITUDE)) if path in words else -1
        return {path: "\n".join([str(len(of)), str(size(path)), *sorted(set(of))]) for path, of in shapes.items()}


def _length(blocks: list[tuple[Element, str]]) -> int:
    return sum(len(t) for _, t in blocks)


def with_host(pages: DataFrame, *columns: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(*columns, host.alias("host"))


def tree(pages: DataFrame) -> DataFrame:
    """The merged tree: (host, path, parent, pages, presentation, content, own) of paths on ``ENOUGH`` pages.
    ``own``: pages times rarer children that hold text; they count in their parent's importance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple, int] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not html:
                    continue
                page = Page(html)
                # A feature counts once a page, whatever number of elements show it.
                above = {e.path: e.parent for e in page.elements}
                full: set[int] = set()  # branches that hold text
                for path in {e.path for e, _ in page.blocks if e.prior or e.opened}:
                    while path in above and path not in full:
                        full.add(path)
                        path = above[path]
                seen = {(host, path, 3 if path in full else 2, parent) for path, parent in above.items()}
                seen |= {(host, path, 0, xxhash.xxh64_intdigest(style) >> 1) for path, style in page.styles().items()}
                seen |= {(host, e.path, 1, xxhash.xxh64_intdigest(text) >> 1) for e, text in page.blocks}
                for key in seen:
                    counts[key] = counts.get(key, 0) + 1
            cols = list(zip(*counts)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.int64()), pa.array(list(counts.values()), pa.int64())],
                ["host", "path", "kind", "feature", "n"])

    found = with_host(pages, "html", "url").where("host <> ''").select("host", "html").mapInArrow(
        run, "host string, path long, kind int, feature long, n long")
    features = found.groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n"))
    n_log = F.col("n") * F.log("n")
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
    element = F.col("kind") >= 2
    stats = features.groupBy("host", "path").agg(
        F.sum(F.when(element, F.col("n"))).alias("pages"), F.max(F.when(element, F.col("feature"))).alias("parent"),
        of(3, F.col("n")).alias("full"), of(0, F.col("n")).alias("shown"), of(0, n_log).alias("shown_log"),
        of(1, F.col("n")).alias("said"), of(1, n_log).alias("said_log"))
    # A rare path only leaves its pages with its parent: once more a sum, combined in the task.
    often = F.col("pages") >= ENOUGH
    numbers = ["parent", "pages", "shown", "shown_log", "said", "said_log"]
    stats = stats.where(often | F.col("full").isNotNull()).select(
        "host", F.when(often, F.col("path")).otherwise(F.col("parent")).alias("path"),
        *[F.when(often, F.col(c)).alias(c) for c in numbers], F.when(~often, F.col("full")).alias("own"))
    stats = stats.groupBy("host", "path").agg(*[F.max(c).alias(c) for c in numbers], F.coalesce(
        F.sum("own"), F.lit(0)).alias("own")).where("pages IS NOT NULL")
    # Entropy of n_i / N is log N - sum(n_i log n_i) / N.
    base = F.log("pages")
    shown = (F.log("shown") - F.col("shown_log") / F.col("shown")) / F.least(base, F.log(F.lit(float(STYLES))))
    said = 1 - (F.col("said_log") / F.col("said")) / base
    return stats.select("host", "path", "parent", "pages", F.least(shown, F.lit(1.0)).alias("presentation"),
                        F.when(said.isNotNull(), F.greatest(said, F.lit(0.0))).alias("content"), "own")


def importances(rows: pd.DataFrame, gamma: float = GAMMA) -> pd.Series:
    """Of one host's paths, children before parents: the largest composite importance in the branch.
    Children on too few pages (``own``, none if the column is missing) have importance 1."""
    at = {p: i for i, p in enumerate(rows["path"])}
    below: dict[int, list[int]] = {}
    depth = {}

    def level(path) -> int:
        trail = []
        while path in at and path not in depth:
            trail.append(path)
            path = rows["parent"].iat[at[path]]
        d = depth.get(path, -1)
        for p in reversed(trail):
            d += 1
            depth[p] = d
        return d

    for p, parent in zip(rows["path"], rows["parent"]):
        level(p)
        below.setdefault(parent, []).append(at[p])
    out, branch, text = np.ones(len(rows)), np.zeros(len(rows)), np.zeros(len(rows), bool)
    pages, shown, said = (rows[c].to_numpy(float) for c in ("pages", "presentation", "content"))
    own = rows["own"].to_numpy(float) if "own" in rows else np.zeros(len(rows))
    for p in sorted(at, key=lambda p: -depth[p]):
        i = at[p]
        parts = [(pages[j], out[j]) for j in below.get(p, []) if text[j]]
        if not np.isnan(said[i]):
            parts.append((pages[i], said[i]))
        if own[i]:
            parts.append((own[i], 1.0))
        text[i] = bool(parts)
        if parts:
            weight = sum(w for w, _ in parts)
            out[i] = (1 - gamma) * shown[i] + gamma * sum(w * x for w, x in parts) / weight
            branch[i] = max([out[i], float(own[i] > 0), *(branch[j] for j in below.get(p, []))])
    return pd.Series(branch, rows.index)


def rated_paths(pages: DataFrame, low: float = LOW) -> DataFrame:
    """(host, paths, rated, uniform): the paths of a host whose whole branch is below ``low``, those that hold
    important text themselves or in page-own children, and those whose branch is uniform."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        removed = importances(rows) < low
        rated = ~removed & ((rows["content"] >= HIGH) | (rows["own"] > 0))
        return pd.DataFrame({"host": [rows["host"].iat[0]], "paths": [rows["path"][removed].tolist()],
                             "rated": [rows["path"][rated].tolist()],
                             "uniform": [rows["path"][importances(rows, EVEN) < UNIFORM].tolist()]})

    # A group is a host's tree of paths on several pages: templates, not pages.
    return tree(pages).groupBy("host").applyInPandas(run, "host string, paths array<long>, rated array<long>, uniform array<long>").where(
        F.size("paths") + F.size("rated") + F.size("uniform") > 0)


def extracted(pages: DataFrame, low: float = LOW, marks: bool = True) -> DataFrame:
    """page_id, url, text of every page. Without ``marks``, the style tree decides alone."""
    found = stored(rated_paths(pages, low), "style-tree")
    asked = with_host(pages, "page_id", "url", "html").join(found, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: dict[str, list[frozenset]] = {}  # read once a host, not once a page
            texts = []
            for i, (host, html) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if host not in lists:
                    lists[host] = [frozenset(batch.column(k)[i].as_py() or ()) for k in (4, 5, 6)]
                texts.append(Page(html, *lists[host], marks).text() if html else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    return asked.select(F.col("page_id").cast("long"), "url", "host", "html", "paths", "rated", "uniform").mapInArrow(
        run, "page_id long, url string, text string")


def op3_html(spark, sf_dir) -> DataFrame:
    """Main text of every row of ``pages``."""
    return extracted(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
