"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: an element node is the path of presentations (name, class words, id, role) that leads to it,
and its style nodes are the different sequences of children it has. From how the host's pages spread over the style
nodes and over the contents of a node follow two measures, both entropies scaled to 0 to 1:

* a node's presentation matters if its style nodes vary: the entropy of the shares of its style nodes;
* a node's content matters if it is not the same on all pages: 1 less the mean, over its different texts and references, of the entropy
  of the pages each is on.

In a page, the composite importance of a branch weighs the presentation of its root against the mean of its children (the more children, the more the root's
presentation counts), down to contents at the leaves. A branch is removed if neither it nor a branch in it reaches ``LOW``. Where presentation itself says what a branch is
for (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments by element, role or class words, and all beside the
article on a page that marks one), its importance is 0 whatever its content: on a host of few pages entropies say nothing, and adverts may
differ from page to page. If entropies would leave nothing of a page, only presentation counts.

No tree is held anywhere. Tasks emit counts by node, style and content, which are added before and after one shuffle; a host's importances are
those of nodes on at least ``LEAST_PAGES`` of its pages and ``LEAST_SHARE`` of them, so at most (elements of a page) / ``LEAST_SHARE`` numbers per host. Other nodes have importance 1.
The importances are joined to the pages, broadcast only up to a checked size.

NULL html counts as empty: no text. Pages whose url has no host count as one site. Equal rows are extracted each and
all count. An empty table gives no rows. Other columns are ignored. Elements nested deeper than 512 count as part of those they are in.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import by_task, load, materialised, ready
from wearline.llm.html_tree import BLOCK, RAW, Page, parse

LEAST_PAGES = 5
LEAST_SHARE = 0.01
# Of a presentation against the children: a root with n children weighs 1 - DAMPING ** n.
DAMPING = 0.9
LOW = 0.3
# Counts that a task holds before it sends them on, and numbers of importances that may be broadcast.
HELD = 200_000
BROADCAST_NUMBERS = 2_000_000

# What elements, roles and class words say about a branch.
ASIDE_NAMES = RAW | frozenset(
    "head nav footer aside form template noscript object canvas audio video button select dialog menu search".split()
)
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
ASIDE_WORDS = re.compile(
    r"(?:ads?|adverts?|advertis\w+|adsense|adslot|adunit|banners?|sponsor\w*|promo\w*|menus?|nav|navbar|navigation|breadcrumbs?"
    r"|sidebars?|footer|header|masthead|topbar|toolbar|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay"
    r"|newsletter|subscribe|subscription|signup|login|share|sharing|social|comments?|commentlist|respond|replies|reply"
    r"|disqus|related|recommended|recommendations|widgets?|pagination|pager|searchbox|searchform|copyright)"
)
# An article may be one of these all the same.
ASIDE_ARTICLES = re.compile(r"(?:comments?|reply|replies|ads?|adverts?|sponsored|promo\w*|related|teasers?)")
ARTICLES = ("article", "main")
HEADINGS = ("h1", "h2", "h3")
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def _hash(*parts: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b"\0".join(parts)) - (1 << 63)


def _key(number: int) -> bytes:
    return number.to_bytes(8, "little", signed=True)


class Paths:
    """Numbers of element nodes; those met before are remembered up to a bound."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, str], int] = {}

    def of(self, page: Page) -> list[int]:
        if len(self.known) > HELD:
            self.known.clear()
        out: list[int] = []
        for e in page.elements:
            step = (out[e.parent] if e.parent >= 0 else 0, e.look)
            if step not in self.known:
                self.known[step] = _hash(_key(step[0]), step[1].encode(errors="replace"))
            out.append(self.known[step])
        return out


def observations(page: Page, nodes: list[int]) -> tuple[set[int], Counter, Counter]:
    """A page's part of the tree: nodes it has, (node, style) and (node, content) by how often they occur."""
    styles: Counter = Counter()
    contents: Counter = Counter()
    for e, node in zip(page.elements, nodes, strict=True):
        if e.children:
            styles[node, _hash(*[_key(nodes[c]) for c in e.children])] += 1
        text = " ".join("".join(e.text).split()) if e.text else ""
        if text:
            contents[node, _hash(b"text", text.encode(errors="replace"))] += 1
        for reference in e.references:
            contents[node, _hash(b"reference", reference.encode(errors="replace"))] += 1
    return set(nodes), styles, contents


def importances(pages: DataFrame) -> DataFrame:
    """Per host of ``pages`` (host, html) its nodes with the importance of their presentation and content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = Paths()
        # By host, node, kind and value: how often, and the sum of n * ln(n) over pages.
        held: dict[tuple[str, int, int, int], list[float]] = {}

        def send() -> pa.RecordBatch:
            host, node, kind, value = zip(*held, strict=True)
            n, spread = zip(*held.values(), strict=True)
            held.clear()
            kinds = (pa.string(), pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.float64())
            columns = (host, node, kind, value, n, spread)
            names = ("host", "node", "kind", "value", "n", "spread")
            return pa.RecordBatch.from_pydict({c: pa.array(x, k) for c, x, k in zip(names, columns, kinds, strict=True)})

        for batch in batches:
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = parse(source or "")
                nodes, styles, contents = observations(page, paths.of(page))
                found = [((host, node, 0, 0), 1) for node in nodes]
                for kind, counts in ((1, styles), (2, contents)):
                    found += [((host, node, kind, value), n) for (node, value), n in counts.items()]
                for key, n in found:
                    total = held.setdefault(key, [0, 0.0])
                    total[0] += n
                    total[1] += n * math.log(n)
                if len(held) > HELD:
                    yield send()
        if held:
            yield send()

    schema = "host string, node long, kind byte, value long, n long, spread double"
    n, kind = F.col("n"), F.col("kind")
    values = (
        pages.select("host", "html")
        .mapInArrow(by_task(run), schema)
        .groupBy("host", "node", "kind", "value")
        .agg(F.sum("n").alias("n"), F.sum("spread").alias("spread"))
    )

    def over(of: int, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(kind == of, value)), F.lit(0.0))

    # The entropy of the pages a content is on, in nats; that of all pages scales it below.
    entropy = F.ln(n) - F.col("spread") / n
    nodes = values.groupBy("host", "node").agg(
        over(0, n.cast("double")).alias("pages"),
        over(1, n.cast("double")).alias("uses"),
        over(1, n * F.ln(n)).alias("styled"),
        over(2, F.lit(1.0)).alias("contents"),
        over(2, entropy).alias("repeated"),
    )
    sizes = values.where("kind = 0").groupBy("host").agg(F.max("n").alias("of_host"))
    least = F.greatest(F.lit(float(LEAST_PAGES)), F.col("of_host") * LEAST_SHARE)
    uses, pages_ = F.col("uses"), F.col("pages")
    style = F.when(uses > 1, (F.ln(uses) - F.col("styled") / uses) / F.ln(uses)).otherwise(1.0)
    content = F.when(
        (pages_ > 1) & (F.col("contents") > 0), 1 - F.col("repeated") / F.col("contents") / F.ln(pages_)
    ).otherwise(1.0)
    return (
        nodes.where(pages_ >= LEAST_PAGES)
        .join(sizes, "host")
        .where(pages_ >= least)
        .groupBy("host")
        .agg(F.collect_list(F.struct("node", style.alias("style"), content.alias("content"))).alias("importances"))
    )


def _words(classes: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(classes)]


def set_aside(page: Page) -> list[bool]:
    """Which elements their presentation rules out; what is in them goes with them."""
    elements = page.elements
    n = len(elements)
    out = [False] * n
    holds_article, holds_heading = [False] * n, [False] * n
    in_article, inside = [False] * n, [False] * n
    for i, e in enumerate(elements):
        parent = max(e.parent, 0)
        in_article[i] = in_article[parent]
        words = _words(e.classes) if e.classes else ()
        if e.name in ARTICLES:
            out[i] = e.role in ASIDE_ROLES or any(ASIDE_ARTICLES.fullmatch(w) for w in words)
        elif e.name not in ("", "html", "body"):
            out[i] = e.name in ASIDE_NAMES or e.role in ASIDE_ROLES or any(ASIDE_WORDS.fullmatch(w) for w in words)
        inside[i] = out[i] or inside[parent]
        in_article[i] |= e.name in ARTICLES and not inside[i]
    for i in range(n - 1, 0, -1):
        e = elements[i]
        holds_article[i] |= e.name in ARTICLES and not _ruled_out_article(e)
        holds_heading[i] |= e.name in HEADINGS
        holds_article[e.parent] |= holds_article[i]
        holds_heading[e.parent] |= holds_heading[i]
    named = ASIDE_NAMES - {"form"}
    for i, e in enumerate(elements):
        if e.name == "header":
            # The header of an article has its title.
            out[i] = not (in_article[i] and holds_heading[i])
        elif out[i] and e.name not in ARTICLES and holds_article[i] and e.name not in named:
            out[i] = False
    if any(in_article):
        for i, e in enumerate(elements):
            out[i] |= not in_article[i] and not holds_article[i]
    return out


def _ruled_out_article(e) -> bool:
    return e.role in ASIDE_ROLES or any(ASIDE_ARTICLES.fullmatch(w) for w in _words(e.classes))


def unimportant(page: Page, nodes: list[int], known: dict[int, tuple[float, float]]) -> list[bool]:
    """Which elements root branches without any importance above ``LOW``."""
    elements = page.elements
    sums, peaks = [0.0] * len(elements), [0.0] * len(elements)
    for i in range(len(elements) - 1, -1, -1):
        e = elements[i]
        style, content = known.get(nodes[i], (1.0, 1.0))
        own = bool(e.references) or any(t and not t.isspace() for t in e.text)
        children = len(e.children)
        parts = sums[i] + (content if own else 0.0)
        mean = parts / (children + own) if children + own else 0.0
        weight = DAMPING**children
        composite = (1 - weight) * style + weight * mean
        peaks[i] = max(peaks[i], composite)
        if e.parent >= 0:
            sums[e.parent] += composite
            peaks[e.parent] = max(peaks[e.parent], peaks[i])
    return [p < LOW for p in peaks]


def text_of(page: Page, removed: list[bool]) -> str:
    """Blocks of the elements that stay, one line each, white space as single spaces."""
    blocks: list[str] = []
    parts: list[str] = []
    skipped = -1

    def end_block() -> None:
        block = " ".join("".join(parts).split())
        if block:
            blocks.append(block)
        parts.clear()

    for event in page.events:
        if isinstance(event, str):
            if skipped < 0:
                parts.append(event)
            continue
        if event is None:
            if skipped < 0:
                end_block()
            continue
        number = event if event >= 0 else ~event
        if skipped >= 0:
            if event == ~skipped:
                skipped = -1
        elif event >= 0 and removed[number]:
            skipped = number
            # What is removed parts what is around it, unless it is in a line of text.
        if page.elements[number].name in BLOCK:
            if skipped < 0 or skipped == number:
                end_block()
    end_block()
    return "\n".join(blocks)


def main_text(source: str, known: dict[int, tuple[float, float]], paths: Paths) -> str:
    """The main text of a page, given the importances of its site's nodes."""
    page = parse(source)
    aside = set_aside(page)
    both = [a or u for a, u in zip(aside, unimportant(page, paths.of(page), known), strict=True)]
    return ("" if both[0] else text_of(page, both)) or text_of(page, aside)


def extracted(pages: DataFrame) -> DataFrame:
    """Every row of ``pages`` (page_id, url, html) with its main text: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    ready(spark)
    pages = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    model = materialised(importances(pages), "site-importances")
    numbers = model.agg(F.coalesce(F.sum(F.size("importances")), F.lit(0)), F.count(F.lit(1))).first()
    if sum(numbers) <= BROADCAST_NUMBERS:
        model = F.broadcast(model)
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, sites = Paths(), {}
        for batch in batches:
            texts = []
            for i, (host, source) in enumerate(
                zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)
            ):
                if host not in sites:
                    if len(sites) >= 64:
                        sites.clear()
                    rows = batch.column("importances")[i].as_py() or []
                    sites[host] = {x["node"]: (x["style"], x["content"]) for x in rows}
                texts.append(main_text(source or "", sites[host], paths))
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array(map(len, texts), pa.int64()),
                }
            )

    schema = f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long"
    return pages.join(model, "host", "left").mapInArrow(by_task(run), schema)


def op12_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of the whole table ``pages``."""
    return extracted(load(spark, sf_dir, "pages"))
