"""Main text of pages by site style trees.

The pages of a host are merged into one style tree. An element node is a path of block elements with their
classes, sections and divs also with their place among like siblings; for each node the tree counts on how many
pages every presentation (sequence of child blocks) and every content (text of a block) occurs. A node's
importance joins the entropy of its presentations and that of its contents: what looks and reads the same on most
pages of the host scores near 0, what differs from page to page near 1. A content node, a text in its element,
has the importance of its own spread. From each page go the branches and the contents whose score is below
``THRESHOLD``.

The score is the importance and a prior. An element or class that names a menu, advert, notice, form or the like
takes off 1, so it goes however much it differs from page to page, as reader comments do. Being inside
``article`` or ``main`` adds ``MARKED``, so there a text has to be on nearly all pages of its element to go.
Class words of an element round the page's main article say nothing of the article. A page has its main text in
its main article (the longest, and others of at least half its length) if it marks one. Blocks that are mostly
links go outside it. A page of which importance alone would leave nothing keeps what importance took.

Pages are counted by distinct content, as copies of one page would otherwise remove each other: each count has a
map of 64 bits in which a page sets the bit of its three longest blocks, and while the map has room (up to about 150
different pages) the number that it stands for bounds the count. The tree is never held as a whole: nodes,
presentations and contents are hashes whose counts Spark adds up, so a host with a third of all pages is spread like
any other. Nodes seen on fewer than ``MIN_PAGES`` pages aren't judged by importance. Only nodes and contents that
go come back to the pages, one array per host; its length follows from the site's templates, not its number of pages.

Cases: a null or empty page has an empty text. Tags that aren't closed end with the element round them,
an open comment or script ends with the page, a ``<`` that opens no tag is text. Pages without a host share no tree.
Every page is read in time and memory in proportion to its length: a block counts for the ``LEVELS`` elements next
round it, and quotes are read once.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import release_shuffles, shield
from millrace.llm.url_lists import host
from millrace.session import write_once

MIN_PAGES, THRESHOLD = 10, 0.25
#: Weight of a node's own presentation against its contents, to the power of its number of children.
GAMMA = 0.9
#: What an ``article`` or ``main`` adds to the importance of what is inside.
MARKED = 0.15
#: Elements next round a block that it is a content of.
LEVELS = 32
#: A block of which at least this share of characters is link text is a menu.
LINK_SHARE = 0.6

_RAW = {name: re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE) for name in
        "script style noscript template svg iframe object textarea select title".split()}
_STOP = re.compile(r"[<>\"']")
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9-]*)")
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"\shidden(?:[\s=>/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z]+")
_BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote "
    "pre figure figcaption header footer nav aside form fieldset address details summary menu hr center hgroup search dialog".split())
_VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
_NOISE_TAGS = frozenset("head nav footer aside form menu dialog search button label option fieldset".split())
#: Words in class, id or role that name what isn't main text.
NOISE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup "
    "modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments reply replies respond discussion disqus "
    "share sharing social related recommended newsletter subscribe subscription signup login register search pagination pager toolbar "
    "contentinfo complementary dialog widget masthead skip copyright tags".split())
_CLOSES_P = _BLOCKS - {"html", "body"}


_PLACED = frozenset("div section".split())
#: Prior of a node: nothing, a class word that names no main text (or a form, which may hold a page), an element or attribute that does.
_PLAIN, _WORDED, _NAMED = 0, 1, 2


class _Node:
    """An element of a page: ``key`` is the hash of its path, ``prior`` one of the three above."""

    __slots__ = ("tag", "above", "key", "prior", "marked", "children", "places", "text")

    def __init__(self, tag: str, above: _Node | None, key: int, prior: int, marked: bool):
        self.tag, self.above, self.key, self.prior, self.marked = tag, above, key, prior, marked
        self.children: list[str] = []
        self.places: Counter[str] = Counter()
        self.text = 0


def _hash(*parts: str | int) -> int:
    """64 bits of the parts, which are joined by a character that no text of a block holds."""
    joined = "\n".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "little", signed=True)


def _tag_end(page: str, start: int) -> tuple[int, int]:
    """Where the tag at ``start`` ends by its quoted values (-1: quotes are out of step), and how far it was read."""
    at = start + 1
    while True:
        stop = _STOP.search(page, at)
        if not stop:
            return -1, len(page)
        at = stop.end()
        if stop.group() == ">":
            return at, at
        if stop.group() == "<":
            return -1, at
        if page[max(start, stop.start() - 9) : stop.start()].rstrip().endswith("="):
            close = page.find(stop.group(), at)
            if close < 0 or page[close + 1 : close + 2] not in (" ", "\t", "\r", "\n", "\f", "/", ">"):
                return -1, max(at, close)
            at = close + 1


def _tokens(page: str) -> Iterator[tuple[str, bool]]:
    """The page's texts and tags in order, each with whether it is a tag; comments and raw elements are left out."""
    at, size, last, plain = 0, len(page), page.rfind(">"), 0
    while at < size:
        start = page.find("<", at)
        if start != at:
            yield page[at : start if start >= 0 else size], False
        if start < 0:
            return
        if page.startswith("<!--", start):
            end = page.find("-->", start + 2)
            at = end + 3 if end >= 0 else size
            continue
        tag = _TAG.match(page, start)
        if start > last or not tag and page[start + 1 : start + 2] not in ("!", "?", "/"):
            yield "<", False
            at = start + 1
            continue
        end = -1
        if tag and start >= plain:
            # Where quotes were out of step, tags end at the next >, so that no part is read for quotes twice.
            end, plain = _tag_end(page, start)
        at = end if end >= 0 else page.find(">", start) + 1
        if not tag:
            continue
        raw = None if tag.group(1) else _RAW.get(tag.group(2).lower())
        if raw is None:
            yield page[start:at], True
        elif page[at - 2] != "/" or tag.group(2).lower() != "svg":
            close = raw.search(page, at)
            at = close.end() if close else size


def blocks(page: str | None) -> tuple[list[tuple[str, float, _Node]], list[_Node]]:
    """Blocks of text in page order, (text, share of link text, element), and the page's elements, outer ones first."""
    out: list[tuple[str, float, _Node]] = []
    root = _Node("", None, 0, _PLAIN, False)
    stack, nodes = [root], []
    open_tags: Counter[str] = Counter()
    pieces: list[str] = []
    links = 0
    in_link = False

    def flush() -> None:
        nonlocal links
        if pieces:
            whole = "".join(pieces)
            text = " ".join(whole.split())
            if text:
                out.append((text, links / len(whole), stack[-1]))
            pieces.clear()
        links = 0

    def close() -> None:
        open_tags[stack.pop().tag] -= 1

    for token, is_tag in _tokens(page or ""):
        if not is_tag:
            text = entities.unescape(token)
            pieces.append(text)
            links += len(text) * in_link
            continue
        tag = _TAG.match(token)
        closing, name = bool(tag.group(1)), tag.group(2).lower()
        if name == "br":
            pieces.append(" ")
        elif name == "a":
            in_link = not closing
        elif name in _BLOCKS or name in _NOISE_TAGS:
            flush()
            in_link = False
            if closing:
                # An end tag closes what is open inside it; one without a start tag does nothing.
                while open_tags[name]:
                    found = stack[-1].tag == name
                    close()
                    if found:
                        break
                continue
            if stack[-1].tag == "p" and name in _CLOSES_P or name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].tag == name:
                close()
            if name in _VOID:
                continue
            words = sorted({w for g in _NAME.findall(token) for w in _SPLIT.split("".join(g).lower()) if w})
            top = stack[-1]
            label = ".".join([name, *words])
            if name in _NOISE_TAGS and name != "form" or name == "header" and not top.marked or _HIDDEN.search(token):
                prior = _NAMED
            else:
                worded = name not in ("html", "body", "main") and not NOISE_WORDS.isdisjoint(words)
                prior = _WORDED if worded or name == "form" else _PLAIN
            top.children.append(label)
            place = ""
            if name in _PLACED:
                top.places[label] += 1
                place = top.places[label]
            node = _Node(name, top, _hash(top.key, label, place), prior, top.marked or name in ("article", "main"))
            nodes.append(node)
            stack.append(node)
            open_tags[name] += 1
    flush()
    return out, nodes


def _region(found: list[tuple[str, float, _Node]], nodes: list[_Node]) -> tuple[dict[_Node, bool], dict[_Node, _Node | None]]:
    """Whether the prior takes each element off, and the outermost article of each.

    The page's own article is the longest of those that no prior takes off, then of those inside class words only,
    then likewise of its ``main`` elements: class words of the elements round it don't count. Text under an
    element whose tag, attribute or class names no main text isn't part of an article's length.
    """
    articles: dict[_Node, _Node | None] = {}
    inside: dict[_Node, tuple[_Node | None, bool]] = {}
    worst: dict[_Node, int] = {}
    for n in nodes:
        articles[n] = articles.get(n.above) or (n if n.tag == "article" else None)
        worst[n] = max(worst.get(n.above, _PLAIN), n.prior)
        holder, off = inside.get(n.above, (None, False))
        starts = articles[n] is n or n.tag == "main" and not articles[n]
        inside[n] = (n, n.prior != _PLAIN) if starts else (holder, off or n.prior != _PLAIN)
    for text, _, n in found:
        holder, off = inside.get(n, (None, True))
        if holder and not off and worst[n] != _NAMED:
            holder.text += len(text)
    own = max((n for n in nodes if n.text), key=lambda n: (n.tag == "article", -worst[n], n.text), default=None)
    free = set()
    while own:
        own = own.above
        free.add(own)
    noise: dict[_Node, bool] = {}
    for n in nodes:
        noise[n] = noise.get(n.above, False) or n.prior == _NAMED or n.prior == _WORDED and n not in free
    return noise, articles


#: What a row of the style tree counts: pages with the node, presentations, contents of elements inside, own contents.
_PAGE, _LOOK, _TEXT, _OWN = 0, 1, 2, 3


def _tree_rows(page: str) -> tuple[set[tuple[int, bool, int, int]], int]:
    """(node, marked, kind, value) of one page, and the bit that stands for the page's content."""
    found, nodes = blocks(page)
    noise, _ = _region(found, nodes)
    looks: dict[int, tuple[bool, str]] = {}
    for n in nodes:
        looks.setdefault(n.key, (n.marked, ",".join(n.children)))
    rows = {(key, marked, kind, _hash(look) if kind else 0) for key, (marked, look) in looks.items() for kind in (_PAGE, _LOOK)}
    for text, _, n in found:
        rows.add((n.key, n.marked, _OWN, _hash(n.key, text)))
        value, above = _hash(text), n.above
        for _ in range(LEVELS):
            # What is round a marked article isn't judged by the article.
            if above is None or above.above is None or above.marked != n.marked:
                break
            rows.add((above.key, above.marked, _TEXT, value))
            above = above.above
    longest = sorted((text for text, _, n in found if not noise.get(n)), key=lambda t: (-len(t), t))[:3]
    bit = _hash("page", *longest) % 64
    return rows, 1 << bit if bit < 63 else -(1 << 63)


def style_tree(pages: DataFrame) -> DataFrame:
    """host, node, marked, kind, value of pages (url, html), and the number of different pages of the host that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple, list[int]] = {}
            for site, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, bit = _tree_rows(page)
                for row in rows:
                    known = counts.setdefault((site, *row), [0, 0])
                    known[0] += 1
                    known[1] |= bit
            if counts:
                columns = list(zip(*counts))
                pages, bits = zip(*counts.values())
                types = [pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, t) for c, t in zip(columns, types)), pa.array(pages, pa.int64()), pa.array(bits, pa.int64())],
                    names=["host", "node", "marked", "kind", "value", "pages", "bits"])

    sites = pages.select(host("url").alias("host"), "html").filter("host <> '' and html is not null")
    rows = sites.mapInArrow(run, "host string, node long, marked boolean, kind int, value long, pages long, bits long")
    counted = rows.groupBy("host", "node", "marked", "kind", "value").agg(F.sum("pages").alias("pages"), F.bit_or("bits").alias("bits"))
    used = F.bit_count("bits")
    # A map with few free bits says only that there are many different pages.
    different = F.when(used < 58, F.round(-64 * F.log((64 - used) / 64.0))).otherwise(F.col("pages")).cast("long")
    return counted.select("host", "node", "marked", "kind", "value", F.greatest(F.lit(1).cast("long"), F.least("pages", different)).alias("pages"))


def importance(tree: DataFrame) -> DataFrame:
    """Importance, 0 to 1, of every element (host, node, marked), and the pages that have it."""
    # Sums over a node's values first, so that one aggregation serves pages, presentations and contents.
    c = F.col("pages").cast("double")
    text = F.col("kind").isin(_TEXT, _OWN)
    sums = tree.groupBy("host", "node", "marked").agg(
        F.max(F.when(F.col("kind") == _PAGE, F.col("pages"))).alias("m"),
        F.sum(F.when(F.col("kind") == _LOOK, c * F.log(c))).alias("looks"),
        F.sum(F.when(F.col("kind") == _LOOK, c)).alias("n_looks"),
        F.avg(F.when(text, F.log(c))).alias("texts"),
        F.count(F.when(F.col("kind") == _LOOK, 1)).alias("kinds"),
    )
    log_m = F.log(F.col("m").cast("double"))
    # Entropy of the presentations to base m; a content on c of m pages has entropy log_m(c).
    look = F.when(F.col("m") > 1, F.least(F.lit(1.0), (F.log("n_looks") - F.col("looks") / F.col("n_looks")) / log_m)).otherwise(1.0)
    content = F.when(F.col("m") > 1, 1 - F.least(F.lit(1.0), F.col("texts") / log_m)).otherwise(1.0)
    share = F.pow(F.lit(GAMMA), F.col("kinds").cast("double"))
    # Few presentations on many pages don't outweigh contents that differ.
    both = F.when(F.col("texts").isNull(), look).otherwise(F.greatest((1 - share) * look + share * content, content / 2))
    return sums.select("host", "node", "marked", "m", both.alias("importance"))


def low_nodes(tree: DataFrame, min_pages: int = MIN_PAGES, threshold: float = THRESHOLD) -> DataFrame:
    """host and ``low``, the hashes of its elements and contents that score below the threshold."""
    elements = importance(tree).filter(F.col("m") >= min_pages)
    score = F.col("importance") + F.when(F.col("marked"), MARKED).otherwise(0.0)
    # A content below the threshold is on more than this many pages; few are, so that this join is small.
    least = max(2.0, min_pages ** (1 - threshold))
    own = tree.filter((F.col("kind") == _OWN) & (F.col("pages") >= least)).select("host", "node", "value", F.col("pages").cast("double").alias("c"))
    contents = own.join(elements.drop("importance"), ["host", "node"]).withColumn(
        "importance", 1 - F.least(F.lit(1.0), F.log("c") / F.log(F.col("m").cast("double"))))
    low = elements.filter(score < threshold).select("host", "node").union(contents.filter(score < threshold).select("host", "value"))
    return low.groupBy("host").agg(F.sort_array(F.collect_set("node")).alias("low"))


def main_text(page: str | None, low: frozenset[int] = frozenset()) -> str:
    """The main text of one page, given the hashes of the host's elements and contents of low importance."""
    found, nodes = blocks(page)
    noise, articles = _region(found, nodes)
    gone: dict[_Node, bool] = {}
    if low:
        for n in nodes:
            gone[n] = n.key in low or gone.get(n.above, False) and n.marked == n.above.marked
    longest = max((a.text for n, a in articles.items() if n is a and not noise[a]), default=0)
    rows = [(text, n, articles.get(n)) for text, linked, n in found if not noise.get(n) and (linked < LINK_SHARE or n.marked)]
    # A page that marks its article has its main text there.
    marked = [r for r in rows if r[1].marked]
    region = [r for r in marked if not r[2] or 2 * r[2].text >= longest] or marked or rows
    if low:
        region = [r for r in region if not gone.get(r[1]) and _hash(r[1].key, r[0]) not in low] or region
    return "\n".join(text for text, _, _ in region)


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``pages`` (with url and html) but the html, and ``text``."""
    release_shuffles(pages.sparkSession)
    inner, restore = shield(pages, ["url", "html"])
    tree = write_once(style_tree(inner.select("url", "html"))).rows
    # Read from files its size is known: it is broadcast if small and joined by a shuffle if not.
    low = write_once(low_nodes(tree, min_pages, threshold)).rows.withColumnRenamed("host", "_host")
    rows = inner.withColumn("_host", F.coalesce(F.nullif(host("url"), F.lit("")), F.concat(F.lit("?"), F.xxhash64("html").cast("string"))))
    names = [c for c in inner.columns if c != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {c: i for i, c in enumerate(batch.schema.names)}
            texts = []
            sets: dict[bytes, frozenset[int]] = {}
            for page, nodes in zip(batch.column(at["html"]), batch.column(at["low"])):
                known: frozenset[int] = frozenset()
                if nodes.is_valid:
                    values = nodes.values.to_numpy(zero_copy_only=False)
                    key = values.tobytes()
                    known = sets.get(key) or sets.setdefault(key, frozenset(values.tolist()))
                texts.append(main_text(page.as_py(), known))
            yield pa.RecordBatch.from_arrays([*(batch.column(at[c]) for c in names), pa.array(texts, pa.string())], names=[*names, "text"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema if f.name != "html"]
    joined = rows.join(low, "_host", "left").select(*names, "html", "low")
    return restore(joined.mapInArrow(run, ", ".join([*kept, "text string"])), "text")
