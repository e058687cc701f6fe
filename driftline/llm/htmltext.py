"""Operator 2: main text of web pages by site style trees.

All pages of a host are merged into one tree: a node is a path of elements (tag with
its class and id words, digits left out), each with the styles it occurs in (its
sequences of child elements) and the texts found at it. Over the pages of the host,

  presentation importance = entropy of a node's styles, logarithms to the number of
                            pages that have the node (1 if it is on one page),
  content importance      = 1 - mean entropy of its texts over the pages, which is
                            log(pages with the text) / log(pages), per occurrence,
  branch importance       = (1 - G^s) presentation + G^s mean content of the leaves
                            below, s the number of styles, G = 0.9.

A branch below ``LEAST`` importance is removed from each page of the host. Branches
count when at least ``MIN_PAGES`` pages have them, whatever the size of the host. A page that
would have nothing or only headings left keeps its text, and a marked article or main
part is not removed as a whole (it may be the same all over the site).
Elements that say what they are (nav, footer, class "sidebar", role "search" ...) and
text that is no content (scripts, forms ...) are left out on every page, also on
hosts with too few pages; where a page marks its article or main part, only that
counts. Text is judged by the element it is read in: a button, a list of choices or a
hidden or advertising span inside a paragraph goes alone and doesn't split it.

Only path and text hashes are shuffled, combined before the shuffle, so a host with a
third of all pages costs no task more than others; the html itself is joined with the
list of its own low-importance branches, so no list grows with the host.

Cases: null html is an empty page; unclosed tags, missing ends and stray brackets are
read leniently; a null url is the host ""; repeated rows are pages of their own; an
empty table gives no rows; other columns are ignored unless named in ``keep``."""
from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import map_columns, map_in_arrow
from driftline.session import freeze

G, LEAST, MIN_PAGES = 0.9, 0.3, 8
#: Parts that the pages of a branch are dealt into, so that a frequent branch is no single task's burden.
SALTS = 32

# Fixed values of HTML: elements without content, with raw content, blocks, and ends implied by a start.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p
pre section summary table tbody td tfoot th thead tr ul""".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
         "thead": {"tr", "td", "th"}, "tfoot": {"tr", "td", "th", "tbody"}, "body": {"head"}}
_WALLS = {"table", "ul", "ol", "dl", "div", "section", "article", "body", "html", "select", "td", "th"}
# Elements, class or id words and roles that are no main text.
_DROP = set("""head nav footer aside form script style noscript template svg math iframe object canvas audio video
select button textarea title menu dialog noembed noframes map""".split())
_WORDS = set("""nav navbar navigation menu menubar submenu breadcrumb breadcrumbs header masthead topbar footer sidebar
aside rail ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promos promotion promoted
banner notice notices cookie cookies consent gdpr popup modal overlay lightbox newsletter subscribe subscription signup
signin login register form search share sharing social follow comment comments discussion reply replies disqus
respond reactions related recommended recommendations widget widgets toolbar pagination pager copyright legal
disclaimer alert alerts skip hidden""".split())
#: Dropped elements that are shown as a box of their own, which parts words.
_BOXES = set("button select textarea iframe object canvas audio video svg math".split())
#: Those words that also count for elements inside a line of text (there, "comment" or "follow" can name anything).
_INLINE = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promos hidden".split())
#: Beside "related", these name a part of a paper and no list of links.
_PAPER = set("work works research literature studies".split())
_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar "
             "note status".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                     r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Node:
    tag: str
    key: int                       # hash of the path
    dropped: bool                  # it or an element around it is no main text
    says: tuple[int, ...]          # elements around it, or it, whose class or id words say that they are no main text
    main: int                      # hash of the innermost article or main element around it, or 0
    block: bool
    header: bool = False           # inside a header of an article
    mute: bool = False             # dropped by an element inside a line of text: its text goes, the line stays one
    near: tuple[int, ...] = ()     # ``says`` of the innermost block
    children: list[str] = field(default_factory=list)


@dataclass
class Block:
    keys: tuple[int, ...]          # path hashes of the block elements around it, outermost first
    dropped: bool
    main: int                      # hash of the innermost article or main element around it, or 0
    heading: bool
    text: str
    pieces: list[tuple[str, tuple[int, ...]]] | None = None    # text and ``says``, if they differ inside the block


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _label(tag: str, attributes: str) -> tuple[str, bool, set[str], bool]:
    """(tag with its class and id words, whether other attributes say that it is no main text,
    the words that do, whether it is the main part)."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return tag, False, set(), False
    words, named, drop, main = set(), set(), False, False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            found = {w.lower() for w in _PARTS.findall(value)}
            named |= found - {"related"} if found & _PAPER else found
            words |= found
        elif name == "role":
            drop = drop or value.lower() in _ROLES
            main = main or value.lower() in ("main", "article")
            words.add(value.lower())
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            drop = True
        elif name == "style" and _HIDDEN.search(value):
            drop = True
    return ".".join([tag, *sorted(words)]), drop, named & _WORDS, main


def parse(page: str | None) -> tuple[list[Block], dict[int, str]]:
    """(blocks of text in page order, child sequences of the block elements by path)."""
    blocks: list[Block] = []
    styles: dict[int, str] = {}
    paths: dict[tuple[int, str], int] = {}
    root = Node("", 0, False, (), 0, True)
    said: list[bool] = []              # per element dropped for its words: whether it holds an article or main part
    inline: list[bool] = []            # and whether these words count inside a line of text
    under: list[tuple[int, ...]] = []  # per block, the elements around it that are dropped for their words
    stack = [root]
    parts: list[tuple[str, tuple[int, ...]]] = []
    plain = lambda raw: " ".join((entities.unescape(raw) if "&" in raw else raw).split())

    def read(raw: str) -> None:
        top = stack[-1]
        if not top.mute:
            says = top.near
            if len(top.says) > len(says):
                says = (*says, *[i for i in top.says[len(says):] if inline[i]])
            parts.append((raw, says))

    def flush():
        if parts:
            pieces = parts[:]
            parts.clear()
            text = plain("".join([raw for raw, _ in pieces]))
            if text:
                top = stack[-1]
                near = next(n for n in reversed(stack) if n.block)
                at = [n for n in stack[1:] if n.block]
                heading = any(n.tag in _HEADINGS for n in at)
                blocks.append(Block(tuple(n.key for n in at), near.dropped or top.header and not heading, top.main,
                                    heading, text, pieces if any(says != near.says for _, says in pieces) else None))
                under.append(near.says)

    def pop():
        if stack[-1].block and not stack[-1].mute:
            flush()
        node = stack.pop()
        if node.block and node.children:
            styles.setdefault(node.key, ">".join(node.children))

    def close(tags: set[str], walls: set[str]) -> None:
        """End the innermost open element of these, if no wall is in between."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i].tag in walls:
                return

    page = page or ""
    at = 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        if m is None:
            read(page[at:])
            break
        if m.start() > at:
            read(page[at:m.start()])
        at = m.end() if m.end() > m.start() else m.start() + 1
        if m.group(3) is None:
            if m.group(1):
                read(m.group(1).replace("&", "&amp;"))
            continue
        tag = m.group(3).lower()
        block = tag in _BLOCK
        if (block or tag == "head") and not stack[-1].mute:
            flush()
        elif tag in ("br", "img"):
            read(" ")
        if m.group(2):
            if tag == "p":
                close({"p"}, _WALLS)
            else:
                close({tag}, {"td", "th", "body", "html"} - {tag})
            continue
        if block:
            if tag not in ("option", "optgroup"):
                close({"p"}, _WALLS | {"button", "object", "noscript", "template"})
            if tag in _ENDS:
                for _ in range(3):
                    close(_ENDS[tag], _WALLS - _ENDS[tag])
        if tag in _VOID:
            continue
        label, hard, says, marked = _label(tag, m.group(4))
        up = stack[-1]
        key = paths.get((up.key, label))
        if key is None:
            key = paths[(up.key, label)] = _hash(f"{up.key}/{label}")
        main = key if marked or tag in ("article", "main") else up.main
        inner = tag == "header" and bool(up.main)
        own = tag not in ("html", "body", *_HEADINGS)
        drop = up.dropped or tag in _DROP or hard and own or tag == "header" and not up.main
        around = up.says
        if tag == "section" and up.main and says == {"discussion"}:
            says = set()               # a part of the article; readers' discussions are told by other words, too
        if says and own and not drop:
            around = (*around, len(said))
            said.append(False)
            inline.append(bool(says & _INLINE))
        mute = up.mute or drop and not up.dropped and not block
        if mute and not up.mute and tag in _BOXES:
            read(" ")
        if main == key and not drop:
            for i in around:
                said[i] = True
        if block:
            near = next(n for n in reversed(stack) if n.block)
            if not near.children or near.children[-1] != label:
                near.children.append(label)
        stack.append(Node(tag, key, drop, around, main, block, up.header or inner, mute, around if block else up.near))
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if not drop:
                read(page[at:end.start() if end else len(page)])
            at = end.end() if end else len(page)
            pop()
    flush()
    while len(stack) > 1:
        pop()
    if said:
        # words alone drop no element with an article or main part, or with most of the text
        sizes, total = [0] * len(said), 0
        for block, around in zip(blocks, under):
            if not block.dropped:
                for size, says in [(len(block.text), around)] if block.pieces is None else \
                        [(len(plain(raw)), says) for raw, says in block.pieces]:
                    total += size
                    for i in says:
                        sizes[i] += size
        goes = [not holds and 2 * size <= total for holds, size in zip(said, sizes)]
        for block, around in zip(blocks, under):
            block.dropped = block.dropped or any(goes[i] for i in around)
            if block.pieces is not None:
                block.text = plain("".join([raw for raw, says in block.pieces if not any(goes[i] for i in says)]))
        blocks = [b for b in blocks if b.text]
    return blocks, styles


def main_text(page: str | None, noise: set[int]) -> str:
    """Text of a page without its host's low-importance branches ``noise``."""
    kept = [b for b in parse(page)[0] if not b.dropped]
    says = lambda found: any(not b.heading for b in found)
    inside = [b for b in kept if b.main]
    if says(inside):
        kept = inside
    if noise:
        # a marked part is not removed as a whole, only branches in it
        below = lambda b: b.keys[b.keys.index(b.main) + 1:] if b.main in b.keys else b.keys
        # if the branches leave nothing, those that hold the text itself may
        for left in ([b for b in kept if noise.isdisjoint(below(b))],
                     [b for b in kept if not below(b) or below(b)[-1] not in noise]):
            if says(left):
                kept = left
                break
    return "\n".join(b.text for b in kept)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _observations(pages: DataFrame) -> DataFrame:
    """(host, node, kind, value, above): a text (0) or style (1) of a node, or a page that
    has the node (2); above: the branches that a text lies in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for h, page in zip(b.column("host").to_pylist(), b.column("html")):
                blocks, styles = parse(page.as_py())
                nodes = set()
                for block in blocks:
                    if block.keys and not block.dropped:
                        rows.append((h, block.keys[-1], 0, _hash(block.text), list(block.keys)))
                        nodes.update(block.keys)
                rows += [(h, k, 1, _hash(s), None) for k, s in styles.items() if k in nodes]
                rows += [(h, k, 2, 0, None) for k in nodes]
                rows.append((h, 0, 2, 0, None))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             names=["host", "node", "kind", "value", "above"])

    return map_in_arrow(pages.select("host", "html"), run,
                        "host string, node long, kind int, value long, above array<long>")


def branch_importance(pages: DataFrame) -> DataFrame:
    """(host, branch, pages, of, importance) from pages with ``host`` and ``html``."""
    seen = _observations(pages).groupBy("host", "node", "kind", "value") \
        .agg(F.count("*").alias("c"), F.first("above", True).alias("above"))
    log_c = F.col("c") * F.log("c")
    only = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value).otherwise(0))
    nodes = seen.groupBy("host", "node").agg(
        only(0, F.col("c")).alias("texts"), only(0, log_c).alias("text_log"), only(1, F.col("c")).alias("shown"),
        only(1, log_c).alias("shown_log"), only(1, F.lit(1)).alias("styles"), only(2, F.col("c")).alias("pages"),
        F.first("above", True).alias("above"))
    nodes = freeze(nodes, "site-nodes")
    many = F.log(F.greatest(F.col("pages"), F.lit(2)))
    content = F.greatest(F.lit(0.0), 1 - F.col("text_log") / (F.col("texts") * many))
    leaves = nodes.filter("texts > 0").select("host", F.explode("above").alias("node"), F.col("texts").alias("weight"),
                                              (F.when(F.col("pages") > 1, content).otherwise(1.0) * F.col("texts"))
                                              .alias("weighted")) \
        .groupBy("host", "node").agg(F.sum("weight").alias("weight"), F.sum("weighted").alias("weighted"))
    shown = F.when((F.col("pages") > 1) & (F.col("shown") > 0),
                   (F.log("shown") - F.col("shown_log") / F.col("shown")) / many).otherwise(1.0)
    total = nodes.filter("node = 0").select("host", F.col("pages").alias("of"))
    blend = F.pow(F.lit(G), F.col("styles"))
    return nodes.filter("node <> 0").join(leaves, ["host", "node"]).join(total, "host").select(
        "host", F.col("node").alias("branch"), "pages", "of",
        ((1 - blend) * shown + blend * F.col("weighted") / F.col("weight")).alias("importance"))


def _branches(pages: DataFrame) -> DataFrame:
    """(host, page, branch): the branches of each distinct page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for h, p, page in zip(b.column("host").to_pylist(), b.column("page").to_pylist(), b.column("html")):
                nodes = {k for block in parse(page.as_py())[0] if not block.dropped for k in block.keys}
                rows += [(h, p, k) for k in nodes]
            kinds = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             names=["host", "page", "branch"])

    return map_in_arrow(pages.select("host", "page", "html"), run, "host string, page long, branch long")


def extract(pages: DataFrame, keep: list[str], url: str = "url", html: str = "html") -> DataFrame:
    """``keep`` and ``main_text`` of every page."""
    src = pages.select(*[F.col(c) for c in keep], host(F.col(url)).alias("__host"), F.col(html).alias("__html"),
                       F.xxhash64(html).alias("__page"))
    named = src.select(F.col("__host").alias("host"), F.col("__html").alias("html"), F.col("__page").alias("page"))
    low = branch_importance(named).filter((F.col("importance") < LEAST) & (F.col("pages") >= MIN_PAGES)) \
        .select("host", "branch", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = _branches(named).withColumn("salt", F.pmod("page", F.lit(SALTS)).cast("int"))
    noise = own.join(low, ["host", "branch", "salt"]).groupBy("host", "page") \
        .agg(F.collect_set("branch").alias("__noise")) \
        .withColumnRenamed("host", "__host").withColumnRenamed("page", "__page")
    joined = src.join(freeze(noise, "site-noise"), ["__host", "__page"], "left")

    def make():
        return lambda page, found: (main_text(page, set(found or ())),)

    return map_columns(joined, ["__html", "__noise"], [T.StructField("main_text", T.StringType(), False)], keep, make)
