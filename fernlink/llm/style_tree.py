"""HTML extraction with a site style tree.

All pages of a host are merged into one tree: element nodes are identified by
their chain of tags with class, id and role; below each, the presentation styles
(sequences of child elements) and contents (text blocks and links) of all pages
are counted. An element whose presentation varies, or whose content differs from
page to page, is important; what repeats over the site is not. The composite
importance of a page's branches joins presentation and content; branches in which
no part reaches the least importance go, inside an article or main element as
outside, and so do those that their tag or class marks as furniture, which is all
there is to judge by on a host with few pages. Inside an article or main element
an element's importance starts near 1 and falls as more pages show it unvaried.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlink.llm import common

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
DROPPED = {"nav", "aside", "footer", "form", "script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "button", "select", "textarea", "dialog", "head", "menu", "title", "audio", "video", "map"}
MAIN = {"article", "main"}
ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "select", "menu"}
#: Words of class names and ids that mark furniture anywhere, and those that may also name parts of an article's own text.
ANYWHERE = "ads? advert\\w* banner sponsor\\w* promo\\w* cookies? consent gdpr notices? popup modal overlay sidebar nav\\w* menu\\w* breadcrumbs? footer comments? commentlist disqus replies respond related recommended newsletter subscribe signup login widgets? toolbar pagination pager"
OUTSIDE = "header masthead topbar alert side rail reply share sharing social search toc skip copyright legal"


def _named(words: str) -> re.Pattern:
    return re.compile(rf"(?:^|[-_\s])(?:{words.replace(' ', '|')})(?:$|[-_\s\d])", re.I)


FURNITURE = (_named(ANYWHERE), _named(OUTSIDE))
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar", "alertdialog"}


@dataclass
class Node:
    tag: str
    key: int
    marked: int  # as furniture: 2 anywhere, 1 outside an article or main element, else 0
    children: list = field(default_factory=list)  # nodes and text, in page order


def _hash(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def parse(page: str) -> Node:
    """A page's tree. Broken markup is mended as browsers do: open elements end where their kind must."""
    root = Node("", _hash("root"), 0)
    stack = [root]
    known: dict[tuple, tuple[int, int]] = {}
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            if page[at:].strip():
                stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("td", "th", "table", "article", "main", "body") and tag not in ENDS_P | {"body", "html", "table", "tr", "tbody", "thead"}:
                    break
            continue
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE:
                    break
        elif tag in SIBLINGS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SIBLINGS[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES:
                    break
        if tag == "body":
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "head":
                    del stack[i:]
                    break
        given = m[3]
        sign = (stack[-1].key, tag, given if "=" in given else "")
        if sign not in known:
            got = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(given)} if "=" in given else {}
            names = f"{got.get('class', '')} {got.get('id', '')}"
            hidden = got.get("role", "").lower() in ROLES or "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "").lower()
            marked = 2 if hidden or (FURNITURE[0].search(names) and tag not in HEADINGS) else int(any(f.search(names) for f in FURNITURE))
            known[sign] = (_hash(stack[-1].key, tag, got.get("class", ""), re.sub(r"\d+", "#", got.get("id", "")), got.get("role", "")), marked)
        node = Node(tag, *known[sign])
        if tag == "a" and (href := ATTRIBUTE.search(given)):
            node.children.append(("href", href[0]))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            if tag in ("textarea", "title"):
                node.children.append(page[at : end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID and not given.endswith("/"):
            stack.append(node)
    return root


def summary(root: Node) -> list[tuple[int, int, list[int]]]:
    """(element, presentation style, content features) of a page; the elements of one key count together."""
    styles: dict[int, list[int]] = {}
    contents: dict[int, set[int]] = {}
    todo = [root]
    while todo:
        node = todo.pop()
        style = styles.setdefault(node.key, [])
        content = contents.setdefault(node.key, set())
        for c in node.children:
            if isinstance(c, Node):
                if not style or style[-1] != c.key:  # a run of equal children counts once
                    style.append(c.key)
                todo.append(c)
            elif isinstance(c, tuple):
                content.add(_hash(*c))
            elif c.strip():
                content.add(_hash(" ".join(c.split())))
    return [(k, _hash(*styles[k]), sorted(contents[k])) for k in styles]


def composite(root: Node, known: dict[int, tuple[float, float, int]], decay: float, doubt: float = 5.0) -> dict[int, float]:
    """The greatest composite importance in each node's branch (by identity of the node).

    A node's composite importance is its presentation's and its content's, then its
    children's, decaying. ``known``: presentation, content and number of pages of an
    element; inside an article or main element ``doubt`` more pages, all different,
    are counted in.
    """
    order, todo = [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node.tag in MAIN
        order.append((node, inside))
        todo += [(c, inside) for c in node.children if isinstance(c, Node)]
    out: dict[int, float] = {}
    peak: dict[int, float] = {}
    for node, inside in reversed(order):
        shape, content, pages = known.get(node.key, (1.0, 1.0, 1))
        if inside:
            shape, content = ((x * pages + doubt) / (pages + doubt) for x in (shape, content))
        nodes = [id(c) for c in node.children if isinstance(c, Node)]
        below = [out[c] for c in nodes]
        if any(isinstance(c, (tuple, str)) and (isinstance(c, tuple) or c.strip()) for c in node.children):
            below.append(content)
        mine = (1 - decay ** len(below)) * shape + decay ** len(below) * (sum(below) / len(below)) if below else content
        if below and max(below) < mine:
            mine = max(below)  # varied presentation of worthless parts is worthless
        out[id(node)], peak[id(node)] = mine, max([mine, *(peak[c] for c in nodes)])
    return peak


def main_text(root: Node, importance: dict[int, float], least: float) -> str:
    """Blocks of the branches that stay. Importance, tags and marks judge every branch; in the running text of an article or main element, an inline element stays with its sentence."""
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        if text := " ".join(entities.unescape("".join(run)).split()):
            blocks.append(text)
        run.clear()

    def gone(node: Node, inside: bool, flow: bool) -> bool:
        if node.tag in DROPPED or node.marked == 2 or ((node.marked or node.tag == "header") and not inside):
            return True
        return importance[id(node)] < least and not (inside and flow and node.tag in INLINE)

    todo: list = [(root, False, False)]
    while todo:
        x, inside, closing = todo.pop()
        if isinstance(x, str):
            run.append(x)
            continue
        block = x.tag not in INLINE
        if block:
            end()
        elif x.tag == "br":
            run.append(" ")
        if closing:
            continue
        if block:
            todo.append((x, inside, True))
        inside = inside or x.tag in MAIN
        flow = any(isinstance(c, str) and c.strip() for c in x.children)
        for c in reversed(x.children):
            if isinstance(c, str) or (isinstance(c, Node) and not gone(c, inside, flow)):
                todo.append((c, inside, False))
    end()
    return "\n\n".join(blocks)


def extract(pages: DataFrame, least: float = 0.25, decay: float = 0.9, salts: int = 64) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty html gives an empty text. A null url, or one without a host,
    belongs to one common host. Pages that repeat count once in the site's tree and
    give a row each. Other columns are ignored; an empty table gives no rows. A host
    may hold any share of the pages: counts are summed before and spread over
    ``salts`` parts of a host.
    """
    common.ship(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("host", host).withColumn("page", F.xxhash64("host", "html"))

    def summaries(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("element", pa.int64()), ("style", pa.int64()), ("features", pa.list_(pa.int64()))]))
        for batch in batches:
            for part, some in common.text_slices(batch, column="html"):
                nodes = [[{"element": k, "style": s, "features": f} for k, s, f in summary(parse(h))] for h in some]
                yield pa.RecordBatch.from_arrays([part.column("host"), part.column("page"), pa.array(nodes, kind)], ["host", "page", "nodes"])

    seen = common.mapped(rows.select("host", "page", "html"), summaries, "host string, page long, nodes array<struct<element:long,style:long,features:array<long>>>", "style_tree")
    seen = common.staged(seen.dropDuplicates(["host", "page"]), "pages")
    nodes = seen.select("host", "page", F.explode("nodes").alias("n")).select("host", "page", "n.*")
    # presentation: entropy of the styles of an element over the pages that have it, in units of its greatest possible value
    style = nodes.groupBy("host", "element", "style").agg(F.count("*").alias("c"))
    shape = style.groupBy("host", "element").agg(F.sum("c").alias("m"), F.sum(F.expr("c * ln(c)")).alias("clogc"))
    feature = nodes.select("host", "element", F.explode("features").alias("f")).groupBy("host", "element", "f").agg(F.count("*").alias("c"))
    content = feature.groupBy("host", "element").agg(F.avg(F.ln("c")).alias("logc"))
    stats = shape.join(content, ["host", "element"], "left").select(
        "host", "element",
        F.when(F.col("m") == 1, 1.0).otherwise((F.ln("m") - F.col("clogc") / F.col("m")) / F.ln("m")).cast("float").alias("shape"),
        F.when((F.col("m") == 1) | F.col("logc").isNull(), 1.0).otherwise(1 - F.col("logc") / F.ln("m")).cast("float").alias("content"),
        F.least("m", F.lit(2**31 - 1)).cast("int").alias("pages"),
    ).where("shape < 1 or content < 1")
    stats = stats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    of_page = nodes.select("host", "page", "element").withColumn("salt", F.pmod("page", F.lit(salts)).cast("int")).join(stats, ["host", "element", "salt"])
    known = of_page.groupBy("page").agg(F.collect_list(F.struct("element", "shape", "content", "pages")).alias("known"))  # as many as a page has elements

    def packed(batches: Iterator) -> Iterator:
        """The html in zstd, which is smaller in the shuffle than Spark's own compression makes it."""
        import pyarrow as pa

        for batch in batches:
            html = [x.as_buffer() for x in batch.column("html").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "url", "page")), pa.array([x.size for x in html], pa.int64()), pa.array([pa.compress(x, "zstd", asbytes=True) for x in html], pa.binary())],
                ["page_id", "url", "page", "size", "packed"],
            )

    small = common.mapped(rows.select("page_id", "url", "page", "html"), packed, "page_id long, url string, page long, size long, packed binary", "style_tree")
    joined = small.join(known, "page", "left").select("page_id", "url", "size", "packed", "known")

    def texts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for s in common.slices(batch.column("size").to_numpy() + 16, 2_000_000):
                part = batch.slice(s.start, s.stop - s.start)
                out = []
                for n, h, known in zip(part.column("size").to_pylist(), part.column("packed"), part.column("known").to_pylist(), strict=True):
                    root = parse(pa.decompress(h.as_buffer(), n, "zstd").to_pybytes().decode("utf-8", "replace"))
                    out.append(main_text(root, composite(root, {x["element"]: (x["shape"], x["content"], x["pages"]) for x in known or ()}, decay), least))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array(np.fromiter(map(len, out), np.int64, len(out)))], ["page_id", "url", "text", "n_chars"])

    return common.mapped(joined, texts, "page_id long, url string, text string, n_chars long", "style_tree")


def op7_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
