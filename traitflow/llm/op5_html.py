"""Main text of web pages by removing each site's templates.

A page is parsed into a tree of elements. Every block element outside the running text gets a hash of
its subtree (tag names and normalised text, without attributes). Spark counts on how many pages of a host each
hash stands; subtrees that recur on many pages of their host (``MIN_PAGES`` pages and
``MIN_SHARE`` of the host's pages) are its template and are deleted. What also goes, wherever it
stands, is what HTML itself names as not running text (scripts, styles, navigation, headers, footers,
asides, forms, ...) and elements whose class, id or role says the same (adverts, notices,
comments, ...; an article inside an element named like a layout part stays). If the page has an ``article`` or ``main`` element the rest of the page goes too. Inside it neither
the element itself nor a box around most of its blocks, nor paragraphs, headings, lists' items and cells are ever counted as template; other boxes are
template only if they stand in ``MIN_PAGES`` articles that differ (in the longest block outside the box). So passages and
articles that a site publishes twice or a thousand times stay.

Blocks are split at block elements; white space inside a block becomes one space; character references are
decoded; blocks are joined in page order by an empty line.

Plan: one parse sends (host, hash, article, page) rows, the counts are combined aggregations per (host, hash, article) and then (host, hash), the hashes
to delete come back to their page by a join on the page, and a second parse writes the text. A host with a
third of all pages is spread by hash and page.

Edge cases: null or empty html gives an empty text; markup may be unclosed, misnested or cut off; a
null or odd url is a host of its own text; repeated rows (same id, url and html) get the same text and count
as one page; an empty table gives no rows; other columns are ignored; nothing is capped.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C

MIN_PAGES = 10
MIN_SHARE = 0.02
SENTENCE = 40            # characters

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
NOT_TEXT = frozenset("script style head title noscript iframe template svg canvas object nav header footer aside form button select option textarea "
                     "dialog menu label input audio video map datalist noembed noframes".split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption summary address".split())
BOXES = frozenset("div section ul ol dl table tbody thead tfoot tr figure fieldset details center body html article main hgroup search".split())
BLOCKS = FLOW | BOXES | NOT_TEXT | {"hr"}
# start tags that end an open element of the named kinds
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
          "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": ("tbody",), "tfoot": ("tr", "td", "th", "tbody")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",),
          "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
# words of class, id or role that name something else than running text
CHROME = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner cookie cookies consent gdpr notice notices notification "
                   "alert popup modal overlay sidebar sidenav nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager header masthead footer colophon toolbar "
                   "comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations newsletter subscribe subscription signup login "
                   "search searchbox form widget widgets skip complementary contentinfo".split())

# names that hold for paragraphs and headings too, and that an article inside does not undo
OTHERS_TEXT = frozenset("ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion cookie cookies consent gdpr "
                        "comment comments commentlist disqus reply replies respond newsletter share sharing".split())
# parts of a name that turn its meaning ("has-sidebar", "comments-open")
TURNED = frozenset("has have with no not without is".split()), frozenset("open closed enabled disabled free off none".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</([a-zA-Z][^\s/>]*)[^>]*>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


HASHES = pa.list_(pa.struct([("hash", pa.int64()), ("article", pa.int64())]))
KEPT, LAYOUT, REMOVED = 0, 1, 2     # LAYOUT: not text, unless an article or main element stands inside


def named_chrome(tag: str, attrs: str, nested: bool = False) -> int:
    """What the attributes of an element say about it. Names do not remove an article or main element, unless it is ``nested`` in
    an article (a comment)."""
    found = KEPT
    for m in _ATTR.finditer(attrs or ""):
        name, value = (m[1] or "").lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" and value.strip().lower() != "until-found" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _UNSEEN.search(value):
            return REMOVED
        if name not in ("class", "id", "role") or tag in ("article", "main") and not nested:
            continue
        for word in value.split():
            parts = [w.lower() for w in _PART.findall(word)]
            if not parts or parts[0] in TURNED[0] or parts[-1] in TURNED[1]:
                continue
            if not OTHERS_TEXT.isdisjoint(parts):
                found = REMOVED
            elif tag not in FLOW and not CHROME.isdisjoint(parts):
                found = max(found, LAYOUT)
    return found


class Element:
    __slots__ = ("tag", "start", "digest", "gone", "home", "has_main", "first")

    def __init__(self, tag, gone, home, first):
        self.tag, self.gone, self.home, self.first = tag, gone, home, first
        self.digest = xxhash.xxh64(tag)
        self.has_main = False


def parse(page: str):
    """Blocks and elements of a page: ([(text, gone, in main part)], [(tag, hash, first block, end block,
    eligible as template, main part or -1)], the main parts' (first block, end block))."""
    blocks: list[tuple[str, bool, bool]] = []
    elements: list[tuple[str, int, int, int, bool, int]] = []
    stack = [Element("", KEPT, -1, 0)]
    run: list[str] = []
    mains: list[tuple[int, int]] = []

    def flush():
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            run.clear()
            if text:
                top = stack[-1]
                blocks.append((text, top.gone != KEPT, top.home >= 0))
                top.digest.update("\0" + text)

    def close():
        if stack[-1].tag in BLOCKS:
            flush()
        e = stack.pop()
        value = e.digest.intdigest()
        stack[-1].digest.update(value.to_bytes(8, "little"))
        if e.has_main:
            stack[-1].has_main = True
        own = e.home != stack[-1].home      # e is a main part itself
        if own:
            mains[e.home] = (e.first, len(blocks))
        if e.tag in BLOCKS and not e.gone and len(blocks) > e.first:
            eligible = not e.has_main and not own and not (e.home >= 0 and e.tag in FLOW)
            elements.append((e.tag, value - (1 << 64) if value >> 63 else value, e.first, len(blocks), eligible, e.home))

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!][^<]*\Z", rest)      # a tag that the page's end cuts off
            run.append(rest[:cut.start()] if cut else rest)
            break
        if m.start() > at:
            run.append(page[at:m.start()])
        at = m.end()
        if m[1]:
            tag, attrs = m[1].lower(), m[2]
            if tag in VOID:
                if tag == "br":
                    run.append(" ")
                elif tag == "hr":
                    flush()
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
                continue
            if tag in BLOCKS:
                flush()
                if tag != "p" or stack[-1].tag != "p":
                    ends = CLOSES.get(tag, ())
                    if ends:
                        scope = SCOPES[tag]
                        depth = len(stack) - 1
                        while depth and stack[depth].tag not in scope:
                            if stack[depth].tag in ends:
                                while len(stack) > depth:
                                    close()
                            depth -= 1
                # a block ends an open paragraph or heading, with what is open inside it
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == "p":
                        while len(stack) > depth:
                            close()
                        break
                    if stack[depth].tag in BLOCKS:
                        break
            top = stack[-1]
            named = named_chrome(tag, attrs, any(e.tag == "article" for e in stack) if tag == "article" else False) if tag not in ("body", "html") else KEPT
            main = tag in ("article", "main") and top.gone != REMOVED and named != REMOVED
            own = LAYOUT if tag == "form" else REMOVED if tag in NOT_TEXT else named     # a form may wrap the whole page
            gone = KEPT if main else max(top.gone, own)
            if attrs.endswith("/") and tag in ("svg", "path"):
                continue
            if main:
                top.has_main = True
                mains.append((len(blocks), len(blocks)))
            stack.append(Element(tag, gone, len(mains) - 1 if main else top.home, len(blocks)))
        elif m[3]:
            tag = m[3].lower()
            if tag == "br":
                run.append(" ")
            elif tag == "p" and not any(e.tag == "p" for e in stack):
                flush()
            else:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        while len(stack) > depth:
                            close()
                        break
                    if tag not in BLOCKS and stack[depth].tag in BLOCKS:
                        break
    while len(stack) > 1:
        close()
    flush()
    return blocks, elements, mains


def templates(blocks, elements, mains) -> list[tuple[int, int | None, int, int]]:
    """(hash, article, first block, end block) of the subtrees that may be template; article is None outside main parts,
    inside it tells the articles apart in which a box stands: the hash of the longest kept block outside all such boxes, or
    if that is no sentence, outside this box."""
    kept = [0]                # kept blocks before each block
    for _, gone, _ in blocks:
        kept.append(kept[-1] + (not gone))
    out, boxes = [], []
    boxed: set[int] = set()
    for _, h, i, j, eligible, home in elements:
        if eligible and home < 0:
            out.append((h, None, i, j))
        elif eligible and 2 * (kept[j] - kept[i]) <= kept[mains[home][1]] - kept[mains[home][0]]:
            boxes.append((h, i, j, home))
            boxed.update(range(i, j))
    longest: dict[int, list[int]] = {}
    for h, i, j, home in boxes:
        if home not in longest:
            by_size = sorted((k for k in range(*mains[home]) if not blocks[k][1]), key=lambda k: -len(blocks[k][0]))
            free = [k for k in by_size if k not in boxed][:1]
            longest[home] = free if free and len(blocks[free[0]][0]) >= SENTENCE else by_size
        value = xxhash.xxh64_intdigest(next((blocks[k][0] for k in longest[home] if not i <= k < j), ""))
        out.append((h, value - (1 << 64) if value >> 63 else value, i, j))
    return out


def candidates(page: str | None) -> list[dict[str, int | None]]:
    """Hashes of the page's subtrees that may be template, each once, with the article it stands in."""
    if not page:
        return []
    return [{"hash": h, "article": a} for h, a in {h: a for h, a, _, _ in templates(*parse(page))}.items()]


def main_text(page: str | None, template: set[int]) -> str:
    if not page:
        return ""
    blocks, elements, mains = parse(page)
    drop = [gone or (bool(mains) and not inside) for _, gone, inside in blocks]
    for h, _, i, j in templates(blocks, elements, mains):
        if h in template:
            drop[i:j] = [True] * (j - i)
    return "\n\n".join(b[0] for b, d in zip(blocks, drop) if not d)


def extracted(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    key = F.xxhash64("page_id", "url", "html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", key.alias("key"))

    def hashes(batches):
        for batch in batches:
            found = [candidates(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, HASHES)], names=["host", "key", "hashes"])

    def texts(batches):
        for batch in batches:
            out = [main_text(p.as_py(), set(t.as_py() or ())) for p, t in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    parsed = C.written(rows.select(host.alias("host"), "key", "html").mapInArrow(hashes, "host string, key long, hashes array<struct<hash: bigint, article: bigint>>"), "html-hashes")
    seen = parsed.distinct()
    sizes = seen.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("pages"))
    each = seen.select("host", "key", F.inline("hashes"))
    # one article counts once however many pages print it
    counted = each.groupBy("host", "hash", "article").agg(F.count(F.lit(1)).alias("n"))
    often = (counted.groupBy("host", "hash").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("article").isNull(), F.col("n")).otherwise(1)).alias("articles"))
             .filter(F.col("articles") >= min_pages))
    template = (often.join(sizes, F.col("host") == F.col("of")).filter(F.col("n") >= min_share * F.col("pages"))
                .select(F.col("host").alias("th"), F.col("hash").alias("tt")))
    dropped = (each.join(template, (F.col("host") == F.col("th")) & (F.col("hash") == F.col("tt")))
               .groupBy(F.col("key").alias("k")).agg(F.collect_set("hash").alias("template")))
    return (rows.join(dropped, F.col("key") == F.col("k"), "left").select("page_id", "url", "html", "template")
            .mapInArrow(texts, "page_id long, url string, text string, n_chars long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(C.table(spark, sf_dir, "pages"))
