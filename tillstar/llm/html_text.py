"""Main text of web pages: site template removal by counting element subtrees per host.

A page is read once from start to end; what an element held is cut from the output when it closes, so no tree is kept.
An element goes if its subtree (tag, class, id and content, by hash) is a template: one that recurs on ``MANY_PAGES`` different pages of its host, or, on hosts too small
for that, on at least ``MIN_PAGES`` and ``MIN_SHARE`` of its pages. Items, cells and inline elements need the share on
large hosts too, as the same word or number stands in many texts. Where the counts do not tell (a host of few pages,
a box that differs from page to page), it goes if its tag, or a word of its class, id or role, names boilerplate.
Subtrees are counted per host in Spark, those with such names and those inside them too. Inside an article different
article texts (as the names leave them) are counted instead of pages, and their share is that of the article texts of the
host: an article that is copied to many pages is one text, so its blocks are no templates. Not counted are html, body,
articles themselves and, inside an article, its headings, paragraphs, items, cells and inline elements: articles share
passages, which are wanted. All are counted, but only those whose removal changes the page's output (``live``: they hold
some of it that the names leave) are looked up among the templates and sent back to their pages.

The text of article or main elements is the main text; a page without any has that of its body. Blocks are the
stretches between starts and ends of block elements; references are decoded, white space inside a block becomes one
space, blocks are trimmed, empty ones dropped, the others joined by a line feed.

Results for special rows: null html is empty, its text is empty; a null url is a host of its own; repeated pages are
one page for the counts and a row each in the result; rows without page_id are kept. Tags that are not closed end with
their parent; a tag cut off at the end of the page is dropped.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import small_batches
from tillstar.operators.skew import join_repeated
from tillstar.session import stored

MIN_PAGES, MIN_SHARE, MANY_PAGES = 10, 0.2, 100

# Elements of HTML by their role here, and words that name boilerplate in class, id or role.
RAW = {"script", "style"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set(
    "head nav footer aside form script style noscript template iframe svg math button select textarea dialog menu object canvas audio video title".split()
)
BLOCKS = set(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hr html legend li main nav"
    " ol p pre section summary table tbody tfoot thead tr ul aside form".split()
)
MAIN = {"article", "main"}
KEPT_WHOLE = MAIN | {"html", "body"}
TEXT_BLOCKS = MAIN | set("p h1 h2 h3 h4 h5 h6 li dt dd thead tbody tr td th figcaption b i em strong a span code sub sup br".split())
PARTS = set("li dt dd tr td th thead tbody tfoot caption figcaption legend summary".split())  # of a block; what is no block is a part, too
INSIDE = 0x9E3779B97F4A7C15  # mixed into the hash of a subtree inside an article, which is counted apart
BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar"
    " footer masthead cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup share sharing social comment comments"
    " respond reply replies disqus related recommended recommendations widget login search searchbox pagination pager toolbar skip complementary contentinfo".split()
)
#: An end tag or the start of one of these closes an open element of the same set inside the same parent.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul": {"li"}, "ol": {"li"}, "table": {"tr", "td", "th"}, "dl": {"dt", "dd"}}

_MARKUP = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)>|(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|[!?/][^>]*>|[a-zA-Z/!?][^>]*\Z)", re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_WORD = re.compile(r"[a-z0-9]+")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Page:
    """One pass over a page. ``templates`` are subtree hashes to cut; ``counted`` gets all that are counted, and if each is inside an article and a part.

    ``held`` lists those of them that hold some of the output in the end, with the length of the output at their start.
    """

    def __init__(self, source: str, templates=frozenset()):
        self.templates, self.counted = templates, {}
        self.held: list[tuple[int, int]] = []
        self.out: list[tuple[bool, str | None]] = []  # (inside an article, text or None for a block end)
        # open elements: tag, length of the output at the start, cut when it closes, hash, may be counted, in an article
        self.open: list[tuple] = [("", 0, False, xxhash.xxh3_64(), False, False)]
        self.read(source)
        while len(self.open) > 1:
            self.close()

    def text(self, data: str) -> None:
        if data:
            decoded = html.unescape(data) if "&" in data else data
            top = self.open[-1]
            top[3].update("t" + " ".join(decoded.split()))
            if not top[2]:
                self.out.append((top[5], decoded))

    def start(self, tag: str, rest: str) -> None:
        self.imply(tag)
        _, _, cut, _, _, inside = self.open[-1]
        names = {m[1].lower(): m[2].strip("\"'").lower() for m in _NAMES.finditer(rest)} if rest else {}
        own = cut or tag in DROPPED or (tag == "header" and not inside) or (
            tag not in KEPT_WHOLE and bool(names) and not BOILERPLATE.isdisjoint(_WORD.findall(" ".join(names.values())))
        ) or (tag == "article" and "comment" in names.get("class", "")) or bool(rest and tag not in KEPT_WHOLE and _HIDDEN.search(rest))
        inside = inside or tag in MAIN
        if tag in BLOCKS:
            self.out.append((inside, None))
        elif tag in ("br", "td", "th", "img", "wbr"):
            self.out.append((inside, "" if tag == "wbr" else " "))
        if tag in VOID:
            return
        counted = tag not in KEPT_WHOLE and not (inside and tag in TEXT_BLOCKS)
        self.open.append((tag, len(self.out), own, xxhash.xxh3_64(f"<{tag} {sorted(names.items())}"), counted, inside))

    def imply(self, tag: str) -> None:
        """Close what the start of ``tag`` ends."""
        ended = CLOSES.get(tag, {"p"} if tag in BLOCKS else ())
        k = len(self.open) - 1
        while k and ended:
            name = self.open[k][0]
            if name in ended:
                while len(self.open) > k:
                    self.close()
                return
            if name in BLOCKS and name not in ("p",) or name in ("td", "th"):
                return
            k -= 1

    def end(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            name = self.open[k][0]
            if name == tag:
                while len(self.open) > k:
                    self.close()
                return
            if tag in SCOPES.get(name, ()):  # an outer list or table goes on
                return

    def close(self) -> None:
        tag, at, cut, digest, counted, inside = self.open.pop()
        value = digest.intdigest()
        self.open[-1][3].update(value.to_bytes(8, "little"))
        if counted:
            signed = _signed(value ^ INSIDE if inside else value)
            self.counted[signed] = inside, tag not in BLOCKS or tag in PARTS
            cut = cut or signed in self.templates
            if len(self.out) > at:
                self.held.append((signed, at))
        if cut:
            del self.out[at:]
            while self.held and self.held[-1][1] >= at:
                self.held.pop()
        if tag in BLOCKS:
            self.out.append((inside, None))

    def read(self, source: str) -> None:
        at = 0
        while m := _MARKUP.search(source, at):
            self.text(source[at : m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if tag is None:
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                self.end(tag)
                continue
            self.start(tag, m["rest"] or m["rest2"] or "")
            if tag in RAW:
                stop = _RAW_END[tag].search(source, at)
                at = stop.start() if stop else len(source)
        self.text(source[at:])

    def main_text(self) -> str:
        inside = any(flag and data is not None and not data.isspace() and data for flag, data in self.out)
        blocks, parts = [], []
        for flag, data in [*self.out, (True, None)]:
            if data is None:
                if words := "".join(parts).split():
                    blocks.append(" ".join(words))
                parts = []
            elif flag or not inside:
                parts.append(data)
        return "\n".join(blocks)


def _keyed(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    source = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", source.alias("html"), host.alias("host"), F.md5(source.cast("binary")).alias("page"))


def subtrees(pages: DataFrame) -> DataFrame:
    """(host, page, article, subtree, part, live) for every subtree that is counted.

    article is a hash of the main text for subtrees inside an article, else null; subtree is null once for each page, and
    once for the articles of each page that has any.
    """

    def work(batches):
        for batch in batches:
            out = ([], [], [], [], [], [])
            for source, host, page in zip(*(batch.column(c).to_pylist() for c in range(3))):
                read = Page(source)
                article = _signed(xxhash.xxh3_64_intdigest(read.main_text())) if any(flag for flag, _ in read.out) else None
                live = {value for value, _ in read.held}
                rows = [(None, None, None, None), *(((None, article, None, None),) if article is not None else ())]
                rows += [(value, article if inside else None, part, value in live) for value, (inside, part) in read.counted.items()]
                for value, text, part, holds in rows:
                    for column, cell in zip(out, (host, page, text, value, part, holds)):
                        column.append(cell)
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["host", "page", "article", "subtree", "part", "live"])

    return pages.select("html", "host", "page").mapInArrow(work, "host string, page string, article bigint, subtree bigint, part boolean, live boolean")


def templates(found: DataFrame) -> DataFrame:
    """host, subtree and the number of live rows of the subtrees of ``found`` that recur on enough pages or article texts of their host."""
    inside = F.col("article").isNotNull().alias("inside")
    counts = found.groupBy("host", inside, "subtree", "part").agg(
        F.count_distinct(F.coalesce("article", F.xxhash64("page"))).alias("n"), F.count_if("live").alias("rows")
    )
    totals = counts.where("subtree is null").select("host", "inside", F.col("n").alias("pages"))
    often = counts.where("subtree is not null").where(F.col("n") >= MIN_PAGES).join(totals, ["host", "inside"])
    return often.where((F.col("n") >= MIN_SHARE * F.col("pages")) | (~F.col("part") & (F.col("n") >= MANY_PAGES))).select("host", "subtree", "rows")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each row of ``pages`` (page_id, url, html)."""
    small_batches(pages.sparkSession, 64)
    keyed = _keyed(pages)
    found = stored(subtrees(keyed), "subtrees")
    recurring = stored(templates(found).where("rows > 0"), "templates")
    marked = join_repeated(found.where("live").select("host", "page", "subtree"), recurring, ["host", "subtree"], "rows")
    per_page = stored(marked.groupBy("host", "page").agg(F.collect_set("subtree").alias("cuts")), "cuts")  # at most the elements of a page

    def work(batches):
        for batch in batches:
            texts = [Page(source, frozenset(cuts or ())).main_text() for source, cuts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    whole = keyed.join(per_page, ["host", "page"], "left").select("page_id", "url", "html", "cuts")
    return whole.mapInArrow(work, "page_id bigint, url string, text string, n_chars bigint")
