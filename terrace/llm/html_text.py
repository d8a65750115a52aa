"""Main text of web pages by a site style tree (operator 8).

A page becomes its text blocks in order, each with its style path (the
chain of block containers with their classes).  The pages of a host are
merged into one tree: per path, the distinct pages that have it, how their
child structure varies (presentation) and how their blocks vary (content).
A block that c of a host's m distinct pages show has content entropy
log(c) / log(m): 0 where only one page has it, 1 where all do.  A path's
importance mixes one minus its blocks' mean entropy with the entropy of its
child structure.  Branches of low importance are removed from each page.

The tree is a few grouped counts over (host, path, block) digests; the
texts stay where they are.  Exact copies of a page count once, so a
republished article does not become a template.

Every block of every page is in the tree; what markup declares only raises or
lowers a block's importance (``SHIFT``): up inside an article or main element;
down in containers named as menus, notices, adverts, comments and so on; far
down in navigation, footers, asides and hidden elements, and outside of the
article on a page that has one.  Names are whole class tokens or ids, never of
inline elements, html, body, main, article or an element that holds one of
these two, and are not believed where the named branches hold most of a page.
Branches named as reader comments (``COMMENT_WORDS``) go whatever they hold, articles
and main text by size included, unless the page has nothing else.
Pages of a host with the same blocks that count are one page.

Raw elements are dropped, and so are embedded ones (``EMBEDDED``) that their own
end tag closes; of those left open, nothing is.

Defined cases: null html is empty (text empty); null url has host ``''``; a
host with fewer than ``LEAST_PAGES`` distinct pages has no evidence of
templates, so only markup decides; unclosed and stray tags are tolerated;
repeated rows each get a result; a null key stays null; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from terrace.llm.common import prepare, stored, table

LEAST_PAGES = 3             # distinct pages of a host before entropy counts
LOW = 0.35                  # a block of less importance is removed
CONTENT_SHARE = 0.8         # of a path's importance; the rest is presentation
NO_EVIDENCE = 0.8           # importance where the tree says nothing

RAW = "script style noscript template iframe textarea title"
EMBEDDED = frozenset("svg object canvas select datalist button audio video".split())
SKIPPED = frozenset("head map".split())
BOILER_TAGS = frozenset("nav footer aside".split())
NAMED_TAGS = frozenset("form dialog menu fieldset".split())
MAIN_TAGS = frozenset("article main".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br img math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle msub msup "
                   "msubsup munder mover munderover mtable mtr mtd mpadded mphantom semantics annotation".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = frozenset("p li dt dd tr td th option thead tbody tfoot".split())   # a second one ends the first
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended "
    "comment comments disqus replies widget pagination pager toolbar search copyright hidden".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())

COMMENT_WORDS = frozenset("comment comments disqus replies".split())

# A quote opens a value only right after an equals sign; elsewhere it is a letter like others.
ATTRIBUTES = r"(?:[^>=]|=(?:\s*(?:\"[^\"]*\"|'[^']*'))?)*+"
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)"
                   r"|<(" + "|".join(RAW.split()) + r")(?=[\s/>])" + ATTRIBUTES + r">(?:(?<=/>)|.*?(?:</\1\s*>|\Z))"
                   r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(" + ATTRIBUTES + r")>|<[!?][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

BOILER, OUTSIDE, NAMED, PLAIN, MAIN = range(5)
SHIFT = [-1.0, -0.7, -0.5, 0.0, 0.2]        # of importance, by standing


def _names(tag: str, attributes: str) -> tuple[str, set[str], bool]:
    """Style name of an element, the words that name it, and whether it is hidden."""
    if not attributes.strip(" /"):
        return tag, set(), False
    values = {k.lower(): html.unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(attributes)}
    label = " ".join(sorted(values.get("class", "").lower().split()))
    words = {*label.split(), *values.get("id", "").lower().split()}
    if values.get("role", "").lower() in BOILER_ROLES:
        words.add("nav")
    hidden = "hidden" in values or values.get("aria-hidden") == "true" \
        or "display:none" in values.get("style", "").replace(" ", "").lower()
    return f"{tag}.{label}" if label else tag, words, hidden


def blocks(page: str) -> list[tuple[str, int, str]]:
    """(style path, standing, text) of every non-empty text block, in page order."""
    out: list[tuple[str, bool, bool, int, str]] = []            # path, boiler, in main, name, text
    stack: list[tuple] = []                          # tag, style name, boiler, in main, nearest name, opened
    parts: list[str] = []
    above = [0]                                      # the name around each name; 0: none
    cleared: set[int] = {0}                          # names of elements that hold an article
    remarks: set[int] = set()                        # names of reader comments
    at, end, last = 0, page.rfind(">") + 1, None     # no tag ends after the last >

    def named(around: int) -> int:
        above.append(around)
        return len(above) - 1

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                state = stack[-1][2:5] if stack else (False, False, 0)
                out.append((">".join(s[1] for s in stack if s[0] not in EMBEDDED), *state, text))
            parts.clear()

    for m in TOKEN.finditer(page, 0, end):
        last = m
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if m[2]:
            if tag in EMBEDDED:                      # closed by its own end: as if it were not there
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        n_out, before = stack[i][5]
                        del out[n_out:], stack[i:]
                        parts[:] = before
                        break
                continue
            if tag in INLINE and not any(s[0] == tag for s in stack):
                continue
            end_block()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag == "br":
            parts.append(" ")
        if tag in VOID:
            if tag == "hr":
                end_block()
            continue
        closed = m[4].endswith("/")
        if tag in EMBEDDED:
            if not closed:
                state = stack[-1][2:5] if stack else (False, False, 0)
                stack.append((tag, tag, *state, (len(out), parts.copy())))
            continue
        style, words, hidden = _names(tag, m[4])
        boiler = hidden or tag in BOILER_TAGS or tag in SKIPPED \
            or tag == "header" and not any(s[0] in MAIN_TAGS for s in stack)
        if tag in INLINE and not boiler or closed and tag in INLINE:
            continue
        end_block()
        if tag in SELF_CLOSING:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] not in SELF_CLOSING and stack[i][0] not in INLINE:
                    break
        elif stack and stack[-1][0] == "p" and tag not in INLINE:
            stack.pop()
        if tag in ("body", "article", "main"):        # a head or menu left open ends here
            for i, s in enumerate(stack):
                if s[0] in ("head", "nav", "header", "menu"):
                    del stack[i:]
                    break
        _, _, up_boiler, in_main, names, _ = stack[-1] if stack else ("", "", False, False, 0, None)
        remark = bool(words & COMMENT_WORDS) and tag not in INLINE and tag not in ("html", "body", "main")
        if tag in MAIN_TAGS:
            around = names
            while around not in cleared:              # all names around a cleared one are cleared
                cleared.add(around)
                around = above[around]
            in_main = True
            if remark:                                # a comment is commonly an article of its own
                names = named(names)
                remarks.add(names)
        elif tag in NAMED_TAGS or tag not in INLINE and tag not in ("html", "body") and words & BOILER_WORDS:
            names = named(names)
            if remark:
                remarks.add(names)
        stack.append((tag, style, boiler or up_boiler, in_main, names, None))
    if last is not None and _left_open(last, end):    # it swallows what follows
        at = len(page)
    if at < len(page):
        rest = page[at:]
        parts.append(rest[:rest.find("<")] if re.match(r"[^<]*<[a-zA-Z/!][^>]*\Z", rest) else rest)
    end_block()
    inside, uncleared = [False], [False]              # by name: within reader comments; within a name that holds
    for n in range(1, len(above)):
        inside.append(n in remarks or inside[above[n]])
        uncleared.append(n not in cleared or uncleared[above[n]])
    said = [inside[name] for *_, name, _ in out]
    if all(r or b for r, (_, b, *_) in zip(said, out)):      # nothing else on the page: not what the names say
        said = [False] * len(out)
    return _standings([(path, boiler or remark, main, uncleared[name], text)
                       for remark, (path, boiler, main, name, text) in zip(said, out)])


def _left_open(m: re.Match, end: int) -> bool:
    """A comment or raw element that nothing closes up to the page's last tag."""
    if m.end() < end:
        return False
    if m[1]:
        return not re.search(rf"(?:</{m[1]}\s*|/)>\Z", m[0], re.I)
    return m[0].startswith("<!--") and not (m[0].endswith("-->") and len(m[0]) >= 7)


def _standings(found: list[tuple[str, bool, bool, bool, str]]) -> list[tuple[str, int, str]]:
    has_main = any(main and not boiler for _, boiler, main, _, _ in found)
    size = [0, 0]
    for _, boiler, main, named, text in found:
        if not boiler and main == has_main:
            size[named] += len(text)
    believed = size[0] >= size[1]
    return [(path, BOILER if boiler else OUTSIDE if main != has_main else NAMED if named and believed
             else MAIN if main else PLAIN, text) for path, boiler, main, named, text in found]


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


TREE = pa.schema([("host", pa.int64()), ("page", pa.int64()), ("content", pa.int64()), ("blocks", pa.list_(pa.struct(
    [("path", pa.int64()), ("block", pa.int64()), ("shape", pa.int64()), ("standing", pa.int8())])))])
TREE_SQL = "host long, page long, content long, blocks array<struct<path:long,block:long,shape:long,standing:tinyint>>"


def style_tree(pages: DataFrame) -> DataFrame:
    """All blocks (digests) of each page, and the digest of those that count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, contents = [], []
            for text in b.column(2).to_pylist():
                found = blocks(text or "")
                shapes: dict[str, list[str]] = {}
                for path, _, _ in found:
                    up, _, tail = path.rpartition(">")
                    shapes.setdefault(up, []).append(tail)
                shape = {up: digest(" ".join(tails)) for up, tails in shapes.items()}
                row = [{"path": digest(path), "block": digest(block), "shape": shape[path.rpartition(">")[0]],
                        "standing": s} for path, s, block in found]
                contents.append(digest(repr([tuple(r.values()) for r in row if r["standing"] >= NAMED])))
                rows.append(row)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(contents, pa.int64()),
                                              pa.array(rows, TREE.field("blocks").type)], schema=TREE)

    return pages.select("host", "page", "html").mapInArrow(run, TREE_SQL)


def flips(tree: DataFrame) -> DataFrame:
    """host, page, flip: positions where a page's tree decides otherwise than markup alone."""
    one = stored(tree.dropDuplicates(["host", "content"]).select("host", "blocks"), "style_pages")
    m = one.groupBy("host").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= LEAST_PAGES)

    def pages_with(field: str) -> DataFrame:
        pairs = F.array_distinct(F.transform("blocks", lambda x: F.struct(x["path"], x[field])))
        return (one.select("host", F.explode(pairs).alias("x")).select("host", "x.*")
                .groupBy("host", "path", field).agg(F.count(F.lit(1)).alias("c")))

    per_block = stored(pages_with("block"), "style_blocks")
    content = per_block.groupBy("host", "path").agg(F.avg(F.log("c")).alias("log_c"))
    # entropy of the child structure, in the base of the pages that have the path
    spread = (pages_with("shape").groupBy("host", "path").agg(
        F.sum("c").alias("all"), F.sum(F.col("c") * F.log("c")).alias("sum"))
        .withColumn("presentation", F.when(F.col("all") > 1, (F.log("all") - F.col("sum") / F.col("all")) / F.log("all"))
                    .otherwise(1.0)))
    paths = content.join(spread, ["host", "path"]).join(m, "host").select(
        "host", "path", "m", "all", (CONTENT_SHARE * (1 - F.col("log_c") / F.log("m"))
                                     + (1 - CONTENT_SHARE) * F.col("presentation")).alias("importance"))
    found = (per_block.join(stored(paths, "style_paths"), ["host", "path"])
             .withColumn("importance", F.least(1 - F.log("c") / F.log("m"), "importance")))
    shift = lambda s: F.lit(SHIFT[s])
    gone, plain_gone = F.col("importance") + shift(MAIN) < LOW, F.col("importance") + shift(PLAIN) < LOW
    named_stays = (F.col("importance") + shift(NAMED) >= LOW) & (F.col("all") >= LEAST_PAGES)
    decided = found.select("host", "path", "block", F.filter(F.array(
        F.when(gone, MAIN), F.when(plain_gone, PLAIN), F.when(named_stays, NAMED)), lambda s: s.isNotNull()).alias("standings"))
    named = (tree.select("host", F.explode("blocks").alias("x")).where(F.col("x.standing") == NAMED)
             .select("host", "x.path").distinct())
    low = decided.where(F.array_contains("standings", PLAIN)).unionByName(
        decided.where(F.array_contains("standings", NAMED)).join(named, ["host", "path"], "left_semi"))
    low = stored(low, "style_decided")
    placed = (tree.select("host", "page", F.posexplode("blocks").alias("pos", "x"))
              .select("host", "page", "pos", "x.path", "x.block", F.col("x.standing").cast("int").alias("standing"))
              .where(F.col("standing") >= NAMED))
    return (placed.join(low, ["host", "path", "block"]).where(F.array_contains("standings", F.col("standing")))
            .groupBy("host", "page").agg(F.collect_set("pos").alias("flip")))


def kept_text(page: str, flip: set[int]) -> str:
    """Blocks that markup keeps, but for those at ``flip``, where the tree decides otherwise."""
    return "\n".join(t for i, (_, s, t) in enumerate(blocks(page)) if (NO_EVIDENCE + SHIFT[s] >= LOW) != (i in flip))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""
    keyed = pages.select("page_id", "url", "html", F.xxhash64(host(F.col("url"))).alias("host"),
                         F.xxhash64(F.coalesce("html", F.lit(""))).alias("page"))
    tree = stored(style_tree(keyed), "style_tree")
    # Stored, so that its size is known: pages move only if the flips outgrow a broadcast.
    flipped = stored(flips(tree), "style_flips")
    joined = keyed.join(flipped, ["host", "page"], "left").select("page_id", "url", "html", "flip")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [kept_text(h or "", set(d or ())) for h, d in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    out = StructType([joined.schema["page_id"], joined.schema["url"],
                      StructField("text", StructType.fromDDL("t string")[0].dataType)])
    return joined.mapInArrow(run, out)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(table(prepare(spark), sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
