"""Operator 10: main text of web pages by a site style tree.

The DOMs of a host's pages are merged into one tree: a node is a path of
elements with their classes. A node's presentation importance is the entropy
of its child styles over the pages that have it; its content importance is
one minus the mean entropy of its text blocks over those pages (a block on
every page has entropy 1, a block on one page 0). Composite importance is a
weighted sum. Branches of low importance are noise and are removed from each
page, inside an article element too; so is a single block of low importance
that at least half of the pages with its node have. What elements say about
themselves is a prior: that of navigation, forms, advertising, comments and
the like is 0 and stays 0, that of an article element counts as ``PRIOR``
pages of full importance. A page that the tree would leave without any of its
article's blocks (a host of copies of one page) keeps them.

Inside an article only tags, hidden elements and names that are wholly those of
adverts, menus, comments and the like (``_WHOLE``) decide. Any other noise word
there (``search-hit``, ``legal``, ``alert``) is a vote: the node has no prior for
it but ``PRIOR`` pages of no importance, and the tree decides.

Counts of (host, path, style or block) are combined in each map task before
they are shuffled, so a host with a third of the pages is no hot spot; pages
are joined with their host's noise by a broadcast while that is little
(``MAX_NOISE`` rows), else on host and a salt.

Words of class, id and role mark no html, body, main or article element, as
they name the layout there (``has-sidebar``, ``post share``), save articles
within an article, which are its comments. Nor do they mark what is around the
article: when all articles of a page are in marked elements, the marks around
those with the fewest are lifted, unless an element is wholly named as one of
comments or related pages.

Rules for odd input: null or empty html has the empty text; a page without
url is of the host ''; repeated rows are handled alike; hosts with fewer than
``MIN_PAGES`` pages with a node keep it; paths are chained hashes, so memory is
linear in a page's depth; an inline element that is noise ends with its tag,
nested ones of its name counted, or with the block around it, and one that is
never closed is none; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, small_batches, stored, table

MIN_PAGES = 5
LOW = 0.3            # composite importance below which a branch is noise
GAMMA = 0.9          # weight of content against presentation
PRIOR = 1            # pages of full importance that an article element counts as, of none if a word speaks against it
MAX_NOISE = 200_000  # noise paths and blocks that are broadcast, at most (16 bytes each)
SALTS = 64

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)|<[/A-Za-z][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = frozenset("script style textarea noscript template iframe svg math object select canvas audio video title xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
_CLOSES_P = _BLOCK - frozenset("html body tbody tfoot thead tr caption li dd dt".split())
_SELF_CLOSING = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "p": ("p",), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table article section div body main".split())
# Elements and words of class, id and role that mark a branch as not the article.
_NOISE_TAGS = frozenset("head nav footer aside form menu dialog search button label fieldset".split())
_NOISE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notification notifications alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social comment comments disqus reply replies responses related recommended "
    "recommendations widget search pagination pager copyright legal disclaimer complementary contentinfo hidden skip toolbar masthead "
    "topbar".split())
_HEADER_WORDS = frozenset(("header",))
# Names that decide inside an article, where they are the whole name; the other words may name prose there.
_WHOLE = _NOISE_WORDS - frozenset("alert banner copyright disclaimer hidden legal modal notice notification notifications overlay popup search "
                                  "skip social".split())
_UNCLOSED = frozenset("p li dd dt tr thead tbody tfoot option".split())
# Whole names of branches whose articles are other people's or other pages'.
_OTHERS = frozenset("comment comments disqus reply replies responses related recommended recommendations".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DIGITS = re.compile(r"[0-9]+")


class Block(NamedTuple):
    """A text block: its node, whether it is noise by itself, whether it is in an article, the prior of its node (1, 0, -1)."""
    path: int
    noise: bool
    main: bool
    lean: int
    text: str


class _Open(NamedTuple):
    """An open element; ``mark`` is the innermost element around that words mark, ``marks`` how many there are."""
    tag: str
    path: int
    noise: bool
    mark: int
    marks: int
    main: bool
    voted: bool
    article: bool


class _Style(NamedTuple):
    """What an element says about itself: ``named`` by its words alone, ``voted`` by a word that does not decide."""
    name: str
    noise: bool
    named: bool
    main: bool
    voted: bool


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


@lru_cache(maxsize=4096)
def _style(tag: str, raw: str, in_article: bool, nested: bool) -> _Style:
    """``in_article``: within an article or main element; ``nested``: within an article element."""
    a = _attributes(raw)
    names = " ".join(a.get(k, "") for k in ("class", "id", "role", "aria-label" if tag in ("div", "section") else "role")).lower()
    words = set(re.split(r"[^a-z]+", names))
    main = tag in ("article", "main") or a.get("role") in ("main", "article") or a.get("itemprop") == "articleBody"
    noise = (tag in _NOISE_TAGS or "hidden" in a or a.get("aria-hidden") == "true" or bool(_HIDDEN.search(a.get("style", "")))
             or not in_article and tag == "header")
    layout = tag in ("html", "body") or main and not nested
    word = not layout and not words.isdisjoint(_NOISE_WORDS)
    if in_article and not main:
        named = word and not _WHOLE.isdisjoint(names.split())
    else:
        named = word or not layout and not in_article and not words.isdisjoint(_HEADER_WORDS)
    noise = noise or named and not main and not _OTHERS.isdisjoint(names.split())
    label = _DIGITS.sub("0", ".".join(sorted(f"{a.get('class', '')} {a.get('id', '')}".split())))
    return _Style(f"{tag}.{label}" if label else tag, noise, named, main, word and not named)


def _hash(text: str, seed: int = 0) -> int:
    """A signed 64-bit hash; with a node as the seed, that of its child or block."""
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed & 0xFFFFFFFFFFFFFFFF)
    return h - (1 << 64) if h >> 63 else h


def parse(html: str | None) -> tuple[list[Block], dict[int, list[str]]]:
    """The text blocks in page order, and the child styles of each node."""
    blocks: list[tuple[_Open, str]] = []
    styles: dict[int, list[str]] = {}
    stack = [_Open("", 0, False, 0, 0, False, False, False)]
    around: dict[int, int] = {}                # a marked element's next marked element outwards
    opened: Counter[str] = Counter()
    last: dict[str, int] = {}
    text: list[str] = []
    skip, same, inner = "", 0, 0               # an inline element that is noise, its nested namesakes, blocks open within it

    def flush() -> None:
        if text:
            s = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if s:
                blocks.append((stack[-1], s))

    def close(k: int) -> None:
        flush()
        for x in stack[k:]:
            opened[x.tag] -= 1
        del stack[k:]

    def closed_later(tag: str, pos: int) -> bool:
        if tag not in last:
            last[tag] = max((m.start() for m in re.finditer(f"</{re.escape(tag)}(?=[\\s>])", src, re.I)), default=-1)
        return last[tag] >= pos

    src = html or ""
    pos = 0
    while True:
        m = _TOKEN.search(src, pos)
        if not skip and (not m or m.start() > pos):
            text.append(src[pos:m.start() if m else len(src)])
        if not m:
            break
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if not m[4]:
            continue  # a tag cut off by the end of the page
        branch = tag in _BLOCK or tag in _NOISE_TAGS
        if tag in _RAW and not m[1]:
            if not m[3].endswith("/"):
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(src, pos)
                pos = end.end() if end else len(src)
            continue
        if skip:
            step = -1 if m[1] else 0 if m[3].rstrip().endswith("/") else 1
            if tag == skip:
                same += step
                if same == 0:
                    skip = ""
                continue
            if branch and tag not in _UNCLOSED:
                inner += step
            if inner >= 0:
                continue
            skip = ""  # the block around it ends
        if m[1]:
            if branch or tag in ("td", "th"):
                for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                    if stack[k].tag == tag:
                        close(k)
                        break
                    if tag in ("p", "li") and stack[k].tag in _SCOPE:
                        break
                else:
                    flush()
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            else:
                text.append(" ")
            continue
        if tag in ("td", "th"):
            text.append(" ")
            continue
        if not branch:
            if "hidden" in m[3] or "class" in m[3] or "id" in m[3]:
                # inline elements that say they are noise are branches too
                own = _style(tag, m[3], stack[-1].main, False)
                if (own.noise or own.named) and not m[3].rstrip().endswith("/") and closed_later(tag, pos):
                    skip, same, inner = tag, 1, 0
            continue
        flush()
        if tag in ("html", "body") and opened[tag]:
            continue
        if stack[-1].tag == "head" and tag != "head":
            close(len(stack) - 1)
        if tag in _CLOSES_P and stack[-1].tag == "p":
            close(len(stack) - 1)
        for k in range(len(stack) - 1, 0, -1) if tag in _SELF_CLOSING else ():
            if stack[k].tag in _SELF_CLOSING[tag]:
                close(k)
                break
            if stack[k].tag in _SCOPE:
                break
        up = stack[-1]
        own = _style(tag, m[3], up.main, up.main and up.article)
        styles.setdefault(up.path, []).append(own.name)
        if not m[3].rstrip().endswith("/"):
            mark = up.mark
            if own.named:
                mark = m.start() + 1
                around[mark] = up.mark
            stack.append(_Open(tag, _hash(own.name, up.path), up.noise or own.noise, mark, up.marks + own.named,
                               (up.main and not own.named or own.main) and not own.noise, up.voted or own.voted, up.article or tag == "article"))
            opened[tag] += 1
    flush()
    return _lift(blocks, around), styles


def _lift(blocks: list[tuple[_Open, str]], around: dict[int, int]) -> list[Block]:
    """The blocks with the elements around them that words mark; marks around the articles with the fewest are lifted."""
    mains = [at for at, _ in blocks if at.main and not at.noise]
    least = min((at.marks for at in mains), default=0)
    lifted = {0}
    for mark in {at.mark for at in mains if at.marks == least}:
        while mark not in lifted:
            lifted.add(mark)
            mark = around[mark]
    return [Block(at.path, at.noise or at.mark not in lifted, at.main, (-1 if at.voted else 1) if at.main else 0, text) for at, text in blocks]


def _nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Once per page: (host, path, 0, lean, child styles) and (host, path, 1, lean, block) as hashes, of blocks that aren't noise by themselves."""
    for b in batches:
        rows: list[tuple[int, int, int, int, int]] = []
        for host, html in zip(b["host"], b["html"]):
            blocks, styles = parse(html)
            leans = {x.path: x.lean for x in blocks if not x.noise}
            rows += [(host, path, 0, lean, _hash(" ".join(styles.get(path, ())))) for path, lean in leans.items()]
            rows += [(host, path, 1, leans[path], h) for path, h in dict.fromkeys((x.path, _hash(x.text, x.path)) for x in blocks if not x.noise)]
        host, path, kind, lean, value = np.array(rows, np.int64).reshape(-1, 5).T
        yield pd.DataFrame({"host": host, "path": path, "kind": kind.astype(np.int32), "lean": lean.astype(np.int32), "value": value})


def counted(pages: DataFrame) -> DataFrame:
    """(host, path, kind, value, n, lean): on how many pages every style and block is; ``pages`` has host (a hash) and html."""
    seen = pages.mapInPandas(_nodes, "host long, path long, kind int, lean int, value long")
    return seen.groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("n"), F.max("lean").alias("lean"))


def style_tree(n: DataFrame) -> DataFrame:
    """(host, path, pages, lean, importance) of every node that has open blocks; ``n`` is from ``counted``."""
    spread = n.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("style"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("block"),
        F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("blocks"),
        F.max("lean").alias("lean"))
    base = F.log("pages")
    # -sum(p log p) to base m is (log m - sum(n log n) / m) / log m
    look = F.when(F.col("pages") > 1, 1 - F.col("style") / F.col("pages") / base).otherwise(1.0)
    content = F.when(F.col("pages") > 1, 1 - F.col("block") / F.col("blocks") / base).otherwise(1.0)
    return spread.select("host", "path", "pages", "lean", _with_prior(GAMMA * content + (1 - GAMMA) * look).alias("importance"))


def _with_prior(importance):
    return (importance * F.col("pages") + PRIOR * F.greatest("lean", F.lit(0))) / (F.col("pages") + PRIOR * F.abs("lean"))


def noise_of(pages: DataFrame, min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """(host, hash) of the paths and of the blocks of low importance."""
    n = stored(counted(pages), "styles")
    nodes = stored(style_tree(n).where(F.col("pages") >= min_pages), "nodes")
    paths = nodes.where(F.col("importance") < low).select("host", F.col("path").alias("hash"))
    known = nodes.select("host", "path", "pages", "lean")
    if nodes.count() <= MAX_NOISE:
        known = F.broadcast(known)
    repeated = n.where((F.col("kind") == 1) & (2 * F.col("n") >= min_pages)).drop("lean").join(known, ["host", "path"])
    blocks = repeated.where((2 * F.col("n") >= F.col("pages")) & (_with_prior(1 - F.log("n") / F.log("pages")) < low))
    return stored(paths.union(blocks.select("host", F.col("value").alias("hash"))), "noise")


def main_text(html: str | None, noise: set[int] | frozenset[int] = frozenset()) -> str:
    """The page's blocks that are neither noise by themselves nor among the host's ``noise`` paths and blocks."""
    blocks, _ = parse(html)
    left = open_ = [x for x in blocks if not x.noise]
    if noise and open_:
        kept = [x.path not in noise and _hash(x.text, x.path) not in noise for x in open_]
        article = any(x.main for x, keep in zip(open_, kept) if keep)
        left = [x for x, keep in zip(open_, kept) if keep or x.main and not article]
    return "\n".join(x.text for x in left)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    src = small_batches(pages).select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
                       F.xxhash64(host).alias("host"))
    noise = noise_of(src.select("host", "html"), min_pages, low)
    per_host = noise.groupBy("host").agg(F.collect_set("hash").alias("noise"))
    id_type = src.schema["page_id"].dataType.simpleString()
    if noise.count() <= MAX_NOISE:
        joined = src.join(F.broadcast(per_host), "host", "left")
    else:
        salted = per_host.withColumn("salt", F.explode(F.expr(f"sequence(0, {SALTS - 1})")))
        joined = src.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            text = [main_text(h, frozenset(n or ())) for h, n in zip(b.column("html").to_pylist(), b.column("noise").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])

    out = joined.select("page_id", "url", "html", "noise").mapInArrow(run, f"page_id {id_type}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op10_site_style_tree(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


ship_by_value(__name__)
