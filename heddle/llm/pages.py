"""Main text of web pages: markup rules, and a suffix array over the pages of a host.

A page is read into blocks, each a run of text in one block element. Markup
takes out furniture and is a witness for the rest: it vouches for text that
stands in an <article> or <main>, and leaves open the text of pages without one
and of parts of an article with a class or id of their own that names no
furniture. The token streams of all pages are joined into one array whose
suffixes are sorted by prefix doubling; neighbours that share RUN tokens are one
run, counted for a host by the pages that leave it open and those that vouch for
it. Runs left open by LEAST pages or more, and by more than vouch for them, are
boilerplate. A longer repeated string is a row of such runs, so the suffixes need
no further sorting. Open parts that boilerplate covers go. A check follows: text
of an article stays, as an article may repeat a passage that stands elsewhere.

Pages are read in shards of bounded size, of any hosts. A shard's array sums up
its runs, which are added up over all shards by hash; each shard gets back the
boilerplate that it holds.
"""

from __future__ import annotations

import re
import secrets
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from html import unescape
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.llm.shared import stored
from heddle.sources import read_table

SHARD = 1 << 18  # tokens
BROADCAST = 500_000  # runs or shards, of some 20 bytes each; more of them are joined
RUN = 8  # tokens of a repeated run: what the suffixes are sorted by
LEAST = 3  # pages of a host that leave a boilerplate run open
COVERED = 0.8
AT_ONCE = 1 << 22  # characters of pages in one batch

# HTML element names.
RAW = frozenset("script style noscript template textarea title iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img label center".split())
SKIPPED = frozenset("nav footer aside form svg button select dialog menu object audio video canvas".split())
IN_HEAD = RAW | frozenset("base link meta basefont bgsound noframes".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th tr blockquote pre figure figcaption table tbody thead tfoot ul ol dl hr".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt".split())
# Elements whose end tag may be left out: what starts in their place, and what bounds the search for them.
OPTIONAL = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tr": (("tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)),
}
# Words of class, id and role attributes that name page furniture: anywhere, and on containers only.
NAMES = re.compile(r"ads?|advert\w*|banners?|sponsor\w*|promo\w*|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|footers?|cookies?|gdpr|comments?|commentlist|disqus|sharing|social|newsletter|subscribe|subscription|widgets?|masthead|pagination|pager|contentinfo", re.I)
LOOSE = re.compile(r"consent|notices?|popup|modal|respond|responses?|share|related|recommended|toolbar|complementary|alert|search|login|signup", re.I)
# A class such as no-sidebar or has-menu speaks of the page, not of the element.
ABOUT = frozenset("no has have with without not non hide show is".split())
HEADERS = frozenset("header site-header page-header".split())
MARK = re.compile(
    r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|$)|'[^']*+(?:'|$)|[^\s>"'][^\s>]*+)?+)?+)*+)(?:>|$)""",
    re.S,
)
NAMED = re.compile(r"(?:^|[\s/])(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

Block = tuple[str, int]  # text; 0 if it stays, else the number of the unsettled part of the page that it is in


def _named(attributes: str) -> list[tuple[str, str]]:
    """(attribute, one name in it) of the class, id and role attributes."""
    return [(m[1].lower(), name.lower()) for m in NAMED.finditer(attributes) for name in (m[2] or m[3] or m[4] or "").split()]


def _furniture(element: str, names: list[tuple[str, str]], article: bool) -> bool:
    for attribute, name in names:
        parts = re.split(r"[-_]+", name)
        if ABOUT & set(parts):
            continue
        if article and (attribute == "id" or element in TEXT or len(parts) > 2):
            parts = [name]  # an anchor, or a class of the text itself: only if it says nothing else
        ends = {parts[0], parts[-1]}
        if any(map(NAMES.fullmatch, ends)):
            return True
        if not (article and (attribute == "id" or element in TEXT)) and any(map(LOOSE.fullmatch, ends)):
            return True
        if not article and name in HEADERS:
            return True
    return False


def blocks_of(html: str | None) -> tuple[list[Block], bool]:
    """The page's blocks but those of furniture, in order, references decoded, white space single; whether the page has an article.

    Where it has one, blocks outside of it are left out.
    """
    html = html or ""
    out: list[tuple[str, bool, int]] = []  # text, in an article, part
    held: list[str] = []
    stack: list[tuple[str, bool, bool, int]] = []  # element, whether it is furniture, whether in an article, unsettled part of it
    opened: Counter[str] = Counter()
    parts = 0

    def state() -> tuple[bool, bool, int]:
        return stack[-1][1:] if stack else (False, False, 0)

    def close() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        furniture, article, part = state()
        if text and not furniture:
            out.append((text, article, part))

    def cut(depth: int) -> None:
        for entry in stack[depth:]:
            opened[entry[0]] -= 1
        del stack[depth:]

    def end(names: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        if not any(opened[x] for x in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return cut(i)
            if stack[i][0] in bounds:
                return None

    at = 0
    while at < len(html):
        m = MARK.search(html, at)
        if not m:
            held.append(html[at:])
            break
        held.append(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if name in INLINE:
                if name not in VOID and any(s[0] == name for s in stack[-8:]):
                    while stack and stack[-1][0] in INLINE:
                        close()
                        gone = stack[-1][0]
                        cut(len(stack) - 1)
                        if gone == name:
                            break
                continue
            close()
            if opened[name]:  # else there is nothing to search the stack for
                cut(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if opened["head"] and name not in IN_HEAD:
            close()
            cut(next(i for i in range(len(stack)) if stack[i][0] == "head"))
        if name in RAW:
            ended = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = ended.end() if ended else len(html)
            continue
        names = _named(m[3])
        furniture, article, part = state()
        if name in INLINE:
            if name == "br":
                held.append(" ")
            elif name not in VOID and not furniture and _furniture(name, names, article):
                close()
                stack.append((name, True, article, part))
                opened[name] += 1
            continue
        close()
        if name in ENDS_P:
            end(("p",), ("article", "aside", "blockquote", "div", "section", "table", "td", "th", "li", "form", "main", "nav", "header", "footer"))
        if name in OPTIONAL:
            end(*OPTIONAL[name])
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        furniture, article, part = state()
        if name in ("html", "body"):
            own = False
        else:
            own = name in SKIPPED or name == "head" or name == "header" and not article or _furniture(name, [] if name in ("article", "main") else names, article)
        if article and not own and names and name not in TEXT:
            parts += 1
            part = parts
        if name in ("article", "main") and not furniture:
            article = True
        stack.append((name, furniture or own, article, part))
        opened[name] += 1
    close()
    if any(article for _, article, _ in out):
        return [(text, part) for text, article, part in out if article], True
    return [(text, n) for n, (text, _, _) in enumerate(out, 1)], False


def suffix_array(tokens: np.ndarray, page: np.ndarray, depth: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the runs of ``depth`` tokens within a page, in order of the suffixes that start there; number of each run; whether it is the first of its number on its page.

    The suffix array is sorted by prefix doubling up to ``depth`` tokens (a power of two); neighbours that share as many have one number.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < depth:
        after = np.full(n, -1, np.int64)
        after[:-length] = rank[length:]
        rank = np.unique((rank << 32) | (after + 1), return_inverse=True)[1].astype(np.int64)
        length *= 2
    whole = np.zeros(n, bool)
    if n >= depth:
        whole[: n - depth + 1] = page[: n - depth + 1] == page[depth - 1 :]
    order = np.argsort(rank, kind="stable")  # pages in order within a run
    order = order[whole[order]]
    fresh = np.ones(len(order), bool)
    fresh[1:] = rank[order[1:]] != rank[order[:-1]]
    new_page = fresh.copy()
    new_page[1:] |= page[order[1:]] != page[order[:-1]]
    group = np.cumsum(fresh) - 1
    return order, group, new_page


def covered(starts: np.ndarray, n: int, depth: int = RUN) -> np.ndarray:
    """Which of ``n`` tokens lie in a run that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + depth, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated(tokens: np.ndarray, page: np.ndarray, least: int, depth: int = RUN) -> np.ndarray:
    """Which tokens lie in a run of ``depth`` tokens, within a page, that stands on ``least`` distinct pages or more."""
    order, group, first = suffix_array(tokens, page, depth)
    pages = np.bincount(group, weights=first)
    return covered(order[pages[group] >= least], len(tokens), depth)


def boilerplate(opened: np.ndarray, vouched: np.ndarray) -> np.ndarray:
    """Which runs are boilerplate, by the pages of the host that leave them open and those that vouch for them."""
    return (opened >= LEAST) & (opened > vouched)


class Streams:
    """Token streams of pages, joined: of each page first the blocks left open, then those vouched for; a block's end is a token.

    Words of different hosts are different tokens. ``opened`` and ``vouched``: pages of each numbered run.
    """

    def __init__(self, pages: list[list[Block]], hosts: list[str]):
        fresh = count(1)
        self.known: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(fresh.__next__))
        self.number: dict[tuple[int, int], int] = {}  # of the open (page, part)
        tokens: list[int] = []
        stream, unit, sizes = [], [], []
        for p, blocks in enumerate(pages):
            words = self.known[hosts[p]]
            for text, part in sorted(blocks, key=lambda b: not b[1]):
                before = len(tokens)
                tokens += [words[w] for w in text.split()]
                tokens.append(0)
                sizes.append(len(tokens) - before)
                stream.append(2 * p + (not part))
                unit.append(self.number.setdefault((p, part), len(self.number)) if part else -1)
        self.tokens = np.array(tokens, np.int64)
        page, self.unit = (np.repeat(np.array(x, np.int64), np.array(sizes, np.int64)) for x in (stream, unit))
        self.order, self.group, first = suffix_array(self.tokens, page)
        inside = page[self.order] & 1
        self.opened, self.vouched = (np.bincount(self.group, weights=first & (inside == x)).astype(np.int64) for x in (0, 1))

    def run_hashes(self, runs: np.ndarray) -> np.ndarray:
        """64-bit hashes of the runs of these numbers and their hosts."""
        h = np.zeros(len(runs), np.uint64)
        if not len(runs):
            return h
        hashes = np.zeros(1 + sum(map(len, self.known.values())), np.uint64)
        for host, words in self.known.items():
            seed = xxhash.xxh64_intdigest(host.encode("utf-8", "replace"))
            for w, i in words.items():
                hashes[i] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), seed)
        first = self.order[np.unique(self.group, return_index=True)[1]][runs]
        for i in range(RUN):
            h = (h ^ hashes[self.tokens[first + i]]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def gone(self, runs: np.ndarray) -> dict[int, set[int]]:
        """By page, the open parts that the runs of which this is true cover."""
        out: dict[int, set[int]] = {}
        if self.number:
            hit, is_open = covered(self.order[runs[self.group]], len(self.tokens)), self.unit >= 0
            share = np.bincount(self.unit[is_open], weights=hit[is_open]) / np.bincount(self.unit[is_open])
            for (p, part), u in self.number.items():
                if share[u] >= COVERED:
                    out.setdefault(p, set()).add(part)
        return out


def _joined(blocks: list[Block], gone: set[int]) -> str:
    return "\n\n".join(text for text, part in blocks if part not in gone)


def main_texts(htmls: list[str | None]) -> list[str]:
    """Main texts of all pages of one host."""
    pages = [blocks_of(h)[0] for h in htmls]
    streams = Streams(pages, [""] * len(pages))
    gone = streams.gone(boilerplate(streams.opened, streams.vouched))
    return [_joined(blocks, gone.get(p, set())) for p, blocks in enumerate(pages)]


READ = "page_id long, url string, host string, shard long, blocks array<string>, parts array<int>, runs array<long>, n array<long>"


def _read(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Pages as blocks, in shards of about ``size`` tokens; a shard's first page has its array's open runs and the pages that leave each open."""
    kinds = {"shard": pa.int64(), "blocks": pa.list_(pa.string()), "parts": pa.list_(pa.int32()), "runs": pa.list_(pa.int64()), "n": pa.list_(pa.int64())}
    for batch in batches:
        start, held, tokens, pages = 0, 0, 0, []
        for n, html in enumerate(batch.column("html")):
            blocks, _ = blocks_of(html.as_py())
            pages.append(blocks)
            held += len(html.as_py() or "")
            tokens += sum(text.count(" ") + 2 for text, _ in blocks)
            if tokens >= size or held >= AT_ONCE or n == len(batch) - 1:
                of = batch.slice(start, len(pages))
                streams = Streams(pages, of.column("host").to_pylist())
                runs = np.flatnonzero(streams.opened)
                rest = [None] * (len(pages) - 1)
                columns = {
                    "shard": [secrets.randbits(63)] * len(pages),
                    "blocks": [[text for text, _ in blocks] for blocks in pages],
                    "parts": [[part for _, part in blocks] for blocks in pages],
                    "runs": [streams.run_hashes(runs).view(np.int64) if len(runs) else None, *rest],
                    "n": [streams.opened[runs] if len(runs) else None, *rest],
                }
                arrays = [pa.array(columns[c], kind) for c, kind in kinds.items()]
                yield pa.RecordBatch.from_arrays([*(of.column(c) for c in ("page_id", "url", "host")), *arrays], ["page_id", "url", "host", *kinds])
                start, held, tokens, pages = n + 1, 0, 0, []


def _blocks(table: pa.Table | pa.RecordBatch) -> list[list[Block]]:
    return [list(zip(b, p)) for b, p in zip(table.column("blocks").to_pylist(), table.column("parts").to_pylist())]


def _vouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, n): runs that pages of a batch vouch for, and the number of these pages."""
    for batch in batches:
        streams = Streams([[b for b in blocks if not b[1]] for blocks in _blocks(batch)], batch.column("host").to_pylist())
        runs = streams.run_hashes(np.arange(len(streams.vouched))).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(streams.vouched)], ["run", "n"])


def _decide(table: pa.Table, runs: pa.Table) -> pa.Table:
    pages = _blocks(table)
    streams = Streams(pages, table.column("host").to_pylist())
    gone = streams.gone(np.isin(streams.run_hashes(np.arange(len(streams.opened))).view(np.int64), runs.column("run").to_numpy()))
    texts = [_joined(blocks, gone.get(p, set())) for p, blocks in enumerate(pages)]
    return pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(texts, pa.string())})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shard: int = SHARD) -> DataFrame:
    """(page_id, url, text, n_chars): a row for each row of ``pages``.

    The host is the URL's, lower case; URLs without one, null ones too, form a
    host of their own. Null and empty pages have an empty text. Very long pages
    are read whole. Repeated rows repeat, and count as pages of their own.
    Other columns aren't read. An empty table gives no rows. ``shard``: tokens
    looked at together, about; the result doesn't depend on it.
    """
    host = F.coalesce(F.lower(F.regexp_extract(url_col, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    read = stored(rows.mapInArrow(partial(_read, size=shard), READ), "pages")
    held = read.where("runs is not null").select("shard", F.explode(F.arrays_zip("runs", "n")).alias("r")).select("shard", F.col("r.runs").alias("run"), "r.n")
    often = stored(held.groupBy("run").agg(F.sum("n").alias("opened")).where(F.col("opened") >= LEAST), "runs")
    found = often.count()
    if found:
        few = F.broadcast(often) if found <= BROADCAST else often
        vouched = read.select("host", "blocks", "parts").mapInArrow(_vouched, "run long, n long").join(few.select("run"), "run").groupBy("run").agg(F.sum("n").alias("vouched"))
        often = stored(often.join(vouched, "run", "left").where("opened > coalesce(vouched, 0)"), "boilerplate")
    back = stored(held.join(often, "run").select("shard", "run"), "back")
    shards = stored(back.select("shard").distinct(), "shards")
    # a join by shard would shuffle the texts of all pages
    few = F.broadcast(shards) if shards.count() <= BROADCAST else shards
    whole = read.join(few, "shard", "left_anti").select("page_id", "url", F.array_join("blocks", "\n\n").alias("text"))
    dealt = read.join(few, "shard", "left_semi").select("page_id", "url", "host", "blocks", "parts", "shard")
    decided = dealt.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(_decide, "page_id long, url string, text string")
    return whole.union(decided).withColumn("n_chars", F.length("text").cast("long"))


def op8_html_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of all pages."""
    return extract(read_table(spark, sf_dir, "pages"))


QUERIES = {"op8_html_suffix_array": op8_html_suffix_array}
ORACLE_SQL: dict[str, str] = {}
