"""Benchmark decontamination: BM25 over test items, block-max WAND, overlap check.

The small side is indexed: test items, cut into units, by BM25 impacts that are
divided by the unit's own full score, so that one threshold suits all. Every
passage of the corpus is a query. Term numbers rise with a term's largest
impact. Where WAND moves sorted cursors to a pivot, many passages are looked at
together here, on arrays: a passage's terms are added up from the lowest, and
those below the pivot, whose largest impacts together stay under a share of the
threshold, can't lift any unit over it alone. Only the postings of the terms
from the pivot on are opened, with maxima by block of units (block-max), and the
terms below it count with their largest impacts.
The units of blocks that stay over the bound are scored exactly, and those over
the threshold are compared with the passage by word shingles. All of it runs on
arrays over many passages at once.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.llm.words import words_of
from heddle.sources import read_table

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # of a unit's own full score
SHINGLE, OVERLAP = 5, 0.8
ANSWER = 0.5
UNIT = 128  # words of a unit at most
BLOCK = 2  # units of a block
SHUT = 0.1  # of the threshold: what a passage's low terms may add up to, their postings being left shut
ITEMS_AT_ONCE, BYTES_AT_ONCE = 20_000, 1 << 25  # in one broadcast index: items, and bytes of their texts unless one has more
WORDS_AT_ONCE = 400_000
DENSE = 1 << 22  # (passage, unit) cells that are summed in an array of their own


def shingles_of(words: Sequence[bytes], width: int = SHINGLE) -> list[bytes]:
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return [b" ".join(x) for x in zip(*(words[i:] for i in range(width)))]


def question_and_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer: the last line is the answer if there are several lines."""
    head, _, tail = (text or "").strip().rpartition("\n")
    return (words_of(head), words_of(tail)) if head.strip() else (words_of(tail), [])


class Index:
    """BM25 index of items ``(id, text)``; items and answers of fewer than SHINGLE words have one shingle, all their words in a row."""

    def __init__(self, items: Sequence[tuple[int, str | None]], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.items: list[tuple[int, int, int, bool]] = []  # id, shingles of the question, of the answer, whether it is short
        self.shingles: dict[bytes, list[tuple[int, int]]] = defaultdict(list)  # -> (item, place of the shingle in it)
        self.widths = {SHINGLE}  # words of the shingles
        units: list[tuple[int, Counter]] = []
        for item_id, text in items:
            question, answer = question_and_answer(text)
            words = question + answer
            if not words:
                continue
            number = len(self.items)
            # shingles across the border belong to the question
            a = shingles_of(answer)
            q = shingles_of(words)[: max(1, len(words) - SHINGLE + 1) - max(0, len(answer) - SHINGLE + 1)]
            self.items.append((item_id, len(q), len(a), len(words) < SHINGLE))
            self.widths |= {len(x) for x in (words, answer) if 0 < len(x) < SHINGLE}
            for place, s in enumerate(q + a):
                self.shingles[s].append((number, place))
            parts = -(-len(words) // UNIT)
            size = -(-len(words) // parts)
            units += [(number, Counter(words[i : i + size])) for i in range(0, len(words), size)]
        units.sort(key=lambda u: (len(u[1]), u[0]))  # alike in length within a block
        self.tile = max([16, *(sum(c.values()) for _, c in units)])
        self.unit_item = [i for i, _ in units]
        df = Counter(t for _, c in units for t in c)
        average = sum(sum(c.values()) for _, c in units) / max(1, len(units))
        impacts: list[tuple[bytes, int, float]] = []
        best: dict[bytes, float] = {}
        for u, (_, c) in enumerate(units):
            norm = K1 * (1 - B + B * sum(c.values()) / average)
            raw = {t: math.log(1 + (len(units) - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm) for t, n in c.items()}
            full = sum(raw.values())
            for t, x in raw.items():
                impacts.append((t, u, x / full))
                best[t] = max(best.get(t, 0.0), x / full)
        terms = sorted(best, key=lambda t: (best[t], t))
        self.term = {t: i for i, t in enumerate(terms)}
        self.best = np.array([best[t] for t in terms])
        postings = sorted((self.term[t], u, x) for t, u, x in impacts)
        number = np.array([x[0] for x in postings], dtype=np.int64)
        self.unit = np.array([x[1] for x in postings], dtype=np.int64)
        self.impact = np.array([x[2] for x in postings])
        self.units, self.blocks = len(units), -(-len(units) // BLOCK)
        # runs of postings of one term and block: first[t] is a term's first run, begin[r] a run's first posting
        run, self.begin = np.unique(number * self.blocks + self.unit // BLOCK, return_index=True)
        self.block_best = np.maximum.reduceat(self.impact, self.begin) if len(run) else np.empty(0)
        self.block = run % max(1, self.blocks)
        self.first = np.searchsorted(run, np.arange(len(terms) + 1) * self.blocks)
        self.begin = np.append(self.begin, len(postings))

    def matches(self, tile: np.ndarray, term: np.ndarray, goes_on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, unit, score) of the scores that reach the threshold.

        ``tile``, ``term``: a pair for each word, the term -1 if it isn't in the
        index. Passage i is tile i, with tile i + 1 where ``goes_on[i]``.
        """
        none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        known = term >= 0
        width = max(1, len(self.best))
        pairs = np.unique(tile[known] * width + term[known])
        if not len(pairs):
            return none
        tiles, t = np.divmod(pairs, width)
        best = self.best[t]
        fresh = np.ones(len(t), bool)
        fresh[1:] = tiles[1:] != tiles[:-1]
        start = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        total = np.cumsum(best)
        low = total - (total[start] - best[start])  # impacts so far of the tile, this term's included
        slack = 1e-9 * (1 + total[-1])
        opened = low >= SHUT * self.threshold / 2 - slack
        shut = np.bincount(tiles[~opened], weights=best[~opened], minlength=len(goes_on))
        shut[:-1] += shut[1:] * goes_on[:-1]

        def spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Which range, and place, of every place in the ranges."""
            n = end - begin
            which = np.repeat(np.arange(len(n)), n)
            return which, np.arange(len(which)) + (begin - (np.cumsum(n) - n))[which]

        def summed(key: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
            if size <= DENSE:
                sums = np.bincount(key, weights=weights, minlength=size)
                at = np.flatnonzero(sums)
                return at, sums[at]
            at, back = np.unique(key, return_inverse=True)
            return at, np.bincount(back, weights=weights, minlength=len(at))

        def with_next(owner: np.ndarray) -> np.ndarray:
            """Places of what also belongs to the passage before its own."""
            return np.flatnonzero((owner > 0) & goes_on[owner - 1])

        which, at = spread(self.first[t[opened]], self.first[t[opened] + 1])
        key, bound = summed(tiles[opened][which] * self.blocks + self.block[at], self.block_best[at], len(goes_on) * self.blocks)
        more = with_next(key // self.blocks)
        key, bound = summed(np.concatenate([key, key[more] - self.blocks]), np.concatenate([bound, bound[more]]), len(goes_on) * self.blocks)
        key = key[bound + shut[key // self.blocks] >= self.threshold - slack]
        if not len(key):
            return none
        # the exact scores: all terms of the passages that are left, in the blocks that are left
        more = with_next(tiles)
        p, t = np.concatenate([tiles, tiles[more] - 1]), np.concatenate([t, t[more]])
        left = np.zeros(len(goes_on), bool)
        left[key // self.blocks] = True
        left = left[p]
        p, t = np.divmod(np.unique(p[left] * width + t[left]), width)
        which, at = spread(self.first[t], self.first[t + 1])
        cell = p[which] * self.blocks + self.block[at]
        found = np.minimum(np.searchsorted(key, cell), len(key) - 1)
        ok = key[found] == cell
        owner, at = p[which[ok]], at[ok]
        which, at = spread(self.begin[at], self.begin[at + 1])
        key, score = summed(owner[which] * self.units + self.unit[at], self.impact[at], len(goes_on) * self.units)
        good = score >= self.threshold - 1e-9
        return key[good] // self.units, key[good] % self.units, score[good]

    def leaks(self, docs: list[list[bytes]]) -> list[tuple[int, int, float, float, float, bool]]:
        """(document, item id, score, share of the question's shingles, of the answer's, whether the item is short) of the leaks in ``docs``."""
        size, look = self.tile, self.term.get
        lengths = np.array([len(words) for words in docs])
        tiles = -(-lengths // size)  # two tiles in a row hold any unit whole
        before = np.cumsum(tiles) - tiles
        total = int(lengths.sum())
        if not total:
            return []
        term = np.fromiter(map(look, chain.from_iterable(docs), repeat(-1)), np.int64, total)
        place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        tile = np.repeat(before, lengths) + place // size
        owner = np.repeat(np.arange(len(docs)), tiles)
        goes_on = np.append(owner[1:] == owner[:-1], False)
        got: dict[tuple[int, int], tuple[float, set]] = {}
        by_passage: dict[int, dict[int, float]] = defaultdict(dict)
        for p, u, x in zip(*(v.tolist() for v in self.matches(tile, term, goes_on))):
            item = self.unit_item[u]
            by_passage[p][item] = max(x, by_passage[p].get(item, 0.0))
        for p, over in by_passage.items():
            d = int(owner[p])
            at = (p - int(before[d])) * size
            words = docs[d][at : at + 2 * size]
            for s in {b" ".join(x) for n in self.widths for x in zip(*(words[i:] for i in range(n)))}:
                for item, place in self.shingles.get(s, ()):
                    if item in over:
                        score, places = got.get((d, item), (0.0, set()))
                        got[d, item] = (max(score, over[item]), places | {place})
        out = []
        for (d, item), (score, places) in sorted(got.items()):
            item_id, nq, na, short = self.items[item]
            q = sum(x < nq for x in places)
            a = len(places) - q
            if len(places) >= OVERLAP * (nq + na) and a >= ANSWER * na:
                out.append((d, item_id, score, q / nq if nq else 1.0, a / na if na else 1.0, short))
        return out


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Index = index.value
        for batch in batches:
            ids, texts, start = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
            rows: list[tuple] = []
            docs: list[list[bytes]] = []
            begin = held = 0
            for i in range(len(ids)):
                docs.append(words_of(texts[i].as_py()))
                held += len(docs[-1])
                if held >= WORDS_AT_ONCE or i == len(ids) - 1:
                    rows += [(ids[begin + d], start[begin + d], *rest) for d, *rest in found.leaks(docs)]
                    docs, begin, held = [], i + 1, 0
            columns = zip(*rows) if rows else [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
            names = ["id", "text_hash", "item_id", "score", "question_overlap", "answer_overlap", "short"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """(id, text_hash, item_id, score, question_overlap, answer_overlap, short): a row for each item that a row of ``docs`` holds.

    An item is held if a unit of it scores THRESHOLD of its full BM25 score or
    more in some passage, OVERLAP of its word shingles stand in such passages,
    and ANSWER of its answer's. The last of several lines is the answer. Items
    and answers of fewer than SHINGLE words are held if all their words stand in
    a row; ``short`` marks such items, which a document may hold by chance.
    Null and empty items match nothing; null and empty texts hold nothing. Equal
    items each give their row, as do repeated rows. Very long texts and items
    are searched whole. Other columns aren't read. No text is shuffled. The
    benchmark is the small side: it is read to the driver and broadcast,
    ``items_at_once`` items an index (fewer if they are long), in as many passes
    over the corpus as that takes.
    """
    items = benchmark.select(F.col(item_col).cast("long"), item_text).where(F.col(item_text).isNotNull()).orderBy(item_col, item_text)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("text_hash"))
    out, held = None, []

    def search(part: list) -> DataFrame:
        index = docs.sparkSession.sparkContext.broadcast(Index(part))
        return rows.mapInArrow(_search(index), "id long, text_hash long, item_id long, score double, question_overlap double, answer_overlap double, short boolean")

    size = 0
    for item in items.toLocalIterator():
        held.append(tuple(item))
        size += len(item[1])
        if len(held) == items_at_once or size >= BYTES_AT_ONCE:
            out, held, size = search(held) if out is None else out.union(search(held)), [], 0
    return search(held) if out is None else out.union(search(held)) if held else out


def op7_decontaminate_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, short of the benchmark items in all documents."""
    found = leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash").withColumnRenamed("id", "doc_id").withColumn("score", F.round("score", 6))


QUERIES = {"op7_decontaminate_wand": op7_decontaminate_wand}
_WORDS = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"
ORACLE_SQL = {
    "op7_decontaminate_wand": rf"""
WITH items AS (SELECT row_number() OVER () AS item, item_id, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM benchmark WHERE text IS NOT NULL),
halves AS (
  SELECT item, item_id, regexp_extract_all(lower(CASE WHEN contains(t, chr(10)) THEN regexp_extract(t, '(?s)^(.*)\n[^\n]*$', 1) ELSE t END), {_WORDS}) AS q,
         CASE WHEN contains(t, chr(10)) THEN regexp_extract_all(lower(regexp_extract(t, '[^\n]*$')), {_WORDS}) ELSE [] END AS a FROM items),
worded AS (SELECT *, list_concat(q, a) AS w, len(q) + len(a) AS n, len(a) AS na FROM halves WHERE len(q) + len(a) > 0),
sized AS (SELECT *, CAST(ceil(n / ceil(n / {UNIT})) AS BIGINT) AS size FROM worded),
units AS (SELECT item, k, unnest(w[k * size + 1 : (k + 1) * size]) AS term FROM (SELECT *, unnest(range(CAST(ceil(n / size) AS BIGINT))) AS k FROM sized)),
counted AS (SELECT *, sum(f) OVER (PARTITION BY item, k) AS length FROM (SELECT item, k, term, count(*) AS f FROM units GROUP BY item, k, term)),
corpus AS (SELECT count(*) AS units, avg(length) AS average, greatest(16, max(length)) AS tile FROM (SELECT DISTINCT item, k, length FROM counted)),
raws AS (
  SELECT item, k, term, ln(1 + (units - count(*) OVER t + 0.5) / (count(*) OVER t + 0.5)) * f * ({K1} + 1) / (f + {K1} * (1 - {B} + {B} * length / average)) AS raw
  FROM counted, corpus WINDOW t AS (PARTITION BY term)),
impacts AS (SELECT item, k, term, raw / sum(raw) OVER (PARTITION BY item, k) AS impact FROM raws),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), {_WORDS}) AS w FROM documents),
words AS (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS i FROM docs),
tiled AS (SELECT DISTINCT r, i // tile AS p, term FROM words, corpus),
passages AS (SELECT r, p, term FROM tiled UNION SELECT r, p - 1, term FROM tiled WHERE p > 0),
over AS (
  SELECT r, p, item, max(score) AS best FROM (SELECT r, p, item, k, sum(impact) AS score FROM passages JOIN impacts USING (term) GROUP BY r, p, item, k)
  WHERE score >= {THRESHOLD} - 1e-9 GROUP BY r, p, item),
widths AS (SELECT {SHINGLE} AS n UNION SELECT n FROM worded WHERE n < {SHINGLE} UNION SELECT na FROM worded WHERE na BETWEEN 1 AND {SHINGLE} - 1),
parts AS (
  SELECT item, false AS answer, greatest(1, n - {SHINGLE} + 1) - greatest(0, na - {SHINGLE} + 1) AS many, w FROM worded
  UNION ALL SELECT item, true, CASE WHEN na = 0 THEN 0 ELSE greatest(1, na - {SHINGLE} + 1) END, a FROM worded),
shingles AS (SELECT item, answer, place, array_to_string(w[place : place + {SHINGLE} - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, many + 1)) AS place FROM parts)),
wide AS (SELECT DISTINCT string_split(gram, ' ')[1] AS term FROM shingles),
starts AS (SELECT r, i, w[i + 1 : i + {SHINGLE}] AS ahead FROM words SEMI JOIN wide USING (term) JOIN docs USING (r)),
grams AS (SELECT r, i, n, array_to_string(ahead[1:n], ' ') AS gram FROM starts, widths WHERE len(ahead) >= n),
hits AS (SELECT r, i // tile AS p, i, n, tile, item, answer, place FROM grams JOIN shingles USING (gram), corpus),
near AS (SELECT r, p, item, answer, place FROM hits UNION ALL SELECT r, p - 1, item, answer, place FROM hits WHERE p > 0 AND i + n <= (p + 1) * tile),
summed AS (
  SELECT r, item, max(best) AS score, count(DISTINCT place) FILTER (NOT answer) AS q, count(DISTINCT place) FILTER (answer) AS a
  FROM near JOIN over USING (r, p, item) GROUP BY r, item),
wanted AS (SELECT item, sum(many) FILTER (NOT answer) AS nq, sum(many) FILTER (answer) AS na FROM parts GROUP BY item)
SELECT doc_id, item_id, round(score, 6) AS score, CASE WHEN nq > 0 THEN CAST(q / nq AS DOUBLE) ELSE 1.0 END AS question_overlap,
       CASE WHEN wanted.na > 0 THEN CAST(a / wanted.na AS DOUBLE) ELSE 1.0 END AS answer_overlap, n < {SHINGLE} AS short
FROM summed JOIN wanted USING (item) JOIN (SELECT item, item_id, n FROM worded) USING (item) JOIN docs USING (r)
WHERE q + a >= {OVERLAP} * (nq + wanted.na) AND a >= {ANSWER} * wanted.na
"""
}
