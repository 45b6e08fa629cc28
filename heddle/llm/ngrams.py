"""Stupid-backoff scores of documents, their own n-grams left out of the counts.

Three tables, joined by partition of the n-grams' hash space:

  exploded  (block, part, numbers, counts): the distinct n-grams of a block of
            documents, added up before they are shuffled, so that a frequent
            one comes once a block and no partition is hot
  counted   the count table: each partition adds up its n-grams over all blocks
            and is joined to what the blocks hold of it
  scored    the totals by block, joined to the documents' n-grams and summed
            by document

A row of these tables holds the n-grams of one block and partition, sorted and
packed as differences: at a row each, 2.5 n-grams a word would be shuffled by
hash and back by document. A block has at most a row for each of its n-grams,
so rows never outgrow the exploded n-grams, whatever the number of partitions.
The texts are dealt to their blocks once: both uses read the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.llm.mixing import word_count
from heddle.sources import read_table

BACKOFF = 0.4
BLOCK_BYTES = 12_000_000  # of text in a block, about
ORDER = 3
BITS = 56  # of an n-gram's number
EXPLODED = "block int, part int, n int, numbers binary, counts binary"
COUNTED = "block int, part int, n int, others binary"
SCORED = "id long, n_words long, log_prob double, n_trigram long, n_bigram long, n_unigram long"


def _pack(values: np.ndarray) -> bytes:
    """Bytes of unsigned numbers, place by place, so that the high ones vanish."""
    v = np.ascontiguousarray(values, dtype="<u8")
    return zstandard.ZstdCompressor(level=1).compress(v.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(blob: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=8 * n + 8), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view("<u8").ravel().astype(np.uint64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def grams(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(document of each word, [hashes of the n-grams that end at each word] for n = 1..ORDER; 0: none ends there)."""
    known: dict[bytes, int] = {}
    words, lengths = [], []
    for t in texts:
        own = t.lower().split()
        lengths.append(len(own))
        for w in own:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w) | 1
            words.append(h)
    one = np.array(words, dtype=np.uint64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    out = [one]
    for n in range(2, ORDER + 1):
        at = np.zeros(len(one), np.uint64)
        same = doc[n - 1 :] == doc[: len(doc) - n + 1]
        at[n - 1 :] = np.where(same, _mix(out[-1][n - 2 : -1], one[n - 1 :]) | np.uint64(1), np.uint64(0)) if len(one) >= n else 0
        out.append(at)
    return doc, out


def _distinct(by_n: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order the distinct numbers, each word's place among them (their number: none ends there), and their counts."""
    out = []
    for number in by_n:
        number = np.where(number == 0, number, np.maximum(number >> np.uint64(64 - BITS), np.uint64(1)))
        distinct, place, count = np.unique(number, return_inverse=True, return_counts=True)
        if len(distinct) and distinct[0] == 0:  # stands for no n-gram: put it last
            distinct, count = distinct[1:], count[1:]
            place = np.where(place == 0, len(distinct), place - 1)
        out.append((distinct, place, count))
    return out


def _edges(numbers: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` even ranges of the hash space begins in sorted numbers, and their end."""
    return np.searchsorted((numbers >> np.uint64(BITS - 32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))


def _explode(parts: int):
    """``parts``: of each order; those of order n are numbered from (n - 1) * parts."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        rows = []
        for order, (numbers, _, counts) in enumerate(_distinct(grams(table.column("t").to_pylist())[1])):
            edges = _edges(numbers, parts)
            for p in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
                own = slice(edges[p], edges[p + 1])
                rows.append((block, order * parts + p, int(edges[p + 1] - edges[p]), _pack(np.diff(numbers[own], prepend=np.uint64(0))), _pack(counts[own])))
        names = (("block", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("numbers", pa.binary()), ("counts", pa.binary()))
        return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(names)})

    return run


def _count(table: pa.Table) -> pa.Table:
    """What the other blocks hold of each block's n-grams in a partition."""
    sizes = table.column("n").to_pylist()
    numbers = [np.cumsum(_unpack(b, n), dtype=np.uint64) for b, n in zip(table.column("numbers").to_pylist(), sizes)]
    own = np.concatenate([_unpack(b, n) for b, n in zip(table.column("counts").to_pylist(), sizes)])
    distinct, at = np.unique(np.concatenate(numbers), return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, at, own)
    blobs = [_pack(x) for x in np.split(total[at] - own, np.cumsum(sizes)[:-1])]
    return pa.table({"block": table.column("block"), "part": table.column("part"), "n": table.column("n"), "others": pa.array(blobs, pa.binary())})


def _score(parts: int, corpus_words: int):
    def run(docs: pa.Table, counted: pa.Table) -> pa.Table:
        texts = docs.column("t").to_pylist()
        doc, by_n = grams(texts)
        of_part = {p: (n, blob) for p, n, blob in zip(*(counted.column(c).to_pylist() for c in ("part", "n", "others")))}
        lengths = np.bincount(doc, minlength=len(texts)).astype(np.float64)
        left = []
        for order, (numbers, place, count) in enumerate(_distinct(by_n)):
            total = np.zeros(len(numbers) + 1)
            edges = _edges(numbers, parts)
            for p in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
                n, blob = of_part[order * parts + p]
                total[edges[p] : edges[p + 1]] = _unpack(blob, n)
            total[:-1] += count
            _, back, own = np.unique(doc * (len(numbers) + 1) + place, return_inverse=True, return_counts=True)
            left.append(np.where(place < len(numbers), total[place] - own[back], 0))
        c1, c2, c3 = left
        before1, before2 = np.append(0, c1[:-1]), np.append(0, c2[:-1])
        position = np.arange(len(doc)) - (np.cumsum(lengths) - lengths)[doc].astype(np.int64)
        rest = corpus_words - lengths[doc]
        tri, bi = c3 > 0, c2 > 0
        uni = c1 > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(tri, c3 / before2, np.where(bi, c2 / before1 * np.where(position >= 2, BACKOFF, 1), np.where(uni, c1 / rest, 1 / (rest + 1)) * BACKOFF ** np.minimum(position, 2)))
        sums = np.bincount(doc, weights=np.log(value), minlength=len(texts))
        hit = [np.bincount(doc, weights=x, minlength=len(texts)).astype(np.int64) for x in (tri, ~tri & bi, ~tri & ~bi & uni)]
        return pa.table({"id": docs.column("id"), "n_words": pa.array(lengths.astype(np.int64)), "log_prob": pa.array(sums.astype(np.float64)), "n_trigram": pa.array(hit[0]), "n_bigram": pa.array(hit[1]), "n_unigram": pa.array(hit[2])})

    return run


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, log_prob, n_trigram, n_bigram, n_unigram): a row for each row of ``docs``.

    Words stand between white space; A-Z count as a-z.

    A word's score is its trigram's count over the count of the bigram before,
    else BACKOFF times the same a word shorter, down to its share of all words;
    a word not seen elsewhere counts as one in all words. At a document's start
    the shorter n-gram isn't backed off to. Counts are over all rows, less the
    document's own; so copies of a document are seen elsewhere. log_prob is the
    sum of the words' log scores, the n_ columns count the words by the n-gram
    used. Null and empty texts have no words and log_prob 0. Very long texts are
    scored whole; a block holds one at least. Ids may be null or repeated.
    Other columns aren't read. An empty table gives no rows. N-grams are known
    by 56-bit hashes, orders apart: of n distinct ones of an order a share of
    some n / 2^56 is mistaken for another, 1 in 70,000 at 10^12.
    """
    text = F.col(text_col)
    size, words = docs.select(F.sum(F.octet_length(text)), F.sum(word_count(text))).first()
    blocks = max(1, -(-int(size or 0) // block_bytes))
    parts = -(-blocks // ORDER)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text, F.lit("")).cast("binary").alias("t"))
    # by place, not by content: copies spread over the blocks
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    exploded = rows.groupBy("block").applyInArrow(_explode(parts), EXPLODED)
    counted = exploded.groupBy("part").applyInArrow(_count, COUNTED)
    return rows.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_score(parts, int(words or 0)), SCORED)


def op6_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, mean_log_prob and the n-gram orders used of all documents."""
    found = scores(read_table(spark, sf_dir, "documents"))
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_prob") / F.col("n_words"), 6))
    return found.select(F.col("id").alias("doc_id"), "n_words", mean.alias("mean_log_prob"), "n_trigram", "n_bigram", "n_unigram")


QUERIES = {"op6_stupid_backoff": op6_stupid_backoff}
ORACLE_SQL = {
    "op6_stupid_backoff": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
exploded AS (
  SELECT r, i, w, lag(w) OVER doc AS w1, lag(w, 2) OVER doc AS w2
  FROM (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM docs)
  WINDOW doc AS (PARTITION BY r ORDER BY i)),
counted AS (
  SELECT r, i, count(*) OVER () - count(*) OVER (PARTITION BY r) AS rest,
         count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY r, w) AS c1,
         CASE WHEN i > 1 THEN count(*) OVER (PARTITION BY w1, w) - count(*) OVER (PARTITION BY r, w1, w) ELSE 0 END AS c2,
         CASE WHEN i > 2 THEN count(*) OVER (PARTITION BY w2, w1, w) - count(*) OVER (PARTITION BY r, w2, w1, w) ELSE 0 END AS c3
  FROM exploded),
scored AS (
  SELECT r, c1, c2, c3,
         CASE WHEN c3 > 0 THEN c3 / lag(c2) OVER doc
              WHEN c2 > 0 THEN c2 / lag(c1) OVER doc * CASE WHEN i > 2 THEN {BACKOFF} ELSE 1 END
              ELSE CASE WHEN c1 > 0 THEN c1 / rest ELSE 1 / (rest + 1) END * {BACKOFF} ** least(i - 1, 2) END AS score
  FROM counted WINDOW doc AS (PARTITION BY r ORDER BY i)),
summed AS (
  SELECT r, count(*) AS n, sum(ln(score)) AS log_prob, count(*) FILTER (c3 > 0) AS n3,
         count(*) FILTER (c3 = 0 AND c2 > 0) AS n2, count(*) FILTER (c3 = 0 AND c2 = 0 AND c1 > 0) AS n1
  FROM scored GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_words, round(log_prob / n, 6) AS mean_log_prob,
       coalesce(n3, 0) AS n_trigram, coalesce(n2, 0) AS n_bigram, coalesce(n1, 0) AS n_unigram
FROM docs LEFT JOIN summed USING (r)
"""
}
