"""Line dedup with fuzzy lines.

Normalised lines get a digest and a MinHash sketch of their character grams in
the pass that reads the texts. Keys of the sketch take the place of a SimHash's
bit blocks: they are what similar lines share (see the README for the recall of
either). Most keys are one line's own, so one aggregate finds the keys of
several lines before anything but keys and digests is shuffled. Only lines with
a neighbour whose sketch and length allow the similarity come into question, so
only their texts are fetched, through a bitmap sized by their number. Pairs are
verified by edit similarity, each line with its smallest neighbour first; of the
other pairs only those whose lines these links leave apart need it. Each
connected group keeps its first occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.llm.components import components
from heddle.llm.shared import drop, stored, unused
from heddle.sources import read_table

BINS = 32  # of a sketch
#: Lines are compared by all schemes that allow their length; any two lines of
#: similarity 0.8 have one in common, as each reaches 5/4 of the next one's start.
TINY = range(4, 10)  # characters: one edit at most, so that some deletion of each, or the line itself, is equal
SHORT, SHORT_GRAM = range(8, 41), 6  # a key for every second bin
MIDDLE = range(32, 76)  # SHORT_GRAM too; a key for two bins that stand apart
LONG, LONG_GRAM, LONG_KEYS = range(60, 1 << 62), 12, 10  # as MIDDLE, so many keys
#: How a key's pairs are compared, in its lowest bits: not at all; by bitmaps of the lines' bigrams, of which an edit
#: changes two; or by so many equal bins at least, of 4 bits each (those that differ agree once in 16 by chance), MIDDLE
#: by its bigrams too.
ANY, SHORT_KIND, LONG_KIND, MIDDLE_KIND = 0, 1, 2, 3
AGREE = {LONG_KIND: 10, MIDDLE_KIND: 8}
BIGRAMS = 6  # numbers of a bitmap
SIMILAR = 0.8  # 1 - edits / length of the longer line
MIN_WORDS = 1
PIECE = 512
BITMAP, BITMAP_MOST = 1 << 24, 1 << 28  # bits, 16 for each line that is asked for; beyond the most, more lines travel than are asked for
PAIRS = 1 << 18  # looked at together
WORDS_AT_ONCE = 100_000
CHARS_AT_ONCE = 1 << 18
PAIRS_AT_ONCE, STEP_CHARS, FEW = 4096, 128, 32  # pairs that are verified together; characters of those whose distances are found in step
BROADCAST = 1 << 20  # rows of a number or two; more of them are joined


def normal(line: str) -> str:
    """Lower case, with single spaces."""
    return " ".join(line.lower().split())


def line_digest(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "replace"))


def simhashes(lines: list[str]) -> np.ndarray:
    """64-bit SimHash of each line's distinct words, those without a letter or digit left out: bars of a table say nothing."""
    out = np.zeros(len(lines), np.uint64)
    known: dict[str, int] = {}
    hashes: list[int] = []
    words: list[int] = []
    ends = np.zeros(len(lines), np.int64)
    for n, line in enumerate(lines):
        for w in set(line.split()):
            k = known.get(w)
            if k is None:
                k = -1
                if any(map(str.isalnum, w)):
                    k = len(hashes)
                    hashes.append(xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), 1))
                known[w] = k
            if k >= 0:
                words.append(k)
        ends[n] = len(words)
    if not words:
        return out
    # a row of 64 votes for each known word; eight votes are added in one 64-bit number, by runs of 255 words at most
    rows = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
    number = np.array(words)
    begins = np.concatenate([[0], ends[:-1]])
    full = np.flatnonzero(ends > begins)
    start = 0
    while start < len(full):
        stop = max(start + 1, int(np.searchsorted(ends[full], begins[full[start]] + WORDS_AT_ONCE)))
        own = full[start:stop]
        low = begins[own[0]]
        runs = -(-(ends - begins)[own] // 255)
        first = np.cumsum(runs) - runs
        at = np.repeat(begins[own] - low, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first, runs))
        votes = np.add.reduceat(rows[number[low : ends[own[-1]]]], at, axis=0).view(np.uint8)
        votes = np.add.reduceat(votes, first, axis=0, dtype=np.int32)
        packed = np.packbits(2 * votes > (ends - begins)[own, None], axis=1)
        out[own] = packed.view(">u8").ravel().astype(np.uint64)
        start = stop
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _gram_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` codes from each place on."""
    out, done, part, reach = None, 0, _mixed(codes.astype(np.uint64) + np.uint64(1)), 1
    while width:
        if width & 1:
            own = np.zeros_like(part)
            own[: len(part) - done] = part[done:]
            out = own if out is None else _mixed(out * np.uint64(0x100000001B3) + own)
            done += reach
        width >>= 1
        if width:
            wider = part.copy()
            wider[:-reach] = _mixed(part[:-reach] * np.uint64(0x100000001B3) + part[reach:])
            part, reach = wider, 2 * reach
    return out


def _sketched(lines: list[str], gram: int) -> np.ndarray:
    pad = "\0" * (gram - 1)
    text = pad + pad.join(lines) + pad
    h = _gram_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), gram)
    # as many grams as characters: those that begin before a line hold its first ones only
    n = np.array([len(x) for x in lines])
    begins = np.cumsum(n + gram - 1) - (n + gram - 1)
    line = np.repeat(np.arange(len(lines)), n)
    return minima(h[np.repeat(begins, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)], line, len(lines))


def minima(gram: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    """Sketches of lines 0..n-1, each with one gram at least: gram k is of line[k]."""
    none = np.uint64(2**64 - 1)
    low = np.full(n * BINS, none)
    np.minimum.at(low, line * BINS + (gram % np.uint64(BINS)).astype(np.int64), gram)
    low = low.reshape(-1, BINS)
    # an empty bin takes the next one that is not, and its distance
    at = np.where(low == none, 2 * BINS, np.arange(BINS))
    after = np.minimum.accumulate(np.concatenate([at, at + BINS], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    return _mixed(np.take_along_axis(low, after % BINS, axis=1) + (after - np.arange(BINS)).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def sketches(lines: list[str], gram: int) -> np.ndarray:
    """BINS minima of each line's hashed ``gram``-character grams, one permutation cut into bins. Lines are not empty."""
    out, start, held = [np.empty((0, BINS), np.uint64)], 0, 0
    for stop, line in enumerate(lines, 1):
        held += len(line)
        if held >= CHARS_AT_ONCE or stop == len(lines):
            out.append(_sketched(lines[start:stop], gram))
            start, held = stop, 0
    return np.concatenate(out)


def _numbered(values: np.ndarray, kind: int) -> np.ndarray:
    """Keys: a column's number goes into the hash, the kind into the lowest bits."""
    columns = np.arange(1, values.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    return _mixed(values + columns) & np.uint64(2**64 - 4) | np.uint64(kind)


def bands(sketch: np.ndarray, keys: int, kind: int) -> np.ndarray:
    """``keys`` keys of each sketch, of two bins that stand apart, as empty bins resemble their neighbours."""
    half = BINS // 2
    return _numbered(sketch[:, :keys] * np.uint64(31) + sketch[:, half : half + keys], kind)


def bigrams(lines: list[str], words: int = 2) -> np.ndarray:
    """Bitmap (``words`` numbers) of each line's bigrams, the first, second, ... occurrence of each told apart; lines have two characters or more."""
    h = _gram_hashes(np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32), 2)
    n = np.array([len(x) for x in lines])
    own = np.ones(len(h), bool)
    own[np.cumsum(n) - 1] = False  # it crosses into the next line
    h, line = h[own], np.repeat(np.arange(len(lines)), n)[own]
    order = np.lexsort((h, line))
    h, line = h[order], line[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    at = np.arange(len(h))
    h = _mixed(h + (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    out = np.zeros((len(lines), words), np.uint64)
    np.bitwise_or.at(out, (line, (h >> np.uint64(6)) % np.uint64(words)), np.uint64(1) << (h & np.uint64(63)))
    return out


def keys_of(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key) of each key in order of lines, and the numbers that keys of a kind are compared by (lines x kinds x MAPS): bigrams, a sketch's nibbles or both, 0 where a line has none."""
    length = np.array([len(x) for x in lines])
    at, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    maps = np.zeros((len(lines), 4, 2 + BIGRAMS), np.uint64)

    def add(own: np.ndarray, values: np.ndarray) -> None:
        at.append(np.repeat(own, values.shape[1]))
        keys.append(values.ravel())

    def among(lengths: range, of: np.ndarray) -> np.ndarray:
        return np.flatnonzero((length[of] >= lengths.start) & (length[of] < lengths.stop))

    for n in among(TINY, np.arange(len(lines))).tolist():
        line = lines[n]
        forms = sorted({line, *(line[:i] + line[i + 1 :] for i in range(len(line)))})
        hashes = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "replace"), 2) for x in forms], np.uint64)
        add(np.array([n]), (hashes & np.uint64(2**64 - 4) | np.uint64(ANY))[None, :])
    own = among(range(SHORT.start, MIDDLE.stop), np.arange(len(lines)))
    if len(own):
        sketch = sketches([lines[n] for n in own.tolist()], SHORT_GRAM)
        maps[own, SHORT_KIND, :BIGRAMS] = maps[own, MIDDLE_KIND, 2:] = bigrams([lines[n] for n in own.tolist()], BIGRAMS)
        maps[own, MIDDLE_KIND, :2] = nibbles(sketch)
        k = among(SHORT, own)
        add(own[k], _numbered(sketch[k][:, ::2], SHORT_KIND))
        k = among(MIDDLE, own)
        add(own[k], bands(sketch[k], BINS // 2, MIDDLE_KIND))
    own = among(LONG, np.arange(len(lines)))
    if len(own):
        sketch = sketches([lines[n] for n in own.tolist()], LONG_GRAM)
        maps[own, LONG_KIND, :2] = nibbles(sketch)
        add(own, bands(sketch, LONG_KEYS, LONG_KIND))
    line, key = np.concatenate(at), np.concatenate(keys)
    order = np.argsort(line, kind="stable")
    return line[order], key[order], maps


def nibbles(sketch: np.ndarray) -> np.ndarray:
    """4 bits of each bin, 16 bins a number."""
    shift = np.arange(0, 64, 4, dtype=np.uint64)
    return np.bitwise_or.reduce((sketch & np.uint64(15)).reshape(len(sketch), BINS // 16, 16) << shift, axis=2)


def agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the 16 nibbles of x and y are equal."""
    d = x ^ y
    d |= d >> np.uint64(1)
    d |= d >> np.uint64(2)
    return 16 - np.bitwise_count(d & np.uint64(0x1111111111111111)).astype(np.int64)


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or some number over ``most`` if it is more than that (Myers' bit vectors)."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
        if len(a) > 64 and len(b) > 64 and a[-64:] == b[-64:]:
            a, b = a[:-64], b[:-64]
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = mask, 0, len(a)
    for j, c in enumerate(b):
        eq = where.get(c, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus = down | ~(diagonal | up) & mask
        minus = up & diagonal
        score += bool(plus & last) - bool(minus & last)
        if score - (len(b) - 1 - j) > most:
            return most + 1
        plus = plus << 1 | 1
        up = (minus << 1 | ~(vertical | plus)) & mask
        down = plus & vertical & mask
    return score


def aligned(x: list[str], y: list[str], most: int, ahead: int = 4) -> bool:
    """Whether words that are passed over up to the next equal ones, a few ahead, bound the distance by ``most`` from above."""
    i = j = cost = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i += 1
            j += 1
            continue
        p, q = next(((p, n - p) for n in range(1, 2 * ahead) for p in range(max(0, n - ahead), min(n, ahead) + 1) if i + p < len(x) and j + n - p < len(y) and x[i + p] == y[j + n - p]), (1, 1))
        cost += max(sum(map(len, x[i : i + p])) + p, sum(map(len, y[j : j + q])) + q)
        if cost > most:
            return False
        i += p
        j += q
    return cost + sum(len(w) + 1 for w in (*x[i:], *y[j:])) <= most


def edit_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Levenshtein distances of a[k] and b[k], all in step: Myers' bit vectors, 64 characters of a[k] a word, with carries between the words.

    Takes 8 bytes for each pair, word and letter; strings of like lengths waste the least.
    """
    n, m = (np.array([len(x) for x in s]) for s in (a, b))
    out, score = np.where(n == 0, m, n), n.copy()
    words = -(-int(n.max(initial=0)) // 64)
    if not words or not m.any():
        return out
    letters, code = np.unique(np.frombuffer("".join(a + b).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
    first, second = code[: n.sum()], code[n.sum() :]
    row = np.repeat(np.arange(len(a)), n)
    place = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
    equal = np.zeros((words, len(a) * len(letters)), np.uint64)
    np.bitwise_or.at(equal.reshape(-1), (place // 64 * len(a) + row) * len(letters) + first, np.uint64(1) << (place % 64).astype(np.uint64))
    longest = int(m.max())
    text = np.zeros((longest, len(a)), np.int64)  # a column's letter of each pair; pairs that have ended go on with any
    text[np.arange(len(second)) - np.repeat(np.cumsum(m) - m, m), np.repeat(np.arange(len(b)), m)] = second
    text += np.arange(len(a)) * len(letters)
    order = np.argsort(m, kind="stable")
    cut = np.searchsorted(m[order], np.arange(1, longest + 2))
    ends = [order[cut[j] : cut[j + 1]] for j in range(longest)]
    one, top, full = np.uint64(1), np.uint64(63), np.uint64(2**64 - 1)
    up, down = np.full((words, len(a)), full), np.zeros((words, len(a)), np.uint64)
    last = [np.where(np.maximum(n - 1, 0) // 64 == w, one << (np.maximum(n - 1, 0) % 64).astype(np.uint64), np.uint64(0)) for w in range(words)]
    counts = [bool(x.any()) for x in last]
    for j in range(longest):
        plus, minus = np.ones(len(a), np.uint64), np.zeros(len(a), np.uint64)
        for w in range(words):
            u, d = up[w], down[w]
            eq = equal[w].take(text[j])
            vertical = eq | d
            eq |= minus
            p = eq & u
            p += u
            p ^= u
            p |= eq
            q = u & p
            p |= u
            np.invert(p, out=p)
            p |= d
            if counts[w]:
                score += (p & last[w]) != 0
                score -= (q & last[w]) != 0
            carry = p >> top, q >> top
            p <<= one
            p |= plus
            q <<= one
            q |= minus
            plus, minus = carry
            np.bitwise_and(p, vertical, out=d)
            vertical |= p
            np.invert(vertical, out=vertical)
            np.bitwise_or(vertical, q, out=u)
        if len(ends[j]):
            out[ends[j]] = np.where(n[ends[j]] == 0, m[ends[j]], score[ends[j]])
    return out


def similar(a: str, b: str, least: float = SIMILAR) -> bool:
    most = int((1 - least) * max(len(a), len(b)) + 1e-9)
    return aligned(a.split(" "), b.split(" "), most) or edit_distance(a, b, most) <= most


def similar_lines(a: list[str], b: list[str], least: float = SIMILAR) -> np.ndarray:
    """Whether a[k] and b[k] have an edit similarity of ``least`` or more."""
    most = np.array([int((1 - least) * max(len(x), len(y)) + 1e-9) for x, y in zip(a, b)], np.int64)
    good = np.array([aligned(x.split(" "), y.split(" "), z) for x, y, z in zip(a, b, most.tolist())], bool)
    size = np.array([min(len(x), len(y)) for x, y in zip(a, b)])
    rest = np.flatnonzero(~good)
    step = rest[size[rest] <= STEP_CHARS]
    if len(step) < FEW:
        step = rest[:0]
    for k in np.setdiff1d(rest, step).tolist():  # of long strings: numbers of any length take fewer operations
        good[k] = edit_distance(a[k], b[k], int(most[k])) <= most[k]
    if len(step):
        swap = [(a[k], b[k]) if len(a[k]) <= len(b[k]) else (b[k], a[k]) for k in step.tolist()]
        good[step] = edit_distances([x for x, _ in swap], [y for _, y in swap]) <= most[step]
    return good


MAPS = [f"map_{i}" for i in range(2 + BIGRAMS)]
COMPARED = ["chars", *(f"bigrams_{i}" for i in range(BIGRAMS)), *(f"nibbles_{k}_{i}" for k in (LONG_KIND, MIDDLE_KIND) for i in range(2)), "sim"]
COMPARED_KINDS = "chars int, " + ", ".join(f"{c} long" for c in COMPARED[1:])


def _lines(min_words: int, radius: int | None):
    def lines_of(texts: list[str | None]):
        """Rows, line numbers, normalised lines and lines of ``texts``, some CHARS_AT_ONCE characters together."""
        which, number, lines, raws, held = [], [], [], [], 0
        for row, text in enumerate(texts):
            for n, raw in enumerate((text or "").split("\n")):
                line = normal(raw)
                if line and line.count(" ") >= min_words - 1:
                    which.append(row)
                    number.append(n)
                    lines.append(line)
                    raws.append(raw)
                    held += len(line)
                    if held >= CHARS_AT_ONCE:
                        yield which, number, lines, raws
                        which, number, lines, raws, held = [], [], [], [], 0
        yield which, number, lines, raws

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which, number, lines, raws in lines_of(batch.column(2).to_pylist()):
                digest = np.array([line_digest(x) for x in lines], dtype=np.uint64)
                rows = pa.array(which, pa.int64())
                # what a line is compared by stands at its first occurrence of those looked at together
                _, once = np.unique(digest, return_index=True)
                own = [lines[k] for k in once.tolist()]
                line, keys, maps = keys_of(own)
                sim = np.zeros(len(own), np.uint64) if radius is None else simhashes(own)
                raw = np.array([line_digest(raws[k]) for k in once.tolist()], np.uint64)
                place = np.full(len(lines), -1)
                place[once] = np.arange(len(once))
                at = pa.array(place, mask=place < 0)
                ends = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(own)))]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64)))
                compared = [*maps[:, SHORT_KIND, :BIGRAMS].T, *maps[:, LONG_KIND, :2].T, *maps[:, MIDDLE_KIND, :2].T, sim, raw]
                compared = [np.ascontiguousarray(x).view(np.int64) for x in compared]
                chars = pa.array(np.array([len(x) for x in own], np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(number, pa.int32()), pa.array(digest.view(np.int64)), listed.take(at), chars.take(at), *(pa.array(x).take(at) for x in compared)],
                    ["id", "text_hash", "line", "digest", "keys", *COMPARED, "raw"],
                )

    return run


def shards(seen: DataFrame, piece: int = PIECE) -> tuple[DataFrame, list[DataFrame]]:
    """Lines dealt by the keys that several lines have: (key, one, two, role, digest, chars, MAPS, sim); the stored tables that it reads.

    A key of over ``piece`` lines has its lines cut into pieces, and a row for
    each pair (one, two) of pieces that the line's own is part of. role: 0 is
    compared with 0 and 1, 1 with 2, of the same key and pair.
    """
    first = seen.where("keys is not null")
    keys = first.select("digest", F.explode("keys").alias("key"))
    several = keys.groupBy("key").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least < most").select("key")
    several = stored(several, "shared_keys")
    # under the bound no line's keys are shuffled a second time
    rows = stored(keys.join(F.broadcast(several) if several.count() <= BROADCAST else several, "key").distinct(), "dealt")
    compared = first.groupBy("digest").agg(*(F.first(c).alias(c) for c in COMPARED))
    large = rows.groupBy("key").count().where(F.col("count") > piece)
    large = stored(large.select("key", F.ceil(F.col("count") / piece).cast("int").alias("pieces")), "large_keys")
    cut = rows.join(F.broadcast(large) if large.count() <= BROADCAST else large, "key", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    cut = cut.join(compared, "digest").withColumn("own", F.pmod(F.xxhash64("digest"), F.col("pieces")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    role = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("role")
    kind = F.col("key").bitwiseAND(3)
    nibbles_of = [F.when(kind == LONG_KIND, F.col(f"nibbles_{LONG_KIND}_{i}")).otherwise(F.col(f"nibbles_{MIDDLE_KIND}_{i}")) for i in range(2)]
    short = [*(F.col(f"bigrams_{i}") for i in range(BIGRAMS)), F.lit(0), F.lit(0)]
    other = [*nibbles_of, *(F.when(kind == MIDDLE_KIND, F.col(f"bigrams_{i}")).otherwise(0) for i in range(BIGRAMS))]
    maps = [F.when(kind == SHORT_KIND, x).otherwise(y).alias(m) for m, x, y in zip(MAPS, short, other)]
    return cut.select("key", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), role, "digest", "chars", *maps, "sim"), [several, rows, large]


DEALT = ["key", "one", "two"]


def _groups(table: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one row of each shard task in sorted rows."""
    fresh = np.ones(len(table["key"]), bool)
    fresh[1:] = np.any([table[k][1:] != table[k][:-1] for k in DEALT], axis=0)
    first = np.flatnonzero(fresh)
    return first, np.append(first[1:], len(fresh))


def comparable(kind: np.ndarray, maps: list[tuple[np.ndarray, np.ndarray]], edits: np.ndarray) -> np.ndarray:
    """Whether pairs under keys of these kinds may differ in so many edits: certain for short lines, likely for others."""
    ok = np.ones(len(kind), bool)
    for own_kind, least in AGREE.items():
        k = np.flatnonzero(kind == own_kind)
        ok[k] = sum(agreeing(x[k], y[k]) for x, y in maps[:2]) >= least
    for own_kind, own in ((SHORT_KIND, maps), (MIDDLE_KIND, maps[2:])):
        k = np.flatnonzero((kind == own_kind) & ok)
        for flip in (False, True):
            apart = np.zeros(len(k), np.int64)
            for x, y in own:
                apart += np.bitwise_count((y[k] & ~x[k]) if flip else (x[k] & ~y[k]))
            ok[k[apart > 2 * edits[k]]] = False
    return ok


def _pairs(table: dict[str, np.ndarray], least: float, radius: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the same key and pair of pieces whose lengths allow a similarity of ``least``, whose sketches agree as their key's kind asks, and whose SimHashes agree but for ``radius`` bits."""
    first, last = _groups(table)
    end = np.repeat(last, last - first)
    left = np.flatnonzero(end - np.arange(len(end)) > 1)
    later = end[left] - left - 1
    total = np.cumsum(later)
    start = 0
    while start < len(left):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS, side="right")))
        n = later[start:stop]
        a = np.repeat(left[start:stop], n)
        b = a + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = stop
        near = (table["role"][a] == 0) | (table["role"][a] != table["role"][b])
        x, y = table["chars"][a], table["chars"][b]
        near &= np.abs(x - y) <= (1 - least) * np.maximum(x, y) + 1e-9
        a, b = a[near], b[near]
        near = comparable(table["key"][a] & 3, [(table[k][a], table[k][b]) for k in MAPS], ((1 - least) * np.maximum(x, y)[near] + 1e-9).astype(np.int64))
        if radius is not None:
            near &= np.bitwise_count(table["sim"][a] ^ table["sim"][b]) <= radius
        yield a[near], b[near]


def _whole_shards(work, at_once: int):
    """``work`` on rows that come sorted by shard task, never cutting a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) < at_once:
                continue
            rows = pa.Table.from_batches(held)
            apart = np.any([(c := rows.column(k).to_numpy()) != c[-1] for k in DEALT], axis=0)
            cut = int(np.flatnonzero(apart)[-1]) + 1 if apart.any() else 0
            if cut:
                yield work(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield work(pa.Table.from_batches(held))

    return run


def _numeric(rows: pa.Table) -> dict[str, np.ndarray]:
    table = {k: rows.column(k).to_numpy() for k in (*DEALT, "role", "chars")}
    return table | {k: rows.column(k).to_numpy().view(np.uint64) for k in (*MAPS, "sim")}


def _neighbours(least: float, radius: int | None):
    """Rows that have a neighbour, and in ``nearest`` the smallest digest among a row and its neighbours."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        table, digest = _numeric(rows), rows.column("digest").to_numpy()
        low, has = digest.copy(), np.zeros(len(rows), bool)
        for a, b in _pairs(table, least, radius):
            has[a] = has[b] = True
            np.minimum.at(low, a, digest[b])
            np.minimum.at(low, b, digest[a])
        at = np.flatnonzero(has)
        return pa.RecordBatch.from_arrays([*(rows.column(k).combine_chunks().take(pa.array(at)) for k in rows.schema.names), pa.array(low[at])], [*rows.schema.names, "nearest"])

    return work


def _similar_rows(least: float, alike: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), PAIRS_AT_ONCE):
                part = batch.slice(start, PAIRS_AT_ONCE)
                good = alike(part.column("ta").to_pylist(), part.column("tb").to_pylist(), least)
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _apart(least: float, radius: int | None):
    """Rows that have a neighbour of another label."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        table, label = _numeric(rows), rows.column("label").to_numpy()
        has = np.zeros(len(rows), bool)
        for a, b in _pairs(table, least, radius):
            other = label[a] != label[b]
            has[a[other]] = has[b[other]] = True
        at = pa.array(np.flatnonzero(has))
        return pa.RecordBatch.from_arrays([rows.column(k).combine_chunks().take(at) for k in rows.schema.names], rows.schema.names)

    return work


def _verified(least: float, radius: int | None, alike: Callable):
    def work(rows: pa.Table) -> pa.RecordBatch:
        table, digest, text = _numeric(rows), rows.column("digest").to_numpy(), rows.column("t")
        keys = [frozenset(k) for k in rows.column("keys").to_pylist()]
        _, label = np.unique(rows.column("label").to_numpy(), return_inverse=True)
        parent = list(range(int(label.max()) + 1)) if len(label) else []

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        found, held = [], []

        def verify() -> None:
            # labels may have met since the pairs were held
            pairs = [(i, j) for i, j in held if root(int(label[i])) != root(int(label[j]))]
            held.clear()
            for (i, j), good in zip(pairs, alike([text[i].as_py() for i, _ in pairs], [text[j].as_py() for _, j in pairs], least)):
                x, y = root(int(label[i])), root(int(label[j]))
                if good and x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((digest[i], digest[j]))

        for a, b in _pairs(table, least, radius):
            other = label[a] != label[b]
            for i, j in zip(a[other].tolist(), b[other].tolist()):
                if root(int(label[i])) != root(int(label[j])) and table["key"][i] == min(k for k in keys[i] & keys[j] if (k ^ table["key"][i]) & 3 == 0):
                    held.append((i, j))
                    if len(held) == PAIRS_AT_ONCE:
                        verify()
        if held:
            verify()
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return work


def _wanted(bitmap, min_words: int):
    """(digest, t) of the normalised lines whose digests before that are in the bitmap."""

    def sent(found: dict[int, str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.array(list(found), np.uint64).view(np.int64)), pa.array(found.values(), pa.string())], ["digest", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        size = 8 * len(bits)
        found: dict[int, str] = {}
        held = 0
        for batch in batches:
            for text in batch.column(0):
                for raw in (text.as_py() or "").split("\n"):
                    at = line_digest(raw) % size
                    if bits[at >> 3] >> (at & 7) & 1:
                        line = normal(raw)
                        if line and line.count(" ") >= min_words - 1:
                            found[line_digest(line)] = line
                            held += len(line)
                if held >= CHARS_AT_ONCE:
                    yield sent(found)
                    found, held = {}, 0
        yield sent(found)

    return run


def _bitmap(digests: DataFrame, size: int = BITMAP) -> bytes:
    """``size`` bits, those of the digests' remainders set; it reaches the driver as that many bits at most."""
    at = digests.select(F.pmod("digest", F.lit(size)).alias("at"))
    # pmod of a signed digest equals the remainder of the unsigned one: size divides 2^64
    parts = at.groupBy(F.expr("bitmap_bucket_number(at + 1)").alias("n")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at + 1))").alias("bits"))
    out = bytearray(size // 8)
    for row in parts.toLocalIterator():
        out[(row.n - 1) * 4096 : row.n * 4096] = bytes(row.bits)
    return bytes(out)


def linked(seen: DataFrame, texts: Callable[[DataFrame], DataFrame], alike: Callable, least: float, radius: int | None = None, piece: int = PIECE) -> DataFrame:
    """(node, root) of the digests that alike(texts, texts, least) connects pair by pair, of those that share a key.

    seen: (digest, keys, COMPARED), a digest once or more; null keys are passed
    over. texts gives (digest, t) of the digests that it is asked for, others
    too. ``chars`` bounds the similarity of a pair.
    """
    parts = int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt, tables = shards(seen, piece)
    dealt = dealt.repartition(parts, *DEALT).sortWithinPartitions(*DEALT)
    kind = T.StructType([*dealt.schema.fields, T.StructField("nearest", T.LongType())])
    near = stored(dealt.mapInArrow(_whole_shards(_neighbours(least, radius), 20_000), kind), "near")
    drop(*tables)
    first = stored(near.groupBy("digest").agg(F.min("nearest").alias("nearest")), "first")
    fetched = stored(texts(first.select("digest")).groupBy("digest").agg(F.first("t").alias("t")).withColumnRenamed("digest", "of"), "fetched")
    pairs = first.where("nearest < digest").select(F.col("digest").alias("a"), F.col("nearest").alias("b"))
    pairs = pairs.join(fetched.withColumnRenamed("t", "ta"), F.col("a") == F.col("of")).drop("of")
    pairs = pairs.join(fetched.withColumnRenamed("t", "tb"), F.col("b") == F.col("of")).drop("of")
    stars = stored(pairs.mapInArrow(_similar_rows(least, alike), "a long, b long"), "stars")
    labels = stored(components(stars), "labels")
    rest = near.drop("nearest").join(labels, F.col("digest") == F.col("node"), "left").drop("node")
    rest = rest.withColumn("label", F.coalesce("root", "digest")).drop("root").repartition(parts, *DEALT).sortWithinPartitions(*DEALT)
    rest = stored(rest.mapInArrow(_whole_shards(_apart(least, radius), 20_000), rest.schema), "rest")
    held = rest.groupBy("digest").agg(F.collect_set("key").alias("keys"))
    again = rest.join(held, "digest").join(fetched, F.col("digest") == F.col("of")).drop("of").repartition(parts, *DEALT).sortWithinPartitions(*DEALT)
    more = stored(again.mapInArrow(_whole_shards(_verified(least, radius, alike), 4_000), "a long, b long"), "links")
    roots = stored(components(stars.union(more)), "roots")
    drop(near, first, fetched, stars, labels, rest, more)
    return roots


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int | None = None, least: float = SIMILAR, min_words: int = MIN_WORDS, piece: int = PIECE) -> DataFrame:
    """(id, text_hash, lines array<int>): for each document that loses lines, the numbers of those, from 0.

    Lines are equal if they are so in lower case and with single spaces. They
    link if their edit similarity is ``least`` (0.8 or more) or more and a key
    of theirs agrees (see the README for how many links that misses), and, with
    a ``radius``, if the SimHashes of their words differ in so many bits at
    most; a group is what links and equality connect. Its first occurrence
    stays: smallest id (null last), text hash, line number. Lines of fewer than
    ``min_words`` words aren't looked at, blank ones never are. Rows of equal id
    and text count as one document. Very long texts and lines are taken whole.
    Other columns aren't read. Empty tables, null and empty texts lose nothing.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))
    seen = stored(rows.mapInArrow(_lines(min_words, radius), f"id long, text_hash long, line int, digest long, keys array<long>, {COMPARED_KINDS}, raw long"), "lines")

    def texts(digests: DataFrame) -> DataFrame:
        raw = stored(seen.where("keys is not null").join(digests, "digest", "left_semi").select(F.col("raw").alias("digest")), "wanted")
        size = min(BITMAP_MOST, max(BITMAP, 1 << (16 * raw.count()).bit_length()))
        bitmap = spark.sparkContext.broadcast(_bitmap(raw, size))
        return docs.select(text.alias("t")).mapInArrow(_wanted(bitmap, min_words), "digest long, t string")

    roots = linked(seen, texts, similar_lines, least, radius, piece=piece)
    grouped = seen.select("id", "text_hash", "line", "digest").join(roots, F.col("digest") == F.col("node"), "left")
    grouped = stored(grouped.select("id", "text_hash", "line", F.coalesce("root", "digest").alias("group")), "grouped")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash", "line")
    first = grouped.groupBy("group").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = stored(first.select(F.col("group").alias("of"), "first"), "first")
    gone = grouped.join(first, F.col("group") == F.col("of")).where(place != F.col("first"))
    gone = stored(gone.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("lines")), "gone")
    drop(seen, roots, grouped, first)
    return gone


def without_lines(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed: str = "n_removed") -> DataFrame:
    """``docs``, the lines that repeated_lines() names taken out of the texts, and their number in ``removed``, which replaces a column of that name.

    Null texts stay null; other columns, whatever their names, stay as they are.
    """
    of, text_hash, numbers = unused(docs, "of", "text_hash", "lines")
    named = gone.select(F.col("id").alias(of), F.col("text_hash").alias(text_hash), F.col("lines").alias(numbers))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(of)) & (F.xxhash64(text_col) == F.col(text_hash))
    lines = F.filter(F.split(text_col, "\n"), lambda line, i: ~F.array_contains(numbers, i))
    kept = F.when(F.col(numbers).isNull(), F.col(text_col)).otherwise(F.array_join(lines, "\n"))
    joined = docs.join(named, same, "left")
    return joined.select(*[kept.alias(c) if c == text_col else joined[c] for c in docs.columns if c != removed], F.when(F.col(numbers).isNull(), 0).otherwise(F.size(numbers)).alias(removed))


def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, text of all documents, the repeated lines taken out."""
    docs = read_table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"), "text")
    return without_lines(docs, repeated_lines(docs)).select("doc_id", "n_lines", "n_removed", "text")


QUERIES = {"op10_fuzzy_lines": op10_fuzzy_lines}
ORACLE_SQL: dict[str, str] = {}
