"""Near copies of whole texts: SimHash near-dedup at a Jaccard similarity of word shingles.

Texts of similarity 0.8 differ in some 10 of 64 SimHash bits, too many for
shards of equal bit blocks. So shards are dealt by keys of a MinHash sketch of
the shingles, as lines are in lines.py; within a shard the SimHashes are
compared, by a radius that similarity 0.8 does not reach, and each link is
verified on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.llm.lines import ANY, BINS, COMPARED, COMPARED_KINDS, bands, linked, minima
from heddle.llm.shared import drop, stored

WIDTH = 5
SIMILAR = 0.8
KEYS = 10  # of two minima each: at 0.8 all differ once in 27,000 pairs
RADIUS = 24  # bits; 10 in the mean at 0.8, with a deviation of 3
AT_ONCE = 65_536  # shingles whose votes are added together


def shingles(text: str | None, width: int = WIDTH) -> set[bytes]:
    """Word shingles; texts of fewer words have one, those without words none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(words) <= width:
        return {b" ".join(words)} if words else set()
    return {b" ".join(x) for x in zip(*(words[i:] for i in range(width)))}


def jaccard(a: str, b: str, least: float, width: int = WIDTH) -> bool:
    x, y = shingles(a, width), shingles(b, width)
    both = len(x & y)
    return both >= least * (len(x) + len(y) - both) - 1e-9


def simhash(grams: np.ndarray) -> int:
    """A bit is set if it is so in over half of ``grams`` (64-bit hashes)."""
    votes = np.zeros(64, np.int64)
    for start in range(0, len(grams), AT_ONCE):
        votes += np.unpackbits(grams[start : start + AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(grams)).tobytes(), "big")


def _sketched(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, sim, sketch = [], [], np.zeros((len(batch), BINS), np.uint64)
            for k, text in enumerate(batch.column(2)):
                gram = np.array([xxhash.xxh64_intdigest(x) for x in shingles(text.as_py(), width)], np.uint64)
                size.append(len(gram))
                sim.append(simhash(gram))
                if len(gram):
                    sketch[k] = minima(gram, np.zeros(len(gram), np.int64), 1)[0]
            has = np.array(size, int) > 0
            ends = np.concatenate([[0], np.cumsum(has)]).astype(np.int32) * KEYS
            keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands(sketch[has], KEYS, ANY).ravel().view(np.int64)))
            none = pa.array(np.zeros(len(batch), np.int64))
            compared = [pa.array(size, pa.int32()), *[none] * (len(COMPARED) - 2), pa.array(np.array(sim, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys, *compared], ["id", "digest", "keys", *COMPARED])

    return run


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, least: float = SIMILAR) -> DataFrame:
    """(id, text_hash, fp, component): one row for each row of ``docs``; fp is the SimHash
    of its shingles, component the smallest id reachable.

    Texts link if the Jaccard similarity of their shingles of ``width`` words
    (lower case) is ``least`` (0.8 or more) or more; texts without words, null
    ones too, are one text, very long ones are compared whole. Ids that are
    null don't stand for a component, and one of null ids only has a null
    component. Repeated rows repeat. Other columns aren't read. An empty table
    gives no rows.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("digest"), text.alias("t"))
    seen = stored(rows.mapInArrow(_sketched(width), f"id long, digest long, keys array<long>, {COMPARED_KINDS}"), "sketches")

    def texts(digests: DataFrame) -> DataFrame:
        return docs.select(F.xxhash64(text).alias("digest"), text.alias("t")).join(digests, "digest", "left_semi")

    roots = linked(seen.where("chars > 0"), texts, lambda a, b, s: [jaccard(x, y, s, width) for x, y in zip(a, b)], least, RADIUS)
    group = F.when(F.col("chars") > 0, F.coalesce("root", "digest"))  # null: without words
    named = stored(seen.select("id", "digest", "chars", "sim").join(roots, F.col("digest") == F.col("node"), "left").select("id", F.col("digest").alias("text_hash"), F.col("sim").alias("fp"), group.alias("group")), "named")
    drop(seen, roots)
    low = stored(named.groupBy("group").agg(F.min("id").alias("component")).select(F.col("group").alias("of"), "component"), "low")
    return named.join(low, F.col("group").eqNullSafe(F.col("of")), "left").select("id", "text_hash", "fp", "component")
