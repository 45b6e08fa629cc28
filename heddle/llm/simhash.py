"""SimHash near-dedup with BK-trees.

Fingerprints that differ in at most r bits agree on all but r of their bit
blocks, so (set of blocks, their value) names a shard and any link lies within a
shard; how many blocks there are follows from the number of fingerprints. A
shard's distinct fingerprints form BK-trees (children keyed by their Hamming
distance to the parent), each tree goes to the shard's queries, and a search
follows only the edges within r of its distance. Large shards are cut into
pieces; each pair of pieces is a task of bounded size of its own. What leaves
a task is a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.llm.components import components, local_roots
from heddle.llm.copies import near_copies
from heddle.llm.shared import drop, stored
from heddle.sources import read_table

SEED = 42
SHINGLE = 3
RADIUS = 3
PIECE = 512
SHARD = 64  # fingerprints to a shard, about
SEARCH = 1 << 20  # (query, node) pairs looked at together


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of ``text`` (UTF-8); 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and the white space \\x20 \\x09-\\x0D
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(x) for x in zip(*(words[i:] for i in range(width)))]
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, len(shingles), 65536):
        h = np.array([digest(x, SEED) for x in shingles[start : start + 65536]], dtype=">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(shingles)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, text_hash long, fp long) of every row; a null text counts as empty. text_hash is Spark's xxhash64 of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or b"", width) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["id", "text_hash", "fp"])

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("t"))
    return rows.mapInArrow(run, "id long, text_hash long, fp long")


class BKForest:
    """One BK-tree for each group, built and searched a level at a time over all groups at once.

    Nodes of a group must be distinct. child_key, sorted, holds 65 * parent +
    distance; child has the node that it leads to.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        self.values = values
        groups_of, first = np.unique(groups, return_index=True)
        self.roots = dict(zip(groups_of.tolist(), first.tolist()))
        at = first[np.searchsorted(groups_of, groups)]
        rest = np.flatnonzero(at != np.arange(len(values)))
        keys, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(rest):
            key = at[rest].astype(np.int64) * 65 + np.bitwise_count(values[rest] ^ values[at[rest]])
            unique, which, back = np.unique(key, return_index=True, return_inverse=True)
            child = rest[which]
            keys.append(unique)
            nodes.append(child)
            at[rest] = child[back]
            rest = rest[child[back] != rest]
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.argsort(key, kind="stable")
        self.child_key, self.child = key[order], node[order]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, node) of every node within ``radius`` of a query in the tree under its root."""
        found_q, found_n = [], []
        q, node = np.arange(len(queries)), roots
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            hit = d <= radius
            found_q.append(q[hit])
            found_n.append(node[hit])
            base = node.astype(np.int64) * 65
            low = np.searchsorted(self.child_key, base + np.maximum(d - radius, 0))
            n = np.searchsorted(self.child_key, base + np.minimum(d + radius, 64), side="right") - low
            q = np.repeat(q, n)
            node = self.child[np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)]
        return np.concatenate(found_q or [np.empty(0, np.int64)]), np.concatenate(found_n or [np.empty(0, np.int64)])


def linked(values: np.ndarray, groups: np.ndarray, in_tree: np.ndarray, asks: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its group's linked component; rows are distinct within a group."""
    tree = np.flatnonzero(in_tree)
    forest = BKForest(values[tree], groups[tree])
    queries = np.flatnonzero(asks)
    roots = np.array([forest.roots.get(g, -1) for g in groups[queries].tolist()], dtype=np.int64)
    queries, roots = queries[roots >= 0], roots[roots >= 0]
    sizes = dict(zip(*(x.tolist() for x in np.unique(groups[tree], return_counts=True))))
    ends = np.cumsum([sizes[g] for g in groups[queries].tolist()])
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    start = 0
    while start < len(queries):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SEARCH, side="right")))
        q, n = forest.search(values[queries[start:stop]], roots[start:stop], radius)
        a.append(queries[start:stop][q])
        b.append(tree[n])
        start = stop
    return local_roots(len(values), np.concatenate(a), np.concatenate(b))


def _flush(parts: list[np.ndarray], radius: int) -> pa.RecordBatch:
    block, value, one, two, role, fp = (np.concatenate(x) for x in zip(*parts))
    same = np.ones(len(fp), bool)
    same[1:] = (block[1:] == block[:-1]) & (value[1:] == value[:-1]) & (one[1:] == one[:-1]) & (two[1:] == two[:-1])
    same[0] = False
    groups = np.cumsum(~same)
    root = linked(fp.view(np.uint64), groups, role != 2, role != 1, radius)
    away = root != np.arange(len(fp))
    return pa.RecordBatch.from_arrays([pa.array(fp[away]), pa.array(fp[root[away]])], ["a", "b"])


def _links(batches: Iterable[pa.RecordBatch], radius: int, at_once: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Spanning links of shard rows that come sorted by shard; a shard's rows are looked at together."""
    parts, held = [], 0
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(cols[0]):
            continue
        parts.append(cols)
        held += len(cols[0])
        if held < at_once:
            continue
        cols = [np.concatenate(x) for x in zip(*parts)]
        last = np.all([c == c[-1] for c in cols[:4]], axis=0)
        cut = held - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield _flush([[c[:cut] for c in cols]], radius)
        parts, held = [[c[cut:] for c in cols]], held - cut
    if held:
        yield _flush(parts, radius)


def blocks_for(count: int, radius: int = RADIUS) -> int:
    """Bit blocks to cut fingerprints into, so that ``count`` of them leave SHARD to a shard, about.

    All but ``radius`` blocks are whole in a link, so more blocks give wider
    shard keys, and more of them: 16, 24 and 30 bits, and 4, 10 and 20 keys at
    radius 3.
    """
    for blocks in (radius + 1, radius + 2):
        if count <= SHARD << 64 // blocks * (blocks - radius):
            return blocks
    return radius + 3


def shards(fps: DataFrame, radius: int = RADIUS, piece: int = PIECE, keep: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """Fingerprints (fp) dealt to their shards: (block, value, one, two, role, fp) and the columns of ``keep``.

    A shard of over ``piece`` fingerprints has several pieces, and a row for
    each pair (one, two) of pieces that the fingerprint's own is part of.
    role: 0 is both in the tree and a query, 1 in the tree, 2 a query.
    """
    blocks = blocks or radius + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, whole in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in whole)
        value = F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
        keys.append(F.struct(F.lit(number).alias("block"), value.alias("value")))
    rows = fps.select("fp", *keep, F.explode(F.array(*keys)).alias("k")).select("k.block", "k.value", "fp", *keep)
    large = rows.groupBy("block", "value").count().where(F.col("count") > piece)
    large = large.select("block", "value", F.ceil(F.col("count") / piece).cast("int").alias("pieces"))
    cut = rows.join(large, ["block", "value"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("fp", *keep), F.col("pieces")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    return cut.select(
        "block",
        "value",
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("role"),
        "fp",
        *keep,
    )


def near_links(fps: DataFrame, radius: int = RADIUS, piece: int = PIECE, blocks: int | None = None) -> DataFrame:
    """(a long, b long): links that connect exactly what chains of fingerprints within ``radius`` bits connect."""
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["block", "value", "one", "two"]
    dealt = shards(fps, radius, piece, blocks=blocks or blocks_for(fps.count(), radius)).repartition(parts, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(lambda batches: _links(batches, radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, radius: int = RADIUS, piece: int = PIECE, similarity: float | None = None) -> DataFrame:
    """(id, text_hash, fp, component): one row for each row of ``docs``; component is the smallest id reachable.

    Texts link if their fingerprints differ in ``radius`` bits at most or, with
    a ``similarity`` (0.8 or more), if the Jaccard similarity of their shingles
    is that or more; see near_copies() for what differs then.

    Null and empty texts have fingerprint 0 and link like others. Rows with a
    null id keep their row, very long texts are read whole; ids that are null don't stand for a component, and
    one of null ids only has a null component. Repeated rows repeat. Other
    columns of ``docs`` aren't read. An empty table gives no rows.
    """
    if similarity is not None:
        return near_copies(docs, id_col, text_col, width, similarity)
    seen = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = stored(seen.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = stored(components(near_links(nodes.select("fp"), radius, piece)), "roots")
    named = stored(nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "named")
    low = stored(named.groupBy("root").agg(F.min("first").alias("component")), "low")
    classes = stored(named.join(low, "root").select(F.col("fp").alias("of"), "component"), "classes")
    drop(nodes, roots, named, low)
    return seen.join(classes, F.col("fp") == F.col("of"), "left").select("id", "text_hash", "fp", "component")


def op1_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of all documents."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


QUERIES = {"op1_simhash_bktree": op1_simhash_bktree}
ORACLE_SQL: dict[str, str] = {}
