"""Embedding near-dedup by iterative quantisation (Gong and Lazebnik) and multi-index Hamming tables.

Rotations of the principal directions are learned so that the signs are
balanced, low-loss codes. Substrings of the codes are the keys of one hash table
each. Their width follows the number of vectors, and how many tables there are
follows from the share of bits that a turn by the threshold's angle flips on the
sample, so that the recall holds for vectors with a common mean too. Vectors
that share a substring and a label, and whose codes lie within a radius, are
candidates, and the original vectors decide.

Keys and codes are dealt to all tables; vectors only to those buckets in which
they have a candidate. A pair counts only in the first table that holds it, so
no table of pairs is ever made: a task sums up each vector's links and leaves a
spanning forest of them. Large buckets are cut into pieces, and each pair of
pieces is a task of bounded size of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.llm.components import components, local_roots
from heddle.llm.shared import drop, stored
from heddle.sources import read_table

COSINE = 0.98
RECALL = 0.98  # of pairs at the threshold, by the flips seen on the sample
WIDTHS = range(4, 25)  # bits of a substring
BUCKET = 32  # vectors of a label to a bucket, about
TABLES = 64  # at most; narrower substrings take the place of more
CODE = 128  # bits of a code at least
SAMPLE = 10_000  # vectors that the rotations are fitted on
ROUNDS = 40
PIECE = 128
PAIRS = 1 << 15  # looked at together
BROADCAST = 500_000  # buckets of more than a piece, of some 40 bytes each; more of them are joined
DEALT = ["bucket", "one", "two"]


def fit_rotations(x: np.ndarray, bits: int, rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection d x bits) for unit vectors ``x``: as many rotations of its principal directions as ``bits`` need."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    mean = x.mean(axis=0)
    _, vectors = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    basis = vectors[:, ::-1][:, : min(d, 64)]
    v = (x - mean) @ basis
    c = basis.shape[1]
    parts = []
    for _ in range(-(-bits // c)):
        r, _ = np.linalg.qr(rng.standard_normal((c, c)))
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        parts.append(basis @ r)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


def signs_of(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Code bits (n x bits) of unit vectors."""
    mean, projection = model
    return (x - mean) @ projection >= 0


def flips(x: np.ndarray, model: tuple[np.ndarray, np.ndarray], cosine: float, seed: int = 11) -> float:
    """Share of the code's bits that a turn of unit vectors to ``cosine`` flips."""
    turn = np.random.default_rng(seed).standard_normal(x.shape)
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-300)
    return float((signs_of(x, model) != signs_of(cosine * x + math.sqrt(1 - cosine**2) * turn, model)).mean())


def layout(n: int, flipped: float, recall: float = RECALL) -> tuple[int, int]:
    """(width, tables) for ``n`` vectors of a label: all substrings of a pair differ in a share of 1 - ``recall`` at most."""
    width = min(max(math.ceil(math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 0, WIDTHS.start), WIDTHS.stop - 1)
    while True:
        whole = (1 - flipped) ** width
        tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - whole))) if whole < 1 else 1
        if tables <= TABLES or width == 1:
            return width, min(tables, TABLES)
        width -= 1


def _unit(vectors: pa.Array, d: int) -> np.ndarray:
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    x /= np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow of the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _fit(distinct: DataFrame, sample: int, cosine: float) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], int, int, int]:
    """Models by length of vectors, width and number of the substrings, and the codes' radius."""
    rows = distinct.orderBy(F.xxhash64("vec"), "key").limit(sample).select("vec").toArrow().column("vec").combine_chunks()
    most = distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    lengths = np.array([len(v) for v in rows])
    units = {int(d): _unit(rows.filter(pa.array(lengths == d)), d) for d in np.unique(lengths) if (lengths == d).sum() >= 2 * d}
    chance = math.acos(cosine) / math.pi  # of random hyperplanes
    flipped = max([chance, *(flips(x, fit_rotations(x, min(64, CODE)), cosine) for x in units.values())])
    width, tables = layout(most, flipped)
    bits = -(-max(CODE, width * tables) // 64) * 64
    radius = math.ceil(bits * flipped + 6 * math.sqrt(bits * flipped * (1 - flipped)))
    return {d: fit_rotations(x, bits) for d, x in units.items()}, width, tables, min(radius, bits)


def _coded(models: dict, width: int, tables: int, bits: int):
    """Adds the substrings and the whole code of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column("vec")
            lengths = vec.value_lengths().to_numpy(zero_copy_only=False)
            signs = np.zeros((len(lengths), bits), bool)
            for d in np.unique(lengths).tolist():
                if d not in models:  # a length of which the sample has too few: random hyperplanes
                    models[d] = (np.zeros(d), np.random.default_rng(d).standard_normal((d, bits)))
                at = lengths == d
                signs[at] = signs_of(_unit(vec.filter(pa.array(at)), d), models[d])
            parts = (signs[:, : width * tables].reshape(-1, tables, width) @ (1 << np.arange(width))).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, parts.size + 1, tables), pa.int32()), pa.array(parts.ravel()))
            code = pa.array([row.tobytes() for row in np.packbits(signs, axis=1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "label", "dim")), listed, code], ["key", "label", "dim", "parts", "code"])

    return run


def _codes(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(rows.num_rows, -1)


def _near(num: dict[str, np.ndarray], codes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows to compare of the same bucket and pair of pieces, sorted by these, whose codes lie within the radius."""
    n = len(num["key"])
    fresh = np.ones(n, bool)
    fresh[1:] = np.any([num[c][1:] != num[c][:-1] for c in DEALT], axis=0)
    first = np.flatnonzero(fresh)
    end = np.append(first[1:], n)[np.cumsum(fresh) - 1]
    left = np.flatnonzero(end - np.arange(n) > 1)
    later = end[left] - left - 1
    total = np.cumsum(later)
    start = 0
    while start < len(left):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS, side="right")))
        count = later[start:stop]
        a = np.repeat(left[start:stop], count)
        b = a + 1 + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = stop
        good = (num["role"][a] == 0) | (num["role"][a] != num["role"][b])
        a, b = a[good], b[good]
        good = np.bitwise_count(codes[a] ^ codes[b]).sum(axis=1) <= radius
        yield a[good], b[good]


def _numeric(rows: pa.Table, *more: str) -> dict[str, np.ndarray]:
    return {c: rows.column(c).to_numpy() for c in (*DEALT, "role", "key", *more)}


def _candidates(radius: int):
    """The rows that have a candidate."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        num, has = _numeric(rows), np.zeros(rows.num_rows, bool)
        for a, b in _near(num, _codes(rows), radius):
            has[a] = has[b] = True
        at = pa.array(np.flatnonzero(has))
        return pa.RecordBatch.from_arrays([rows.column(c).combine_chunks().take(at) for c in rows.schema.names], rows.schema.names)

    return work


def _linked(cosine: float, radius: int):
    """Links among the rows: (a, b, n): key, a key linked to it, links' weight."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        num, codes = _numeric(rows, "dim", "place", "weight", "same"), _codes(rows)
        parts = rows.column("parts").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        keys, at = np.unique(num["key"], return_inverse=True)
        links, weight = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        weight[at] = num["weight"]
        a_all, b_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        vec = rows.column("vec").combine_chunks()
        units, place = {}, np.zeros(rows.num_rows, np.int64)
        for d in np.unique(num["dim"]).tolist():
            own = np.flatnonzero(num["dim"] == d)
            units[d], place[own] = _unit(vec.take(pa.array(own)), d), np.arange(len(own))
        for a, b in _near(num, codes, radius):
            good = (num["dim"][a] == num["dim"][b]) & (num["same"][a] == num["same"][b])
            a, b = a[good], b[good]
            good = (parts[a] == parts[b]).argmax(axis=1) == num["place"][a]
            a, b = a[good], b[good]
            for d, unit in units.items():
                own = num["dim"][a] == d
                x, y = a[own], b[own]
                good = np.einsum("ij,ij->i", unit[place[x]], unit[place[y]]) >= cosine
                x, y = at[x[good]], at[y[good]]
                np.add.at(links, x, weight[y])
                np.add.at(links, y, weight[x])
                a_all.append(x)
                b_all.append(y)
        root = local_roots(len(keys), np.concatenate(a_all), np.concatenate(b_all))
        has = links > 0
        return pa.RecordBatch.from_arrays([pa.array(keys[has]), pa.array(keys[root[has]]), pa.array(links[has])], ["a", "b", "n"])

    return work


def _whole(work, at_once: int):
    """``work`` on rows that come sorted by bucket and pair of pieces, never cutting these."""

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


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, sample: int = SAMPLE, piece: int = PIECE
) -> DataFrame:
    """(id, n_links, component, kept): a row for each row of ``vectors``.

    Vectors link if their labels are equal and not null, their lengths equal
    and their cosine, in double precision, is ``cosine`` or more; the search
    may miss some of these (RECALL of those at the threshold are aimed at), and
    finds none else. Null or zero vectors and those with a null, NaN or infinite
    component link with nothing. Equal vectors count one by one as links,
    repeated rows too. Rows with a null id are counted but don't stand for a
    component. Very long vectors are compared whole. Other columns aren't read.
    An empty table gives no rows. The rotations are fitted on ``sample``
    distinct vectors at most, chosen by a hash; all are coded.
    """
    spark = vectors.sparkSession
    vec = F.col(vector_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = F.col(label_col).isNotNull() & vec.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vec.alias("vec"), F.coalesce(valid, F.lit(False)).alias("valid"))
    distinct = rows.where("valid").groupBy("label", "vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("weight"))
    distinct = stored(distinct.withColumn("key", F.monotonically_increasing_id()), "vectors")

    models, width, tables, radius = _fit(distinct, sample, cosine)
    bits = -(-max(CODE, width * tables) // 64) * 64
    plain = distinct.select("key", "label", F.size("vec").alias("dim"), "vec")
    kind = T.StructType([*plain.drop("vec").schema.fields, T.StructField("parts", T.ArrayType(T.IntegerType())), T.StructField("code", T.BinaryType())])
    coded = stored(plain.mapInArrow(_coded(models, width, tables, bits), kind), "codes")
    rows_of = coded.select("key", "code", F.posexplode("parts").alias("place", "value"), "label", "dim")
    rows_of = rows_of.select(F.xxhash64("label", "dim", "place", "value").alias("bucket"), "place", "key", "code")
    large = rows_of.groupBy("bucket").count().where(F.col("count") > piece)
    large = stored(large.select("bucket", F.ceil(F.col("count") / piece).cast("int").alias("pieces")), "large")
    cut = rows_of.join(F.broadcast(large) if large.count() <= BROADCAST else large, "bucket", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("key"), F.col("pieces")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    role = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("role")
    dealt = cut.select("bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), role, "place", "key", "code")
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(shuffled, *DEALT).sortWithinPartitions(*DEALT)
    near_rows = stored(dealt.mapInArrow(_whole(_candidates(radius), 16_384), dealt.schema), "near")
    whole = distinct.select("key", "vec", "weight", F.xxhash64(F.lit(1), "label").alias("same"), F.size("vec").alias("dim"))
    near = near_rows.join(whole, "key").join(coded.select("key", "parts"), "key").repartition(shuffled, *DEALT).sortWithinPartitions(*DEALT)
    links = stored(near.mapInArrow(_whole(_linked(cosine, radius), 4096), "a long, b long, n long"), "links")

    roots = stored(components(links.select("a", "b")), "roots")
    counts = stored(links.groupBy("a").agg(F.sum("n").alias("n")), "counts")
    named = distinct.join(roots, F.col("key") == F.col("node"), "left").join(counts, F.col("key") == F.col("a"), "left")
    named = stored(named.select("label", "vec", "first", F.coalesce("root", "key").alias("root"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n")), "named")
    low = stored(named.groupBy("root").agg(F.min("first").alias("component")), "low")
    classes = stored(named.join(low, "root").select(F.col("label").alias("of_label"), F.col("vec").alias("of_vec"), "n", "component"), "classes")
    drop(distinct, coded, large, near_rows, links, roots, counts, named, low)
    found = rows.where("valid").join(classes, (F.col("label") == F.col("of_label")) & (F.col("vec") == F.col("of_vec")), "left")
    alone = rows.where("not valid").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component"))
    out = found.select("id", "n", "component").union(alone)
    return out.select("id", F.col("n").alias("n_links"), "component", F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def op3_embedding_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of all embeddings."""
    found = near_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


QUERIES = {"op3_embedding_itq": op3_embedding_itq}
ORACLE_SQL = {
    "op3_embedding_itq": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= {COSINE}),
reached AS (SELECT vec_id AS node, vec_id AS other FROM embeddings UNION SELECT node, b FROM reached JOIN links ON other = a),
grouped AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN grouped ON node = vec_id LEFT JOIN counted ON a = vec_id
"""
}
