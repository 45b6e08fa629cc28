"""Toxicity by cumulative-link ordinal regression.

P(grade > k) = logistic(w . x - theta_k): one weight vector for all thresholds,
which rise with k. x says which of the selected features a text holds, each
once; a feature is a word or a beginning of words, as one insult may come with
many endings, held once, twice or four times. Features are selected on the labelled sample by how far their
documents' mean grade lies from the others', then all weights and thresholds
are fitted by Newton's method with a ridge penalty. A text's severity is its
expected grade.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.llm.shared import drop, stored
from heddle.llm.words import words_of
from heddle.sources import read_table

SAMPLE = 8_000  # labelled documents that the model is fitted on, at most
MIN_DOCS = 5  # of the sample that hold a feature
MIN_Z = 4.0
FEATURES = 800  # with the largest z
BEGINNINGS = (3, 4, 5, 6, 7)  # characters
TIMES = (1, 2, 4)
RIDGE = 0.5
REJECT = 0.5  # probability of any grade over 0
HASH_BITS = 26
AT_ONCE = 1 << 22  # bytes of text scored together
KNOWN = 500_000  # words whose stems are remembered


def stems_of(word: bytes) -> list[int]:
    """Numbers of a word and of its beginnings."""
    text = word.decode("utf-8", "replace")
    return [xxhash.xxh32_intdigest(x) >> (32 - HASH_BITS) for x in (word, *(f"{text[:n]}-" for n in BEGINNINGS if len(text) > n))]


def features_of(text: str | None, stems) -> list[int]:
    """Feature numbers of a text: each stem's, for each of TIMES that it is held. ``stems``: the stems of a word."""
    held: dict[int, int] = {}
    for word, n in Counter(words_of(text)).items():
        for stem in stems(word):
            held[stem] = held.get(stem, 0) + n
    return [len(TIMES) * stem + level for stem, n in held.items() for level, least in enumerate(TIMES) if n >= least]


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class CumulativeLink:
    """Weights of columns, and thresholds between the sorted ``grades``."""

    def __init__(self, grades: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> CumulativeLink:
        """``x`` n x d, ``y`` the grades; one grade alone gives no threshold."""
        grades, k = np.unique(y, return_inverse=True)
        n, d = x.shape
        cuts = len(grades) - 1
        if cuts < 1:
            return cls(grades, np.zeros(d), np.zeros(0))
        share = np.cumsum(np.bincount(k))[:-1] / n
        p = np.concatenate([np.zeros(d), np.log(share / (1 - share))])

        def parts(p):
            s = x @ p[:d]
            edge = np.concatenate([[-np.inf], p[d:], [np.inf]])
            upper, lower = logistic(edge[k + 1] - s), logistic(edge[k] - s)
            return upper, lower, np.maximum(upper - lower, 1e-300)

        def loss(p):
            if (np.diff(p[d:]) <= 0).any():
                return np.inf
            return -np.log(parts(p)[2]).sum() + 0.5 * ridge * (p[:d] @ p[:d])

        now = loss(p)
        for _ in range(rounds):
            upper, lower, prob = parts(p)
            fu, fl = upper * (1 - upper), lower * (1 - lower)
            du, dl = fu / prob, -fl / prob  # slopes of log P by the upper and the lower edge
            huu = fu * (1 - 2 * upper) / prob - du * du
            hll = -fl * (1 - 2 * lower) / prob - dl * dl
            hul = -du * dl
            grad = np.concatenate([x.T @ (du + dl) + ridge * p[:d], np.zeros(cuts)])
            hess = np.zeros((d + cuts, d + cuts))
            hess[:d, :d] = -(x.T * (huu + hll + 2 * hul)) @ x
            hess[np.arange(d), np.arange(d)] += ridge
            for j in range(cuts):
                up, down = (k == j).astype(float), (k == j + 1).astype(float)
                grad[d + j] = -(du @ up + dl @ down)
                cross = x.T @ ((huu + hul) * up + (hll + hul) * down)
                hess[d + j, :d] = hess[:d, d + j] = cross
                hess[d + j, d + j] = -(huu @ up + hll @ down)
                if j + 1 < cuts:  # grade j + 1 has cut j below it and cut j + 1 above
                    hess[d + j, d + j + 1] = hess[d + j + 1, d + j] = -(hul @ down)
            hess[np.arange(d, d + cuts), np.arange(d, d + cuts)] += 1e-9
            step = np.linalg.solve(hess, grad)
            size = 1.0
            while size > 1e-8 and not (after := loss(p - size * step)) <= now:
                size /= 2
            if size <= 1e-8:
                break
            p, gain, now = p - size * step, now - after, after
            if gain < 1e-7 * (1 + abs(now)):
                break
        return cls(grades, p[:d], p[d:])

    def above(self, s: np.ndarray) -> np.ndarray:
        """P(grade > the k-th) for scores ``s``: a column for each threshold."""
        return logistic(np.asarray(s, float)[:, None] - self.thresholds)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.array(features_of(t.as_py(), stems_of), np.int32) for t in batch.column(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.int32()))], ["id", "h", "grade", "words"])


def train(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", sample: int = SAMPLE) -> tuple[dict[int, float], CumulativeLink]:
    """Weights by feature number, and the model. At most ``sample`` labels are used, taken by a hash of their id; null ids or grades aren't.

    Of rows that repeat a labelled id one counts, that with the least text hash.
    Features are counted in Spark; the driver gets the selected ones alone, at
    most FEATURES for each label used.
    """
    picked = grades.select(F.col(id_col).cast("long").alias("of"), F.col(grade_col).cast("int").alias("grade")).where("of is not null and grade is not null").distinct()
    picked = picked.orderBy(F.xxhash64("of"), "of", "grade").limit(sample)  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.struct(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t")).alias("x")).join(F.broadcast(picked), F.col("id") == F.col("of"))
    rows = rows.groupBy("id", "grade").agg(F.min("x.h").alias("h"), F.min_by("x.t", "x.h").alias("t"))
    table = stored(rows.select("id", "h", "grade", "t").mapInArrow(_features, "id long, h long, grade int, words array<int>"), "features")
    n, total, squares, low, high = table.select(F.count(F.lit(1)), F.sum("grade"), F.sum(F.col("grade") * F.col("grade")), F.min("grade"), F.max("grade")).first()
    best: list[int] = []
    if n and low < high:
        mean = total / n
        var = squares / n - mean * mean
        seen = table.select("grade", F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.sum("grade").alias("s")).where(F.col("n") >= MIN_DOCS)
        z = F.abs((F.col("s") - F.col("n") * mean) / F.sqrt(F.col("n") * var * F.greatest(1 - F.col("n") / n, F.lit(1e-9))))
        best = sorted(r.w for r in seen.withColumn("z", z).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "w").limit(FEATURES).collect())
    chosen = F.array(*map(F.lit, best)).cast("array<int>")
    held = sorted((r.id, r.h, r.grade, r.words) for r in table.select("id", "h", "grade", F.array_intersect("words", chosen).alias("words")).collect())
    drop(table)
    x, y = np.zeros((len(held), len(best))), np.array([r[2] for r in held], np.int64)
    for row, (*_, words) in enumerate(held):
        x[row, np.searchsorted(best, words)] = 1
    model = CumulativeLink.fit(x, y)
    return dict(zip(best, model.weights.tolist())), model


def _score(weights: dict[int, float], model: CumulativeLink, place: int | None = None):
    """``place``: where in the struct ``row`` the text is; None: in the column t."""
    grades = model.grades.astype(float)
    stems_used = np.array(sorted({n // len(TIMES) for n in weights}), np.int64)
    by_level = np.array([[weights.get(int(s) * len(TIMES) + k, 0.0) for k in range(len(TIMES))] for s in stems_used]).reshape(-1, len(TIMES))
    used = {int(s): i for i, s in enumerate(stems_used)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}  # number of a word's stems that have a weight; 0: it has none
        lists: list[list[int]] = [[]]

        def sums(texts: Iterable[str | None], n: int) -> np.ndarray:
            """Scores of texts: a product of the sparse rows of stems held with their weights."""
            doc, word = [], []
            for k, text in enumerate(texts):
                words = words_of(text)
                for w in set(words).difference(known):
                    own = sorted({used[x] for x in stems_of(w) if x in used})
                    known[w] = len(lists) if own else 0
                    if own:
                        lists.append(own)
                at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                at = at[at > 0]
                doc.append(np.full(len(at), k))
                word.append(at)
            docs, words_at = np.concatenate(doc), np.concatenate(word)
            size = np.array([len(x) for x in lists])
            flat, start = np.array([i for x in lists for i in x], np.int64), np.cumsum(size) - size
            times = size[words_at]
            stem = flat[np.repeat(start[words_at], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
            cell, held = np.unique(np.repeat(docs, times) * max(1, len(used)) + stem, return_counts=True)
            row, stem = np.divmod(cell, max(1, len(used)))
            value = np.where(held[:, None] >= TIMES, by_level[stem], 0.0) if len(cell) else np.zeros((0, len(TIMES)))
            return np.bincount(np.repeat(row, len(TIMES)), weights=value.ravel(), minlength=n)

        for batch in batches:
            start = 0
            texts = batch.column("t") if place is None else batch.column("row").field(place)
            for stop in _cuts(texts):
                if len(known) > KNOWN:
                    known.clear()
                    lists[1:] = []
                part = batch.slice(start, stop - start)
                scores = sums((t.as_py() for t in texts.slice(start, len(part))), len(part))
                start = stop
                above = model.above(scores)
                low = grades[0] if len(grades) else 0.0
                severity = low + above @ np.diff(grades) if len(grades) > 1 else np.full(len(scores), low)
                over = np.full(len(scores), float(low > 0))  # P(grade > 0)
                if low <= 0 and len(grades) > 1:
                    over = above[:, int(np.searchsorted(grades, 0, side="right")) - 1]
                names = [n for n in part.schema.names if n != "t"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(severity), pa.array(over)], [*names, "severity", "p_toxic"])

    return run


def _cuts(texts: pa.Array) -> Iterator[int]:
    """Ends of runs of texts of some AT_ONCE bytes."""
    held = 0
    for n, size in enumerate(pc.binary_length(texts).fill_null(0).to_pylist(), 1):
        held += size
        if held >= AT_ONCE or n == len(texts):
            yield n
            held = 0


def severity(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", sample: int = SAMPLE, carry: bool = False) -> DataFrame:
    """(id, text_hash, severity double, p_toxic double): a row for each row of ``docs``, with ``carry`` as struct ``row`` beside it.

    ``grades``: a row for each label, integer grades, 0 is clean; a document
    with several labels counts with each. Very long texts count whole. severity is the expected grade,
    p_toxic the probability of a grade over 0. Null and empty texts have no
    words and get the base rate. Without any label, or with one grade alone,
    that grade (0 without any) is every text's severity. Repeated rows repeat.
    Other columns aren't read. An empty table gives no rows.
    """
    weights, model = train(docs, grades, id_col, text_col, grade_col, sample)
    text = F.col(text_col)
    # a carried row has its text: it goes to Python once
    own = F.struct(*(docs[c] for c in docs.columns)).alias("row") if carry else text.alias("t")
    place = [c.lower() for c in docs.columns].index(text_col.lower()) if carry else None
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), own)
    kept = [f for f in rows.schema.fields if f.name != "t"]
    kind = T.StructType([*kept, T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType())])
    return rows.mapInArrow(_score(weights, model, place), kind)


def graded(labels: DataFrame) -> DataFrame:
    """The labels' toxic column holds the severity grades; ``labels`` of this corpus know two."""
    return labels.select("doc_id", F.col("toxic").alias("grade"))


def op4_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, severity, p_toxic, toxic of all documents."""
    found = severity(read_table(spark, sf_dir, "documents"), graded(read_table(spark, sf_dir, "labels")))
    return found.select(F.col("id").alias("doc_id"), F.round("severity", 6).alias("severity"), F.round("p_toxic", 6).alias("p_toxic"), (F.col("p_toxic") >= REJECT).alias("toxic"))


QUERIES = {"op4_toxicity_ordinal": op4_toxicity_ordinal}
ORACLE_SQL: dict[str, str] = {}
