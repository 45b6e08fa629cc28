import math
from collections import Counter

import numpy as np
import pytest

from heddle.llm import ngrams as N

KIND = "doc_id long, text string, block string, id string"


def brute(texts):
    docs = [(t or "").encode().lower().split() for t in texts]
    count = lambda w: Counter(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total, words = Counter(), sum(map(len, docs))
    for w in docs:
        total.update(count(w))
    out = []
    for w in docs:
        own, s, used = count(w), 0.0, [0, 0, 0]
        c = lambda g: total[g] - own[g]  # noqa: E731, B023
        for i in range(len(w)):
            for n in (3, 2, 1):
                g = tuple(w[i - n + 1 : i + 1]) if i >= n - 1 else None
                if g and c(g) > 0:
                    below = c(g[:-1]) if n > 1 else words - len(w)
                    s += math.log(c(g) / below * 0.4 ** (min(i, 2) + 1 - n))
                    used[3 - n] += 1
                    break
            else:
                s += math.log(0.4 ** min(i, 2) / (words - len(w) + 1))
        out.append((len(w), pytest.approx(s), *used))
    return out


@pytest.mark.parametrize("block_bytes", [10**7, 300])
def test_scores_match_brute_force(spark, block_bytes):
    rng = np.random.default_rng(11)
    texts = [" ".join(f"W{x}" for x in rng.integers(0, 12, rng.integers(0, 40))) for _ in range(60)] + [None, "", " \n", "lone", "é ü é ü é", "w1 w1 w1 w1 w1", "x " * 3000]
    rows = [(i, t, "a", None) for i, t in enumerate(texts)] + [(None, texts[0], "", ""), (3, texts[3], "", "")]
    want = brute([r[1] for r in rows])
    got = N.scores(spark.createDataFrame(rows, KIND), block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r, w in zip(rows, want):
        by_id.setdefault(r[0], w)
    for r in got:
        assert tuple(r)[1:] == by_id[r.id], r


def test_empty(spark):
    assert N.scores(spark.createDataFrame([], KIND)).collect() == []
    assert [tuple(r) for r in N.scores(spark.createDataFrame([(1, None, "", "")], KIND)).collect()] == [(1, 0, 0.0, 0, 0, 0)]


def test_packing():
    v = np.array([0, 1, 255, 256, 2**63, 2**64 - 1], np.uint64)
    assert (N._unpack(N._pack(v), len(v)) == v).all()


def test_texts_are_dealt_once(spark):
    df = N.op6_stupid_backoff(spark, "/root/testdata/sf0.001")
    out = df.collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = dict(zip([i for i, _ in docs], brute([t for _, t in docs])))
    for r in out:
        n, s, *used = want[r.doc_id]
        assert (r.n_words, r.n_trigram, r.n_bigram, r.n_unigram) == (n, *used) and r.mean_log_prob * n == pytest.approx(s.expected, rel=1e-4)
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
