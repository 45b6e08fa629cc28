import numpy as np

import corpus_pipeline as C
from heddle.llm import copies
from heddle.llm.components import local_roots

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def test_stage_equals_brute_force_jaccard(spark):
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(30):
        base = rng.choice(words, rng.integers(3, 250)).tolist()
        for _ in range(4):
            w = list(base)
            for _ in range(rng.integers(0, 6)):
                w[rng.integers(len(w))] = "Edited"
            rows.append((len(rows), " ".join(w)))
    rows += [(900, ""), (901, None), (902, " \n")]
    sets = [copies.shingles(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if not (sets[a] | sets[b]) or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = local_roots(len(rows), *np.array(pairs).T)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], KIND)
    got = {r.doc_id for r in C.near_dedup(spark, docs, "").collect()}
    assert got == {rows[r][0] for r in root} and 30 < len(got) < 110
