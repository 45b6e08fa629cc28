from collections import Counter

import pytest

import corpus_pipeline as C
from heddle.llm import copies, decontaminate, lines, mixing, toxicity
from heddle.llm.components import local_roots

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in C.STAGES:
        after = C.stored(stage(spark, docs, SF), name)
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(steps):
    for before, after in steps[:-1]:
        assert after.dtypes == steps[0][0].dtypes


def test_toxicity_rejects_what_the_model_says(spark, steps):
    before, after = steps[0]
    said = toxicity.op4_toxicity_ordinal(spark, SF).collect()
    assert set(rows(after)) == {r.doc_id for r in said if not r.toxic} and any(r.toxic for r in said)


def test_lines_and_near_duplicates_are_gone(steps):
    before, after = map(rows, steps[1])
    seen = Counter(lines.normal(x) for r in after.values() for x in r.text.split("\n"))
    assert all(n == 1 for x, n in seen.items() if x)
    assert all(r.n_chars == len(r.text) for r in after.values())
    for i in set(before) - set(after):  # each of its lines is kept elsewhere, or one of its group, by links of similarity 0.8
        for x in filter(None, map(lines.normal, before[i].text.split("\n"))):
            assert x in seen or any(lines.similar(x, y, 0.6) for y in seen if y)
    before, after = map(rows, steps[2])
    ids = sorted(before)
    sets = [copies.shingles(before[i].text) for i in ids]
    pairs = [(a, b) for a in range(len(ids)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    import numpy as np

    root = local_roots(len(ids), *np.array(pairs or np.empty((0, 2)), dtype=int).reshape(-1, 2).T)
    assert set(after) == {ids[r] for r in root}


def test_leaks_are_gone(spark, steps):
    before, after = map(rows, steps[3])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    index = decontaminate.Index(items)
    hit = {i for i, r in before.items() if any(not x[-1] for x in index.leaks([decontaminate.words_of(r.text)]))}
    assert set(after) == set(before) - hit


def test_mix_meets_targets(steps):
    before, after = map(rows, steps[4])
    taken = Counter()
    for r in after.values():
        assert 0 < r.taken <= 2 * r.size
        taken[r.source] += r.taken
    size = Counter()
    for r in before.values():
        size[r.source] += len(r.text.split())
    for s, t in mixing.weighted_quotas(size).items():
        assert abs(taken[s] - t) <= 1


def test_odd_rows_pass_every_stage(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, row string, taken string, id string, text_hash string, _hash string, _id string, lines string, of string, removed string"
    odd = [(None, None, None, None, None, "a", "b"), (1, "", "en", "s", 0, None, None), (2, "same words here again", "en", None, 21, "", ""), (2, "same words here again", "en", None, 21, "", ""), (3, "word " * 20000, "en", "s", 100000, "", "")]
    odd = [(*r, "c", None, "d", "", "e", "f", "g") for r in odd]
    for n in (len(odd), 0):
        docs = spark.createDataFrame(odd[:n], kind)
        for name, stage in C.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns, name
            docs = C.stored(after, name)
        assert (sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2", "3", "None"][: 4 if n else 0]) or n
        mixed = C.STAGES[-1][1](spark, docs, SF)
        assert mixed.columns == [c for c in docs.columns if c != "taken"] + ["size", "source_size", "target", "taken"]
        mixed.collect()
