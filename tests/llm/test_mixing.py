import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from heddle.llm import mixing as M

KIND = "doc_id long, text string, source string, size string, pattern string, taken string"


def mixed(spark, rows, sources=None, **kw):
    df = spark.createDataFrame([(i, t, s, "x", None, "y") for i, t, s in rows], KIND)
    out, table = M.mix(df, F.array("source") if sources is None else sources, **kw)
    return out.collect(), {r.source: r for r in table.collect()}


def test_targets_reshare_and_stop():
    assert M.source_targets([100, 100, 100], [5, 2, 1]) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert M.source_targets([], []) == [] and M.source_targets([0, 0], [5, 2]) == [0.0, 0.0]
    sizes = [10, 1000, 3, 0, 77]
    got = M.source_targets(sizes, [5, 2, 1, 5, 2])
    assert sum(got) == pytest.approx(1.5 * sum(sizes)) and all(t <= 2 * n for t, n in zip(got, sizes))


def cost(patterns, quotas, rounds=2):
    """Least repeats among the assignments that meet the quotas best, by trying all."""
    best = None
    choices = [[(p, s) for s in quotas if s in members] for p, (members, n) in enumerate(patterns)]
    units = [p for p, (_, n) in enumerate(patterns) for _ in range(n * rounds)]
    for pick in itertools.product(*[[None, *(s for _, s in choices[p])] for p in units]):
        used, got = Counter(), Counter()
        for p, s in zip(units, pick):
            if s is not None:
                used[p] += 1
                got[s] += 1
        if any(got[s] > quotas[s] for s in quotas):
            continue
        key = (-sum(got.values()), sum(max(0, used[p] - n) for p, (_, n) in enumerate(patterns)))
        best = key if best is None else min(best, key)
    return best


@pytest.mark.parametrize("patterns,quotas", [
    ([(["a"], 1), (["a", "b"], 2), (["b"], 1)], {"a": 3, "b": 2}),
    ([(["a", "b"], 2), (["b", "c"], 1), (["c"], 1)], {"a": 1, "b": 3, "c": 2}),
    ([(["a"], 2), ([], 2)], {"a": 4}),
])
def test_flow_is_cheapest(patterns, quotas):
    routed = M.route(patterns, quotas)
    for (members, n), f in zip(patterns, routed):
        assert sum(f.values()) <= 2 * n and set(f) <= set(members)
    total = sum(sum(f.values()) for f in routed)
    repeats = sum(max(0, sum(f.values()) - n) for (_, n), f in zip(patterns, routed))
    assert (-total, repeats) == cost(patterns, quotas)


def test_takes_meet_targets(spark):
    rows = [(i, "w " * (i * 37 % 91), "abc"[i % 3] if i % 7 else None) for i in range(300)] + [(None, "one two", "a"), (5, "w " * 3, "a"), (5, "w " * 3, "a"), (9, None, "b"), (10, "", "c"), (11, "x y z", "é")]
    out, table = mixed(spark, rows)
    assert len(out) == len(rows)
    got, size = Counter(), Counter()
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        got[r.pattern] += r.taken
        size[r.pattern] += r.size
    assert set(table) == {"a", "b", "c", "é", None}
    for t in table.values():
        assert abs(got[t.pattern_of_one] - t.target) <= 1 and size[t.pattern_of_one] == t.source_size and got[t.pattern_of_one] == t.taken
    assert sum(t.target for t in table.values()) == pytest.approx(1.5 * sum(size.values()))
    assert sorted(map(str, out)) == sorted(map(str, mixed(spark, rows[::-1])[0]))


def test_order_is_by_seeded_hash(spark):
    rows = [(i, "w " * 10, "a") for i in range(50)]
    fixed = lambda sizes: {"a": 123.0}
    one, two = (mixed(spark, rows, targets=fixed, seed=s)[0] for s in (1, 2))
    for out in (one, two):
        assert Counter(r.taken for r in out) == {0: 37, 10: 12, 3: 1}
    assert {r.id for r in one if r.taken} != {r.id for r in two if r.taken}


def test_overlapping_sources(spark):
    rows = [(i, "w w", "a b" if i % 2 else "b") for i in range(40)] + [(99, "w", None)]
    out, table = mixed(spark, rows, sources=F.split("source", " "), targets=lambda sizes: {"a": 30.0, "b": 50.0})
    got = Counter()
    for r in out:
        got[r.pattern] += r.taken
    assert sum(got.values()) == 80 and got["[]"] == 0 and got['["b"]'] <= 40 + 40 and table["a"].taken == 30 and table["b"].taken == 50


def test_odd_sources_long_texts_and_many_equal_rows(spark):
    rows = [(1, "w " * 200_000, "x\x1by"), (2, "a b", 'quo"te'), (3, "", "a/b")] + [(None, "same three words", "é\u2028")] * 500
    out, table = mixed(spark, rows)
    assert set(table) == {"x\x1by", 'quo"te', "a/b", "é\u2028"} and len(out) == len(rows)
    got = Counter()
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        got[r.pattern] += r.taken
    assert {r.size for r in out} == {200_000, 2, 0, 3}
    for t in table.values():
        assert t.pattern_of_one in got and t.target - got[t.pattern_of_one] < 500 and got[t.pattern_of_one] <= t.target + 1


def test_empty(spark):
    assert mixed(spark, []) == ([], {})


def test_query(spark):
    out = M.op2_mixing_flow(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    size, taken, target = Counter(), Counter(), {}
    for r in out:
        assert r["size"] == len(re.findall(M.WORD, docs[r.doc_id].text))
        size[docs[r.doc_id].source] += r["size"]
        taken[docs[r.doc_id].source] += r.taken
        target[docs[r.doc_id].source] = (r.source_size, r.target)
    assert len(out) == len(docs)
    want = M.weighted_quotas(size)
    for s in size:
        assert target[s] == (size[s], pytest.approx(want[s])) and abs(taken[s] - want[s]) <= 1
