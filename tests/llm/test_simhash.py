import numpy as np
import pytest
import xxhash

from heddle.llm import simhash as S
from heddle.llm.components import components, local_roots


def plain_fingerprint(text):
    import re

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots_by_pairs(fps, radius=3):
    return local_roots(len(fps), *np.array([(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius] or np.empty((0, 2)), dtype=int).reshape(-1, 2).T)


def check_against_pairs(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, fp int, component string")
    got = sorted((r.id, r.fp & (2**64 - 1), r.component) for r in S.near_duplicates(df, **kw).collect())
    fps = [plain_fingerprint(r[1]) for r in rows]
    root = roots_by_pairs(fps)
    low = {}
    for r, c in zip(rows, root):
        low[c] = min(low.get(c, r[0]), r[0])
    assert got == sorted((r[0], f, low[c]) for r, f, c in zip(rows, fps, root))


def test_fingerprint_cases():
    for t in ("", " \t\n", "A", "a B", "one two three", "Ünï çØdé ÀÉ words x y", "a a a a a a b", "x " * 3000):
        assert S.fingerprint(t.encode()) == plain_fingerprint(t)


@pytest.mark.parametrize("piece", [512, 3])
def test_components_match_all_pairs(spark, piece):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(500)]
    rows, n = [], 0
    for _ in range(20):
        base = list(rng.choice(words, 150))
        for _ in range(8):
            copy = list(base)
            for i in rng.choice(150, rng.integers(0, 4)):
                copy[i] = str(rng.choice(words))
            rows.append((n, " ".join(copy), "x", 1, None))
            n += 1
    rows += [(1000, None, None, None, None), (1001, "", "", 0, ""), (1002, "\n ", "", 0, "")]
    check_against_pairs(spark, rows, piece=piece)


def test_nulls_repeats_and_empty(spark):
    kind = "doc_id long, text string"
    rows = [(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "other words here now"), (7, None)]
    got = S.near_duplicates(spark.createDataFrame(rows, kind)).collect()
    assert sorted((str(r.id), str(r.component)) for r in got) == sorted([("None", "5"), ("5", "5"), ("5", "5"), ("None", "None"), ("7", "7")])
    assert S.near_duplicates(spark.createDataFrame([], kind)).collect() == []


def test_forest_finds_all_within_radius():
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 2**16, 300, dtype=np.uint64))
    groups = np.sort(rng.integers(0, 3, len(values)))
    forest = S.BKForest(values, groups)
    q, n = forest.search(values, np.array([forest.roots[g] for g in groups]), 3)
    want = {(i, j) for i in range(len(values)) for j in range(len(values)) if groups[i] == groups[j] and int(values[i] ^ values[j]).bit_count() <= 3}
    assert len(q) == len(want) and set(zip(q.tolist(), n.tolist())) == want


def test_links_across_batches():
    import pyarrow as pa

    rows = sorted((0, v, 0, 0, 0, v * 1000 + i) for v in range(5) for i in (0, 1, 3))
    whole = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], list("bvotrf"))
    cut = [whole.slice(i, 2) for i in range(0, 15, 2)]
    for at_once in (1, 4, 100):
        got = {tuple(r.values()) for b in S._links(cut, 3, at_once) for r in b.to_pylist()}
        assert {g[0] // 1000 for g in got} == set(range(5)) and all(g[1] % 1000 == 0 for g in got) and len(got) == 10


def test_components_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (None, 3)] + [(500, 501 + i) for i in range(50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100: 100, 150: 100, 200: 100} | {500: 500} | {501 + i: 500 for i in range(50)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query_on_all_documents(spark):
    out = S.op1_simhash_bktree(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(out) == len(docs)
    ids = sorted(docs)
    fps = [plain_fingerprint(docs[i]) for i in ids]
    root = roots_by_pairs(fps)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {i: (f"{f:016x}", ids[c]) for i, f, c in zip(ids, fps, root)}


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_links_are_the_same_by_any_number_of_blocks(spark, blocks):
    rng = np.random.default_rng(18)
    fps = {int(x) for x in rng.integers(-(2**63), 2**63, 60)}
    for x in sorted(fps):
        for _ in range(3):
            flips = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
            fps.add(int(np.uint64(x & (2**64 - 1)) ^ np.uint64(flips)) - ((1 << 64) if int(np.uint64(x & (2**64 - 1)) ^ np.uint64(flips)) >> 63 else 0))
    fps = sorted(fps)
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if ((fps[a] ^ fps[b]) & (2**64 - 1)).bit_count() <= 3]
    want = local_roots(len(fps), *np.array(pairs).T)
    links = S.near_links(spark.createDataFrame([(x,) for x in fps], "fp long"), piece=16, blocks=blocks).collect()
    at = {x: i for i, x in enumerate(fps)}
    got = local_roots(len(fps), *np.array([(at[r.a], at[r.b]) for r in links]).T)
    assert got.tolist() == want.tolist() and 100 < len(pairs)
    assert [S.blocks_for(n) for n in (0, 64 << 16, (64 << 16) + 1, 64 << 24, 10**11)] == [4, 4, 5, 5, 6]
