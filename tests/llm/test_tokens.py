import pytest
from tokenizers import Tokenizer

from heddle.llm import tokens as T
from heddle.llm.shared import new_path

KIND = "doc_id long, text string, digest string, n_tokens int"
NAME = "byte_bpe_50k.json"


def expected(text):
    return len(Tokenizer.from_file(T.tokenizer_path(NAME)).encode(text or "", add_special_tokens=False).ids)


def test_counts_cases_and_cache(spark):
    texts = [None, "", "a", "Hello <|endoftext|> world", "ünï 漢字 \U0001f600\n\n  x", "word " * 5000, "x" * 20000, "a", "a"]
    rows = [(i if i != 8 else None, t, "z", None) for i, t in enumerate(texts)] + [(2, "a", "q", 1)]
    df = spark.createDataFrame(rows, KIND)
    path = new_path(spark, "cache")
    got = T.token_counts(df, NAME, path).collect()
    want = sorted(((r[0], len((r[1] or "").encode()), expected(r[1]), expected(r[1]) > 512) for r in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert spark.read.parquet(path).count() == len({t or "" for t in texts})


def test_only_misses_are_encoded_and_versions_stay_apart(spark):
    path = new_path(spark, "cache")
    df = lambda *t: spark.createDataFrame([(i, x, "", 0) for i, x in enumerate(t)], KIND)
    T.token_counts(df("one", "two"), NAME, path)
    (spark.read.parquet(path).selectExpr("digest", "tokenizer", "n_tokens + 100 as n_tokens").write.mode("append").parquet(path))
    got = {r.id: r.n_tokens for r in T.token_counts(df("one", "three"), NAME, path).collect()}
    assert got == {0: expected("one") + 100, 1: expected("three")}
    assert spark.read.parquet(path).count() == 5
    other = T.token_counts(df("one"), "piece_bpe_32k.model", path).collect()
    assert other[0].n_tokens < 100 and spark.read.parquet(path).count() == 6


def test_empty(spark):
    path = new_path(spark, "cache")
    for _ in range(2):
        assert T.token_counts(spark.createDataFrame([], KIND), NAME, path).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    t = Tokenizer.from_file(T.tokenizer_path(NAME))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in T.op9_token_digest_cache(spark, f"/root/testdata/{sf}").collect()}
    for i, text in docs.items():
        n = len(t.encode(text, add_special_tokens=False).ids)
        assert got[i] == (len(text.encode()), n, n > 512)
