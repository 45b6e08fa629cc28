"""Token counts through a digest cache.

A count depends on the content and the tokenizer alone, so it is stored under
the digests of both. A run joins the digests of its texts to the cache,
encodes one text for each digest that is missing, and appends the new counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.llm.shared import drop, new_path, stored
from heddle.sources import read_table

LIMIT = 512
CACHE = "digest binary, tokenizer string, n_tokens long"
AT_ONCE = 400_000  # characters handed to the library in one call


def tokenizer_path(name: str) -> str:
    """Where this machine has a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def tokenizer_version(name: str) -> str:
    """Digest of the tokenizer's file and of the library that reads it."""
    if name.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    return hashlib.sha256(Path(tokenizer_path(name)).read_bytes() + f"{library.__name__} {library.__version__}".encode()).hexdigest()


def counter(name: str):
    """texts -> token counts, by the file's own library: no begin, end or added tokens, no truncation or padding."""
    path = tokenizer_path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return lambda texts: [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    t = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in t.encode(texts, num_threads=1)]


def _encode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        count = None
        for batch in batches:
            count = count or counter(name)
            texts, found, start = batch.column(1).to_pylist(), [], 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= AT_ONCE):
                    chars += len(texts[stop])
                    stop += 1
                found += count(texts[start:stop])
                start = stop
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["digest", "n_tokens"])

    return run


def _read_cache(spark: SparkSession, path: str) -> DataFrame:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def token_counts(docs: DataFrame, tokenizer: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit): one row for each row of ``docs``.

    ``cache_path``: a Parquet table in a shared folder that grows
    with each run; it need not exist yet. Of the cache, the digests of ``docs``
    alone are shuffled. Null texts count as empty: 0 tokens; very long
    ones are encoded whole. Equal texts are encoded once. Ids may be
    null or repeated. Other columns aren't read. An empty table gives no rows.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    seen = stored(docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("digest")), "digests")

    asked = stored(seen.select("digest").distinct(), "asked")

    def known() -> DataFrame:
        rows = _read_cache(spark, cache_path).where(F.col("tokenizer") == version).join(asked, "digest", "left_semi")
        return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    texts = docs.select(digest.alias("digest"), text.alias("t"))
    misses = stored(asked.join(known(), "digest", "left_anti"), "misses")
    if misses.count() < asked.count():
        texts = texts.join(misses, "digest", "left_semi")
    once = texts.groupBy("digest").agg(F.first("t").alias("t"))
    new = once.mapInArrow(_encode(tokenizer), "digest binary, n_tokens long")
    new.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    counts = known().withColumnRenamed("digest", "of")
    drop(misses)
    return seen.join(counts, F.col("digest") == F.col("of"), "left").select("id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op9_token_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of all documents; each call starts a cache of its own."""
    found = token_counts(read_table(spark, sf_dir, "documents"), "byte_bpe_50k.json", new_path(spark, "token-cache"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {"op9_token_digest_cache": op9_token_digest_cache}
ORACLE_SQL: dict[str, str] = {}
