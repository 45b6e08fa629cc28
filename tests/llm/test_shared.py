import time

import pyarrow as pa

from heddle.llm.shared import BATCH, BATCH_BYTES, CLEANUP, drop, stored


def test_stored_leaves_no_shuffle_files(spark):
    def files():
        return {x for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(",").split(",") if x.startswith("shuffle_")}

    there, before = files(), spark.conf.get(CLEANUP)
    out = stored(spark.range(10_000).selectExpr("id % 100 AS k").groupBy("k").count(), "counts")
    until = time.time() + 10
    while files() - there and time.time() < until:
        time.sleep(0.1)
    assert not files() - there and out.count() == 100 and spark.conf.get(CLEANUP) == before
    drop(out)


def test_stored_bounds_batches_of_long_texts(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([len(b)])], ["size", "n"])

    before = spark.conf.get(BATCH)
    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat(cast(id AS string), 2000) AS t")
    out = stored(texts.mapInArrow(sizes, "size long, n long"), "sizes")
    found = out.collect()
    assert sum(r.n for r in found) == 3000 and max(r.size for r in found) <= 2 * BATCH_BYTES and spark.conf.get(BATCH) == before
    drop(out)
