"""A Python worker that waits for its next task holds no memory of the last one."""

import os

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from lodestrata.llm import packing


def held(spark):
    """MB of each worker that waits."""

    def rows(batches):
        mb = int(open("/proc/self/status").read().split("RssAnon:")[1].split()[0]) / 1024
        yield from (pa.RecordBatch.from_pydict({"pid": [os.getpid()], "mb": [mb]}) for _ in batches)

    return {r.pid: r.mb for r in spark.range(0, 8, 1, 8).mapInArrow(rows, "pid long, mb double").collect()}


def test_tokenizing_leaves_no_memory_behind(spark):
    path = str(public_tokenizers.path("word_bpe_49k.json"))

    def tokenized(docs, words):
        word = lambda k: F.translate(F.hex(F.xxhash64(F.pmod(F.xxhash64("id", k), F.lit(60_000)))), "0123456789", "ghijklmnop")
        texts = spark.range(0, docs, 1, 4).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(words)), word), " ").alias("text"))
        return packing.tokenize(texts, path).agg(F.sum("length")).first()[0]

    tokenized(4, 1)
    before = held(spark)
    assert tokenized(4000, 500) > 4000 * 500
    after = held(spark)
    assert before.keys() & after.keys()
    assert max(after[k] - before[k] for k in before.keys() & after.keys()) < 60
