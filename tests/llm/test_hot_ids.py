"""A third of the rows without an id or with one id; columns with odd names."""

import statistics

import public_tokenizers
import pytest
from fixtures import odd_documents, rows
from pyspark.sql import functions as F

from moodstream.llm import exact_dedup, quality, token_store

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _hot(hot, n=900):
    return [(hot if i % 3 == 0 else i, f"text {i // 6} of pairs") for i in range(n)]


@pytest.mark.parametrize("hot", [None, 7])
def test_exact_copies_do_not_meet_by_id(spark, hot):
    data = _hot(hot)
    got = exact_dedup.exact_dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    assert "_id" not in [w for line in got._jdf.queryExecution().toString().split("\n") if "Join" in line for w in line.replace("#", " ").split()]
    want = sorted((i, min(x for x, u in data if u == t and x is not None), sum(u == t for _, u in data)) for i, t in data if i is not None)
    assert sorted(r[:3] for r in rows(got) if r[0] is not None) == want and got.count() == len(data)


@pytest.mark.parametrize("hot", [None, 7])
def test_store_deals_rows_of_one_id_to_several_shards(spark, hot, tmp_path):
    data, folder = [(hot if i % 3 == 0 else i + 10, f"text {i}") for i in range(3000)], str(tmp_path / "store")
    token_store.write_store(spark.createDataFrame(data, "doc_id long, text string").repartition(3), folder, PATH)
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = [r["n"] for r in blocks.groupBy("shard").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 2 * statistics.median(sizes)
    got = [r["doc_id"] for r in token_store.read_digests(spark, folder).orderBy("start").collect()]
    assert got == sorted((i for i, _ in data), key=lambda i: (i is not None, i))


def test_fetch_skips_blocks_by_their_range_of_ids(spark, tmp_path):
    folder = str(tmp_path / "store")
    token_store.write_store(spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")), folder, PATH)
    found = token_store.fetch(spark, folder, [5, 2999, 4000])
    assert sorted(r["doc_id"] for r in found.collect()) == [5, 2999]
    assert "LessThanOrEqual(first_id,5)" in found._jdf.queryExecution().toString().replace("\n", "")
    read = spark.read.parquet(f"{folder}/blocks")
    assert read.where("first_id <= 5 AND last_id >= 5").count() == 1 and read.count() > 4


def test_quality_keeps_columns_of_any_name(spark):
    docs = odd_documents(spark).withColumnsRenamed({"fp": "my col", "score": "n-chars", "_hash": "input_ids"})
    docs = docs.withColumn("a.b", F.struct(F.lit(1).alias("x y")))
    kept = quality.accepted(docs, quality._constant(0.9))
    assert kept.dtypes == docs.dtypes and kept.count() == docs.count()
