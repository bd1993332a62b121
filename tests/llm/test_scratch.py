"""Scratch tables belong to the operator that made them; broadcasts go by the size of files."""

import random

import corpus_pipeline
import pytest
from siltstone.llm import common, quality


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(1)
    prose = lambda n: " ".join(f"w{rng.randrange(400)}x" for _ in range(n))
    rows = [(i, prose(90), "en", "s", 0) for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_results_survive_other_runs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = quality.quality_rules(docs, ["doc_id"])
    one = corpus_pipeline.run(spark, folder)
    two = corpus_pipeline.run(spark, folder)
    assert judged.count() == 12
    assert sorted(one.collect(), key=repr) == sorted(two.collect(), key=repr) and one.count() >= 12


def test_an_operator_deletes_what_its_result_does_not_read(spark):
    made = []

    @common.tidy
    def inner():
        a, b = common.materialize(spark.range(5).toDF("x"), "t"), common.materialize(spark.range(3).toDF("x"), "t")
        made.extend([a, b])
        return a.where("x > 1")

    @common.tidy
    def outer(use):
        out = inner()
        return out if use else spark.range(1)

    kept = outer(True)
    assert kept.count() == 3 and common.reads(kept)
    files, path = common._file_system(spark, made[1]._siltstone_path)
    assert not files.exists(path)
    outer(False)
    files, path = common._file_system(spark, made[2]._siltstone_path)
    assert not files.exists(path)


def test_broadcast_by_size_of_files(spark):
    table = common.materialize(spark.range(1000).toDF("x"), "t")
    hinted = lambda df: "hint" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(common.broadcast_if_small(table.select("x"))) and not hinted(common.broadcast_if_small(table, 10))
    assert not hinted(common.broadcast_if_small(spark.range(3)))
