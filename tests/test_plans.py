"""Plans keep to the JVM and bound what hot groups send."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from textloom.operators import generate, ngram, ordering, profile
from textloom.plans import jobs
from textloom.session import DROP_SHUFFLES, stored_table

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["post_clean", "news_tokens", "book_clean", "next_word_top3", "stem_freq", "sgml_records", "tfidf", "cosine_topk_many"])
def test_no_python_workers(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert "EvalPython" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan


def test_rank_bound_is_applied_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    assert plan_of(ordering.top_per_group(df, ["g"], ["id"], 3, "r")).count("WindowGroupLimit") == 2
    assert "WindowGroupLimit" in plan_of(profile.deduplicate(df, ["g"], "id"))


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(contract.queries()["equality_filter"](spark, SF_DIR).select("doc_id"))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan and "EqualTo(lang,en)" in plan


def _docs(spark):
    return spark.createDataFrame([(1, "a b. a c."), (2, "a b"), (3, None)], "doc_id bigint, text string")


def _shuffle_files(spark):
    """Of the session's local folders."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(p) for folder in folders for p in Path(str(folder)).rglob("shuffle_*.data")}


def test_stored_table_leaves_no_shuffle_files(spark):
    before, conf = _shuffle_files(spark), spark.conf.get(DROP_SHUFFLES)
    table = stored_table(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")), "test")
    assert sorted(r.n for r in table.collect()) == [142] * 1 + [143] * 6 and spark.conf.get(DROP_SHUFFLES) == conf
    deadline = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left


def test_language_models_are_files(spark):
    """No cached copy of counts or models, which keeps the shuffles that made it."""
    contexts, starts = spark.createDataFrame([("a",)], "context string"), spark.createDataFrame([(1, "a")], "walk bigint, context string")
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    result = jobs.language_model_job(_docs(spark), contexts, starts, 2)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before
    for name in ("bigram", "trigram", "bigram_laplace", "trigram_laplace"):
        assert any("/model-" in f for f in result[name].inputFiles())


def test_counts_are_stored_before_they_are_joined_or_laid_out(spark):
    counts = ngram.ngram_counts(ngram.token_rows(_docs(spark), "doc_id", "text"), 2)
    model = ngram.language_model(counts)
    assert any("/counts-" in f for f in model.inputFiles())
    assert {(r.context, r.next): (r.n, r.ctx_n) for r in model.collect()}[("a", "b")] == (2, 3)
    assert all("/spans-" in f for f in generate.draw_tables(counts)[1].inputFiles())
