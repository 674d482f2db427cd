"""Stages of the pipeline and the licence scan leave no shuffle files of finished steps on the local disks."""

import time
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from shelfsense.llm import licenses

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffles(spark):
    """Numbers of the shuffles with files below the local folders."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name.split("_")[1] for f in folders for p in Path(f.getPath()).glob("*/shuffle_*.data")}


def no_more_than(spark, before):
    until = time.time() + 20  # files are deleted beside the next step
    while shuffles(spark) - before and time.time() < until:
        time.sleep(0.2)
    return not shuffles(spark) - before


@pytest.fixture
def docs(spark):
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda x: F.concat(F.lit("w"), (x * F.col("id")) % 97)), " ")
    yield spark.range(200).select(F.col("id").alias("doc_id"), words.alias("text"))
    spark.conf.unset(SETTING)


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_lines, corpus_pipeline.drop_similar])
def test_a_stage_leaves_no_shuffles(spark, docs, stage, tmp_path):
    before = shuffles(spark)
    stage(spark, docs, "").write.parquet(str(tmp_path / "out"))
    assert no_more_than(spark, before)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_the_licence_scan_leaves_no_shuffles(spark, docs, tmp_path):
    before = shuffles(spark)
    licensed = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("\nSPDX-License-Identifier: MIT"))).otherwise(F.col("text"))
    files = docs.select(F.concat(F.lit("a/"), F.col("doc_id")).alias("path"), licensed.alias("text"))
    licenses.file_licences(files).write.parquet(str(tmp_path / "out"))
    assert no_more_than(spark, before)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200


def test_a_plan_that_runs_again_gives_the_same(spark, docs):
    counted = docs.sparkSession.range(10_000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count()
    spark.conf.set(SETTING, "true")
    first, again = (sorted(map(tuple, counted.collect())) for _ in range(2))
    assert first == again and len(first) == 7
