"""Null keys and strata, tables as folders of files, repair of text, and models that no session changes."""

import math
import shutil
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfsense.functions.text import clean_text
from shelfsense.operators import factors
from shelfsense.operators.factors import AlsSettings
from shelfsense.operators.sampling import split_stratified
from shelfsense.operators.spread import spread_join
from shelfsense.sources import session
from shelfsense.streaming.increments import absorb_new


def test_a_null_stratum_is_sampled_too(spark):
    rows = spark.range(1000).withColumn("label", F.when(F.col("id") % 2 == 0, F.lit("a")))
    marked = split_stratified(rows, ["id"], "label", 0.2).groupBy("label").agg(F.count_if("is_test").alias("n")).collect()
    assert {r["label"]: r["n"] for r in marked} == {"a": 100, None: 100}


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi", "inner"])
def test_rows_with_a_hot_null_key_are_dealt_out(spark, how):
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"), "id")
    keyed = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = spread_join(rows, keyed, ["k"], how, hot_rows=1000)
    plain = rows.join(keyed, ["k"], how)
    assert joined.columns == plain.columns
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    if how in ("left", "left_anti"):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            tasks = spread_join(rows, keyed, ["k"], how, hot_rows=1000).where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < 10_000


def test_batches_from_tables_that_are_folders(spark, folder, tmp_path):
    for name in ("orders", "customer"):
        shutil.copy(f"{folder}/{name}.parquet", tmp_path)
    spark.read.parquet(f"{folder}/lineitem.parquet").repartition(20).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = entry.queries()["incremental_totals"](spark, str(tmp_path)).collect()
    whole = duckdb.connect()
    for name in ("lineitem", "orders", "customer"):
        whole.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    expected = whole.sql(entry.oracle_sql()["incremental_totals"]).fetchall()
    assert sorted((r["user_tag"], r["item_id"], r["bottles"], r["n_rows"]) for r in got) == sorted(e[:4] for e in expected)


def test_totals_before_anything_arrives(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    stream = spark.readStream.schema("user_tag string, item_id long, units double, date date").parquet(str(source))
    assert absorb_new(stream, lambda batch: batch, str(tmp_path / "totals"), str(tmp_path / "progress")).collect() == []


def test_windows_1252_is_repaired(spark):
    texts = ["l’été à “Paris” – 5 €", "plain", "“quoted” text", "naïve", "Œuvre", "日本"]
    broken = [t.encode().decode("cp1252", "replace") for t in texts[:1]] + [texts[4].encode().decode("cp1252")]
    rows = [(bytearray(t.encode()),) for t in broken + texts]
    got = [r[0] for r in spark.createDataFrame(rows, "raw binary").select(clean_text(F.col("raw"))).collect()]
    assert got[1] == "Œuvre" and got[2:] == texts


def test_a_scope_leaves_nothing_behind(spark, folder):
    before = set(Path(session.shared_folder(spark).removeprefix("file:")).iterdir())
    with session.scratch(spark):
        got = entry.queries()["curated_scores"](spark, folder).count()
    assert got > 0
    left = set(Path(session.shared_folder(spark).removeprefix("file:")).iterdir()) - before
    assert not {p.name for p in left if not p.name.startswith(("rdd-", "."))}


def test_one_model_for_one_input(spark):
    triples = spark.range(3000).select(
        (F.col("id") % 60).cast("int").alias("user_id"), (F.col("id") * 7 % 50).cast("int").alias("item_id"), (1 + F.col("id") % 10).cast("float").alias("rating")
    ).dropDuplicates(["user_id", "item_id"])
    settings = AlsSettings(rank=4, max_iter=4)
    assert isinstance(settings.blocks, int)
    pairs = []
    for n in (2, 7):
        model = factors.fit(triples.repartition(n), settings)
        pairs.append({(r["user_id"], r["item_id"]): r["prediction"] for r in factors.predict(model, triples).collect()})
    assert all(math.isclose(pairs[0][k], pairs[1][k], abs_tol=1e-3) for k in pairs[0])
    assert Path(factors.__file__).read_text().count("defaultParallelism") == 0
