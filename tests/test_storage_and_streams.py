"""Readers, writers, the shared folder and growing totals."""

import pytest
from pyspark.sql import functions as F

from shelfsense.operators.profile import impute_by_similar
from shelfsense.sources import session, tables
from shelfsense.streaming.increments import absorb_new, batch_totals


def test_film_tables_keep_quoted_titles(spark, tmp_path):
    (tmp_path / "titles.csv").write_text('movieId,title,genres\n1,"Thing, The ""Big"" (1982)",a|b\n2,Plain,c\n')
    titles = tables.read_csv_columns(spark, str(tmp_path / "titles.csv"), tables.FILM_TITLES, ["movieId", "title"])
    assert [tuple(r) for r in titles.orderBy("movieId").collect()] == [(1, 'Thing, The "Big" (1982)'), (2, "Plain")]


def test_tab_separated_purchases(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("CustomerHash\tProductKey\tUnits\tDate\nab\t7\t2.5\t2014-12-31\n")
    row = tables.read_tsv(spark, str(tmp_path / "p.tsv"), tables.PURCHASES).first()
    assert (row.CustomerHash, row.ProductKey, row.Units, str(row.Date)) == ("ab", 7, 2.5, "2014-12-31")


def test_tables_are_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 10).withColumn("half", F.col("id") % 2).withColumn("x", F.col("id") * 0.5)
    tables.write_table(df, path, ["half"])
    tables.write_table(df.where("id < 4"), path, ["half"])
    back = tables.read_table(spark, path, ["x"])
    assert back.columns == ["x"] and back.count() == 4
    assert tables.read_run(spark, path, half=1).count() == 2


def test_matrix_table_fills_gaps(spark):
    cells = spark.createDataFrame([("u", "a", 2.0), ("v", "b", 3.0), ("v", "zz", 9.0)], "r string, c string, x double")
    wide = tables.matrix_table(cells, "r", "c", "x", ["a", "b"])
    assert sorted(map(tuple, wide.collect())) == [("u", 2.0, 0.0), ("v", 0.0, 3.0)]


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.shared_folder(Session())


def test_totals_grow_by_batches_and_replays_do_not_count_twice(spark, tmp_path):
    schema = "user_tag string, item_id long, units double, date date"
    source, totals, progress = (str(tmp_path / n) for n in ("in", "totals", "progress"))

    def arrive(*lines):
        spark.createDataFrame(lines, "user_tag string, item_id long, units double, date string").withColumn(
            "date", F.col("date").cast("date")
        ).write.mode("append").parquet(source)

    def absorb():
        stream = spark.readStream.schema(schema).parquet(source)
        return absorb_new(stream, lambda batch: batch, totals, progress)

    arrive(("a", 1, 2.0, "2020-01-02"), ("a", 1, 1.0, "2020-01-01"))
    assert [(r.user_tag, r.bottles, r.n_rows) for r in absorb().collect()] == [("a", 3.0, 2)]
    arrive(("a", 1, 4.0, "2020-03-01"), ("b", 2, 1.0, "2020-01-01"))
    assert sorted((r.user_tag, r.bottles, r.n_rows, str(r.last_date)) for r in absorb().collect()) == [
        ("a", 7.0, 3, "2020-03-01"), ("b", 1.0, 1, "2020-01-01")
    ]
    whole = batch_totals(spark.read.parquet(source))
    assert sorted(map(tuple, absorb().collect())) == sorted(map(tuple, whole.collect()))
    # the folder of a batch is overwritten when the batch is run again
    replay = spark.read.parquet(f"{totals}/batch=0")
    replay.persist().count()
    replay.write.mode("overwrite").parquet(f"{totals}/batch=0")
    assert sorted(map(tuple, absorb().collect())) == sorted(map(tuple, whole.collect()))


def test_imputation_takes_the_most_frequent_value_of_similar_rows(spark):
    df = spark.createDataFrame([(1, "r", "x"), (2, "r", "x"), (3, "r", "y"), (4, "r", None), (5, "q", None)], "id int, region string, style string")
    got = {r.id: r.style for r in impute_by_similar(df, "style", ["region"]).collect()}
    assert got == {1: "x", 2: "x", 3: "y", 4: "x", 5: None}
