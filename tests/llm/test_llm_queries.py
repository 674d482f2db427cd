"""The registered queries against their SQL, and the pipeline's stages one after the other."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from shelfsense.llm.queries import ORACLE_SQL, QUERIES
from shelfsense.sources.session import stored


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def bag(df):
    df = df[sorted(df.columns)]
    return sorted(tuple("null" if pd.isna(v) else str(int(v) if isinstance(v, float) else v) for v in row) for row in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_its_sql(spark, folder, duck, name):
    got, expected = QUERIES[name](spark, folder).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert bag(got) == bag(expected)


@pytest.mark.parametrize("name", ["op8_license_scan", "op10_substring_dedup"])
def test_one_row_per_document(spark, folder, name):
    rows = QUERIES[name](spark, folder)
    assert rows.count() == rows.select("doc_id").distinct().count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "packing"]
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 0
    marks = spark.read.parquet(f"{folder}/benchmark.parquet")
    again = corpus_pipeline.decontaminate.contamination(docs, marks)
    assert again.where("contaminated").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, folder).count() == pieces.count()
