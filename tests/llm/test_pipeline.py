import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import queries


def test_stages_and_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_copies", "passages", "packing"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        after = docs.count()
        assert 0 < after <= before
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    # where sequences are cut depends on partitions, what is packed doesn't
    size = lambda df: {(r.doc_id, r.doc_tokens): r.n for r in df.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()}
    assert size(corpus_pipeline.run(spark, small)) == size(packed)


CLASHING = {"line": 1, "id": 2, "node": 3, "component": "c", "label": "l", "key": 4, "ids": "i", "start": 5, "n": 6, "print": 7, "first": 8, "data": "d", "score": 0.5, "lang_pred": "p"}


def stages(spark, docs, folder):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()


def test_stages_take_nulls_repeats_long_texts_and_clashing_columns(spark, small):
    good = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 120")
    odd = [(1000, None, "en"), (1001, "", None), (None, None, None), (None, "a text without any number, " * 5, "en"), (1002, "the same words again and again " * 4000, "en"), (3, "short", "en"), (3, "short", "en"), (1003, "\n\n \n", "en"), (1004, "x" * 50_000, "en")]
    docs = good.select("doc_id", "text", "lang").union(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    docs = docs.selectExpr("*", "'s' AS source", "CAST(length(text) AS LONG) AS n_chars", *(f"{v!r} AS {k}" for k, v in CLASHING.items()))
    kept, packed = stages(spark, docs, small)
    assert 0 < kept.count() <= docs.count()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept.collect()}


def test_stages_take_an_empty_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("false")
    kept, packed = stages(spark, docs, small)
    assert kept.count() == 0 and packed == []


def test_chat_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    con.execute(queries.ORACLES["op4_chat_format"])
    columns = [c[0] for c in con.description]
    made = queries.QUERIES["op4_chat_format"](spark, small).select(*columns).collect()
    assert sorted(map(tuple, made)) == sorted(con.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 11))
