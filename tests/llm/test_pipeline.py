import os

import duckdb
import pytest
from pyspark.sql import functions as F

import cases
import corpus_pipeline
from tapeloom.llm import mixing, queries

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect_on_their_input(spark, tmp_path):
    docs = [r for r in cases.edge_rows()] + [(900, "you stupid idiot, " * 5, "en", "s1", 0), (901, cases.PROSE[1] + " and the end", "en", "s1", 0)]
    spark.createDataFrame(docs, cases.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, cases.PROSE[1])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        if name != "sharding":
            assert out.columns == frame.columns
        out.write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = [r.doc_id for r in frame.collect()]
    assert 900 not in seen["toxicity"] and set(seen["toxicity"]) >= {0, 1, 901}
    assert seen["near_duplicates"].count(200) == 1 and 106 not in seen["near_duplicates"]
    assert 901 not in seen["decontamination"] and 0 in seen["decontamination"]
    assert sorted(seen["sharding"], key=str) == sorted(seen["mixing"], key=str)
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id for r in final.collect()), key=str) == sorted(seen["sharding"], key=str)


def test_the_mix_keeps_texts_whole(spark, tmp_path):
    rows = [(i, " ".join(f"{source}{i}" for _ in range(30 + i * 37 % 400)), "en", source, 7) for i in range(30) for source in ("a", "b", "c")]
    docs = spark.createDataFrame([(3 * k, *r[1:]) for k, r in enumerate(rows)], cases.DOCS)
    text = {r.doc_id: r.text for r in docs.collect()}
    target, at = {r.source: r.target for r in mixing.mix_plan(spark, docs).collect()}, {}
    for r in corpus_pipeline.mixed(spark, docs, str(tmp_path)).collect():
        assert r.text == text[r.doc_id] and r.n_chars == 7
        at[r.source] = at.get(r.source, 0) + len(cases.words(r.text))
    assert all(abs(at[s] - target[s]) <= 430 / 2 + 1 for s in "abc")


def test_columns_of_documents_keep_their_values(spark, tmp_path):
    """Also those that operators would add themselves."""
    names = ["score", "predicted", "target", "size", "taken", "placements", "leaked", "items", "dec_row", "dup_row", "row", "shard", "copy", "words", "mix_start", "a b.c"]
    docs = spark.createDataFrame([r for r in cases.edge_rows() if r[0] not in (105, 106)], cases.DOCS)
    docs = docs.select("*", *[F.concat(F.lit(name), F.col("doc_id").cast("string"), F.lit("x")).alias(name) for name in names])
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, cases.PROSE[1])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    known = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        rows = out.collect()
        assert out.columns == docs.columns and rows, name
        assert {tuple(r) for r in rows} <= known, name


def test_stages_take_empty_tables(spark, tmp_path):
    cases.empty_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    expected = con.execute(queries.ORACLES[name]).fetchall()
    names = [d[0] for d in con.description]
    got = queries.REGISTERED[name](spark, SMALL).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
