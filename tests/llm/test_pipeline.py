"""The pipeline's stages on a small corpus, and the queries of this subpackage against SQL."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_stages_return_documents_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    clean = " ".join(f"word{k} item{k}" for k in range(80))
    extra = [(9001, "You are an idiot and a moron, scum, a pathetic worthless loser. " + clean.replace("word", "term"), "en", "s", 1), (9002, clean, "en", "s", 1), (9003, clean.replace("word7 ", "other "), "en", "s", 1), (9004, "before " + item, "en", "s", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    left = [set(r.doc_id for r in docs.collect())]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        left.append(set(r.doc_id for r in docs.collect()))
    assert all(b <= a for a, b in zip(left, left[1:], strict=False))
    assert 9001 in left[0] and 9001 not in left[1]
    assert 9002 in left[-1] and 9003 not in left[3]
    assert 9004 in left[3] and 9004 not in left[4]
    assert docs.where(F.col("n_tokens").isNull()).count() == 0


def test_near_copies_leave_one_row_of_each_and_no_more_go(spark):
    texts = [" ".join(f"{name}{k}" for k in range(60)) for name in ("one", "two", "three", "four")]
    rows = [(1, texts[0]), (2, texts[0] + " end"), (2, texts[1]), (3, texts[2]), (3, texts[2]), (None, texts[0]), (None, texts[3]), (None, texts[3]), (4, None), (5, "")]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n_chars long")
    out = corpus_pipeline.near_copies(spark, docs, DATA)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    want = [(1, texts[0]), (2, texts[1]), (3, texts[2]), (None, texts[3]), (4, None), (5, "")]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == 0


@pytest.mark.parametrize("name", ["op3_suffix_dedup", "op6_ngram_jaccard_join", "op8_decontamination", "op11_minhash_near_dedup"])
def test_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = entry.queries()[name](spark, DATA)
    columns = ", ".join(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(f"select {columns} from ({entry.oracle_sql()[name]})").fetchall())


def test_every_operator_has_a_query():
    assert {f"op{n}_" for n in range(1, 13)} == {q.split("_")[0] + "_" for q in entry.queries() if q.startswith("op")}
