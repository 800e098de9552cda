"""The registered corpus queries over whole small tables, and the pipeline."""

import duckdb
import pytest
from corpus import collected, documents, empty, near_copies, odd_documents

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from postlark.llm import ngram_join
from postlark.llm.oracles import ORACLES
from postlark.llm.queries import QUERIES
from postlark.session import stored

CONTRACTS = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words "
    "base_failed kept",
    "op2_source_mixing": "doc_id size source_size target taken",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_line_dedup": "doc_id n_lines n_removed kept_sha256",
    "op6_token_counts": "doc_id n_tokens",
    "op7_ngram_jaccard": "doc_id n_shingles component_id",
    "op8_compression_classifier": "doc_id held_out score predicted",
    "op9_bm25_top_k": "query_id rank doc_id score",
    "op10_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op12_phrase_collocations": "lang rank phrase a l r n score",
    "op13_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
}


def test_all_are_registered():
    assert QUERIES.keys() == CONTRACTS.keys()
    assert {*QUERIES, "pipeline"} <= queries().keys()
    assert ORACLES.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns_and_rows(spark, data, name):
    found = QUERIES[name](spark, data)
    assert set(CONTRACTS[name].split()) <= set(found.columns)
    rows = found.collect()
    if name not in ("op9_bm25_top_k", "op12_phrase_collocations"):
        docs = spark.read.parquet(f"{data}/documents.parquet")
        assert sorted(row.doc_id for row in rows) == sorted(row.doc_id for row in docs.collect())
    assert rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, data, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    found = QUERIES[name](spark, data)
    result = con.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert collected(found.select(columns)) == sorted(map(tuple, result.fetchall()), key=repr)


def staged(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], data), "test-stage"))
    return frames


def test_pipeline(spark, data):
    names = [name for name, _ in corpus_pipeline.STAGES]
    frames = staged(spark, data)
    for frame in frames[:-1]:
        assert frame.columns == frames[0].columns
    start, good, single, distinct, mixed, encoded = frames
    assert 0 < good.count() < start.count(), names[0]
    assert {row.doc_id for row in single.collect()} <= {row.doc_id for row in good.collect()}
    linked = ngram_join.linked(distinct)
    assert linked.where("component_id <> doc_id").count() == 0
    assert {row.doc_id for row in mixed.collect()} <= {row.doc_id for row in distinct.collect()}
    assert encoded.count() == mixed.count()
    assert collected(corpus_pipeline.run(spark, data)) == collected(encoded)


def test_stages_take_odd_documents(spark, data):
    known = documents(spark, near_copies())
    for docs in (odd_documents(spark), known, empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, docs, data), "test-stage")
            assert out.columns == docs.columns
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, data).count() == docs.count()
