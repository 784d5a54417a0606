"""The pipeline against brute force over what each stage wrote, and the registered queries."""

import os

import corpus_pipeline
import pytest
from corpora import plain_words

import __spark_entry__ as contract
from sluiceway.llm import queries
from test_decontam import brute as leaks
from test_similar import brute as near_groups
from test_substrings import brute as repeats

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    names = {n.split("_")[0] for n in contract.queries()}
    assert {f"op{n}" for n in range(1, 14)} <= names and "pipeline" in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given = [tuple(r) for r in docs.collect()]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        rows = out.collect()
        if name != "packing":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append(rows)
        if name != "packing":
            docs = spark.createDataFrame(rows, docs.schema)
    quality, near, passages, clean, packed = kept
    assert 0 < len(quality) < len(given) and {tuple(r) for r in quality} <= set(given)
    assert {r.doc_id for r in near} == {i for i, component in near_groups(list(map(tuple, quality))) if i == component}
    expected = repeats(sorted(map(tuple, near)))
    before = {r.doc_id: r for r in near}
    for r in passages:
        _, removed, text = expected[r.doc_id, before[r.doc_id].text]
        assert r.text == (text if removed else before[r.doc_id].text) and r.n_chars == len(r.text)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r.doc_id for r in clean} == {r.doc_id for r in passages if not leaks(r.text, items)[-1]}
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}
    assert all(plain_words(r.text) for r in clean)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are needed")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_of_the_queries(spark, name):
    columns = {
        "op1": ["doc_id", "held_out", "score", "predicted"],
        "op2": ["doc_id", "fingerprint", "component_id"],
        "op3": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op4": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op5": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op6": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        "op7": ["doc_id", "held_out", "lang_pred", "score"],
        "op8": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op9": ["vec_id", "n_links", "component_id", "kept"],
        "op11": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op12": ["word", "form", "root", "n", "n_near", "form_n"],
        "op13": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        "op10": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    }[name.split("_")[0]]
    assert queries.QUERIES[name](spark, SF_DIR).columns[: len(columns)] == columns
