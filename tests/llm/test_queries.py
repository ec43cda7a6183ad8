"""Text queries against their SQL, and what the others return."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.compare import connect, differences
from tidewarden.llm.queries import oracle_sql, queries

COLUMNS = {
    "op1_license_scan": "doc_id license notice containment first_word last_word",
    "op2_language_id": "doc_id page_id lang posterior text_lang kept",
    "op3_simhash_near_duplicates": "doc_id fingerprint component_id",
    "op4_permutation_index": "query_id rank vec_id score",
    "op5_pii_pseudonyms": "doc_id text n_pii pii_spans",
    "op6_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op8_edit_aware_counts": "doc_id n_before n_tokens recoded n_chars edited_sha256",
    "op9_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next "
    "distinct_shingles kept_in_edited",
    "op10_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op11_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12_vector_codes": "vec_id code error label_error codebooks_sha256",
    "op13_repeated_passages": "doc_id n_bytes n_removed n_spans kept_sha256",
}


def test_all_are_registered():
    assert set(queries()) == set(COLUMNS) and set(oracle_sql()) <= set(COLUMNS)
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    got = queries()[name](spark, sf).toPandas()
    assert differences(got, connect(sf).execute(oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf, name):
    assert queries()[name](spark, sf).columns == COLUMNS[name].split()
