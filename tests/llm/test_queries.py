"""The registered queries: contract columns, on the smallest tables."""

import pytest

from tests.oracle import connect, rows_of, spark_rows
from vitalgrid.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id held_out score predicted",
    "op2": "doc_id item_id score end_word",
    "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4": "doc_id n_shingles component_id kept",
    "op5": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op6": "page_id url text n_chars",
    "op7": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8": "conv_id n_turns chat",
    "op9": "doc_id size text_crc32 law shard slot grown_shard",
    "op10": "doc_id n_words n_removed kept_sha256",
    "op11": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op12": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13": "vec_id code error label_error codebooks_sha256",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract_columns(spark, name):
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(QUERIES[name](spark, SF).columns)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == rows_of(connect(SF).execute(ORACLE_SQL[name]))
