"""Registered queries against their DuckDB SQL."""

import pytest

from ledgerline.llm import oracle, queries
from tests.compare import compare, duckdb_con
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(oracle.registry()))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, queries.registry()[name], oracle.registry()[name], SF_SMALL, duckdb_con(SF_SMALL))
    assert r["cols_ok"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows_ok"], (r["spark_sample"], r["oracle_sample"])
    assert r["spark_rows"] > 0


def test_schemas_of_the_contracts(spark):
    want = {
        "op1_suffix_dedup": "doc_id:bigint,n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string",
        "op4_quality_rules": "doc_id:bigint,n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
                             "n_repeat_words:bigint,base_failed:boolean,kept:boolean",
        "op5_jaccard_join": "doc_id:bigint,n_shingles:bigint,component_id:bigint",
        "op6_secret_scan": "doc_id:bigint,n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string,n_entropy:bigint",
        "op7_decontaminate": "doc_id:bigint,n_words:bigint,n_hit:bigint,n_items:bigint,items_sha256:string,contaminated:boolean,"
                             "n_proximity:bigint,proximity_sha256:string",
        "op8_warc": "page_id:bigint,payload_bytes:bigint,payload_digest:string,record_type:string,refers_to:bigint",
        "op9_packing": "doc_id:bigint,start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint,sequence_id:bigint,offset:bigint",
        "op10_substring_dedup": "doc_id:bigint,n_words:bigint,n_removed:bigint,kept_sha256:string",
    }
    for name, schema in want.items():
        got = queries.registry()[name](spark, SF_SMALL).schema.simpleString()
        assert got == f"struct<{schema}>", name
