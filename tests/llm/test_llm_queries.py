"""The registered queries: rows against SQL where there is a twin, columns and types for all."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import SMOKE_DIR, oracle_sql, queries
from stratalith.llm.queries import ORACLE, QUERIES
from tools.compare import compare, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test tables are not here")

COLUMNS = {
    "op1_decontaminate": {"doc_id": "bigint", "item_id": "bigint", "containment": "double"},
    "op2_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op4_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5_warc_zip": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op6_personal_data": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op7_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op8_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op9_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op10_line_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op11_bpe_round_trip": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op12_fill_in_middle": {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output_sha256": "string", "restored_sha256": "string"},
    "op13_token_alignment": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
    "pipeline": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMOKE_DIR)


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    assert compare(spark, duck, SMOKE_DIR, name) is None


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in ORACLE])
def test_columns(spark, name):
    found = QUERIES[name](spark, SMOKE_DIR)
    assert COLUMNS[name].items() <= dict(found.dtypes).items()
    assert found.limit(1).count() == 1


def test_registered():
    assert set(COLUMNS) == set(QUERIES) <= set(queries()) and ORACLE.keys() <= oracle_sql().keys()
