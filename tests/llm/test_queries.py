"""The registered queries: their columns, their types, and a row for everything that they are asked about."""

import pytest

from lodestream.llm import registry

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_warc": ("pages", {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"}),
    "op2_neardup": ("documents", {"doc_id": "bigint", "class_id": "bigint"}),
    "op3_mix": ("documents", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
    "op4_quality": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op5_fingerprint": ("documents", {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}),
    "op6_pack": (None, {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}),
    "op7_extract": ("pages", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    "op8_substrings": ("documents", {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}),
    "op9_neighbours": (None, {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}),
    "op10_secrets": (None, {"doc_id": "bigint", "start": "bigint", "length": "bigint", "kind": "string", "secret_sha256": "string", "score": "double"}),
}


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_contract(spark, name):
    table, columns = CONTRACT[name]
    df = registry.queries()[name](spark, SF)
    assert dict(df.dtypes) == columns
    rows = df.collect()
    if table:
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_names_are_complete():
    assert set(CONTRACT) == set(registry.queries()) and set(registry.oracle_sql()) <= set(CONTRACT)
