"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from . import extraction, fingerprint, mixing, neardup, neighbours, packing, quality, secrets, substrings, warc


def queries() -> dict:
    return {
        "op1_warc": warc.op1_warc,
        "op2_neardup": neardup.op2_neardup,
        "op3_mix": mixing.op3_mix,
        "op4_quality": quality.op4_quality,
        "op5_fingerprint": fingerprint.op5_fingerprint,
        "op6_pack": packing.op6_pack,
        "op7_extract": extraction.op7_extract,
        "op8_substrings": substrings.op8_substrings,
        "op9_neighbours": neighbours.op9_neighbours,
        "op10_secrets": secrets.op10_secrets,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc.OP1_SQL,
        "op3_mix": mixing.OP3_SQL,
    }
