"""The corpus pipeline: quality, near-duplicates, secrets, mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs, as its predecessor
kept them; all but the last return the columns of ``documents``.  The classifier learns
from ``labels`` and the documents of sf_dir; everything else comes from docs alone.

Defined cases: those of the operators that the stages call; an empty table passes through
every stage and gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.llm import common, mixing, neardup, packing, quality, secrets


def reject_low_quality(spark, docs, sf_dir):
    """Documents that the classifier scores at 0.5 or more."""
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = quality.fit(whole, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mark = common.free_name("score", docs.columns)
    scored = quality.score(docs, rules, name=mark)
    return scored.where(F.col(mark) >= 0.5).drop(mark)


def drop_near_duplicates(spark, docs, sf_dir):
    """Of each class of near-duplicates the document with the smallest id."""
    return neardup.keep_first(docs)


def redact_secrets(spark, docs, sf_dir):
    """Every document, with its secrets masked and n_chars brought up to date."""
    return secrets.redact(docs, secrets.default_forest(spark), length_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark, docs, sf_dir):
    """Each document as often as the mix of sources takes it."""
    return mixing.emit(docs)


def pack_sequences(spark, docs, sf_dir):
    """The pieces of all documents, packed into sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", reject_low_quality),
    ("near-duplicates", drop_near_duplicates),
    ("secret scan", redact_secrets),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]
#: The classifier, the signatures, the forest and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to ``documents``; each is written and read again before the next one, so none is computed twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
