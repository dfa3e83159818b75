"""The pipeline's stages, each held against what it is given."""

import re

import corpus_pipeline
from lodestream.llm import common, mixing, neardup, quality


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [given]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(common.materialize(stage(spark, kept[-1], sf), "stage"))
    assert all(k.columns == given.columns for k in kept[:-1])
    ids = [sorted(r.doc_id for r in k.select("doc_id").collect()) for k in kept]
    rules = quality.fit(given, spark.read.parquet(f"{sf}/labels.parquet"))
    assert ids[1] == sorted(r.doc_id for r in quality.score(given, rules).where("score >= 0.5").collect())
    assert ids[2] == sorted({r.class_id for r in neardup.classes(kept[1]).collect()})
    assert ids[3] == ids[2]
    left = [r.text for r in kept[3].collect()]
    assert not any(re.search(r"AKIA[A-Z0-9]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}", t) for t in left)
    changed = {r.doc_id for r in kept[3].exceptAll(kept[2]).collect()}
    assert changed == {r.doc_id for r in kept[2].collect() if re.search(r"(?i)AKIA[A-Z0-9]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}", r.text)}
    copies = {r.doc_id: r.copies for r in mixing.plan(kept[3]).collect()}
    assert ids[4] == sorted(i for i, n in copies.items() for _ in range(n))
    assert {r.doc_id for r in kept[5].select("doc_id").collect()} == set(ids[4])
    assert kept[5].select("piece").where("piece = 0").count() == len(ids[4])


def test_run_and_empty_table(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0


def test_stages_on_hard_rows(spark):
    """Nulls in every column, empty and very long texts, ids that repeat, and extra columns named like what operators use."""
    long = "lorem ipsum dolor sit amet " * 20000
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one two three four five six", "en", "b", 27), (3, "one two three four five six", "en", "b", 27), (4, " \t\n", None, "b", 4), (None, "no id here, really none at all", "de", None, 30), (5, long, "en", "a", len(long)), (6, "token = \"0123456789abcdef0123456789abcdef01234567\" and words", "en", "a", 60)]
    extra = {"mark": "kept", "score": "kept", "mix_rate": "kept", "RAW": "kept", "later": "kept", "label": "kept"}
    docs = spark.createDataFrame([(*r, *extra.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    for name, stage in corpus_pipeline.STAGES:
        made = common.materialize(stage(spark, docs, "/root/testdata/sf0.001"), "hard")
        if name != "packing":
            assert made.columns == docs.columns and made.where(" or ".join(f"{c} <> 'kept'" for c in extra)).count() == 0
        if name == "near-duplicates":
            assert sorted((r.doc_id is not None, r.doc_id or 0) for r in made.collect()) == sorted((i is not None, i or 0) for i in (1, 3, 3, None, 5, 6))
        if name == "quality classifier":
            continue  # whatever it keeps, the next stages are given all rows
        docs = made
    assert docs.count() > 0
