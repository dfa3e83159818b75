"""Every query over stated cases against the rows that its SQL states; and the guards of rules against rules without them."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestream.functions import rules
from lodestream.functions import vocabulary as V
from lodestream.operators import relational
from lodestream.plans import cases, catalog


@pytest.mark.parametrize("name", sorted(cases.queries()))
def test_case(spark, name):
    df = cases.queries()[name](spark, "")
    columns = sorted(df.columns)
    want = duckdb.sql(cases.oracle_sql()[name])
    at = [d[0] for d in want.description]
    assert sorted(at) == columns
    rounded = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    assert sorted((rounded(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((rounded(r[at.index(c)] for c in columns) for r in want.fetchall()), key=repr)


def test_leads_of_patterns():
    assert rules.leads(r"\bfull[\s\-]?time\b|\bFTE\b|\bintern(?:ship)?\b|\bjobs?\b") == ["full", "fte", "intern", "job"]
    assert rules.leads(r"\bx\b|y") is None and rules.leads(r"(?:a|b)") is None and rules.leads(r"\b[a|b]c") is None


@pytest.mark.parametrize("table", [V.EMPLOYMENT, V.JOB_CATEGORY, V.SENIORITY, V.EDUCATION_TYPE, V.EDUCATION_STREAM])
def test_guards_change_nothing(spark, table):
    import random

    r = random.Random(4)
    words = "Full time Vollzeit temps plein FTE part-time PRN as needed contractor b2b intern interim internal STAGE ſales Kotlin account executive accountant hr HR human resources chef İT network qa nursing nurse bachelor MBA PhD senior lead junior the and".split()
    df = spark.createDataFrame([(" ".join(r.choice(words) for _ in range(r.randint(0, 6))),) for _ in range(1500)] + [(None,), ("",)], "t string")
    plain = F
    for label, pattern in table:
        plain = plain.when(rules.matches(F.col("t"), pattern), F.lit(label))
    assert df.where(~rules.first_match(F.col("t"), table).eqNullSafe(plain.otherwise(F.lit("")))).count() == 0


def test_labels_are_of_whole_texts(spark, tmp_path):
    spark.createDataFrame([(1, "x " * 30_000 + "Vollzeit nurse")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in catalog.queries()["classify_documents"](spark, str(tmp_path)).collect()] == [(1, "Full Time", "Healthcare")]


def test_labels_of_whole_texts_are_those_of_sql(spark, tmp_path):
    """Rules at the end of long texts, and letters beyond ASCII beside and within words."""
    import random

    r = random.Random(5)
    pieces = "Full time FTE intern stage temp PRN b2b analyst system software nurse pharmacy Verkäufer VERKÄUFER verkäuferin hr legal it support help desk".split() + ["é", "ß", "ſ", "\u212a", "İ", "ı", "\u0301", "_", "-", "/", " ", " ", "\n", "\r", "\t", "\x0b", "\xa0", "\u2028", "ſales", "wor\u212aing student", "as\x0bneeded", "as\nneeded", "İT support", "ıntern", "analyst\rsystem", "analyst\nsystem", "éstage", "stageé", "interné", "xſecretary", "ſecretary", "chef", "chefs"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 7))) for _ in range(3000)] + [None, "", "x " * 30_000 + "Vollzeit nurse"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {row.doc_id: tuple(row)[1:] for row in catalog.queries()["classify_documents"](spark, str(tmp_path)).collect()}
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = {i: (a, b) for i, a, b in db.sql(catalog.oracle_sql()["classify_documents"]).fetchall()}
    assert got[len(texts) - 1] == ("Full Time", "Healthcare")
    assert {i: (texts[i], got[i], want[i]) for i in want if got[i] != want[i]} == {} and len(got) == len(texts)


def test_unions_and_sizes(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2,), (3,)], "k int")
    assert relational.union_rows(a, b).count() == 4
    assert {r.k: r.part for r in relational.union_first([a, b], "k").collect()} == {1: 1, 2: 1, 3: 2}
    assert {(r.k, r.n) for r in relational.group_size(relational.union_rows(a, b), ["k"], "n").collect()} == {(1, 1), (2, 2), (3, 1)}
    assert tuple(relational.blank_counts(spark.createDataFrame([(" ",), (None,), ("x",)], "v string"), ["v"]).first()) == (3, 2)
