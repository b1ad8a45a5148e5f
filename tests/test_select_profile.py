"""Selection and corpus profiles."""

import pytest
from pyspark.sql import functions as F

from docspark.operators import profile, select


@pytest.fixture(scope="module")
def filings(spark):
    rows = [
        ("b.htm", "2", 2019, "x" * 1234, None),
        ("a.htm", "10", 2019, " \n", "yy"),
        ("c.htm", "1", 2020, None, ""),
        ("a.htm", "11", 2019, "zz", "yy"),
        (None, "3", None, "q", None),
    ]
    return spark.createDataFrame(
        rows, "filename STRING, cik STRING, year INT, section_1 STRING, section_7 STRING"
    )


def test_first_companies_in_order(filings):
    assert [r.cik for r in select.first_companies(filings, 3).collect()] == ["1", "10", "11"]
    assert select.first_companies(filings, 99).count() == 5


def test_select_companies_is_a_broadcast_semi_join(filings):
    df = select.select_companies(filings, 2)
    assert sorted(r.cik for r in df.collect()) == ["1", "10"]
    assert "BroadcastHashJoin" in df._jdf.queryExecution().toString()
    assert "LeftSemi" in df._jdf.queryExecution().toString()


def test_unbounded_company_list_is_not_hinted(spark, filings):
    companies = spark.createDataFrame([("1",), ("1",), ("3",)], "cik STRING")
    df = select.keep_companies(filings, companies)
    assert "hint" not in df._jdf.queryExecution().analyzed().toString().lower()
    assert sorted(r.cik for r in df.collect()) == ["1", "3"]


def test_company_list(filings):
    assert select.select_companies(filings, ciks=[2, "11"]).count() == 2


def test_first_per_year_takes_one_of_equal_names(filings):
    rows = select.first_per_year(filings).orderBy("year").collect()
    assert [(r.year, r.filename, r.cik) for r in rows] == [(2019, "a.htm", "10"), (2020, "c.htm", "1")]
    assert select.first_per_year(filings.where("year = 1900")).count() == 0


def test_first_per_year_of_nameless_filings(spark):
    rows = [(None, 2019, "b"), (None, 2019, "a"), ("z", 2020, "c"), (None, 2020, "a")]
    df = spark.createDataFrame(rows, "filename STRING, year INT, cik STRING")
    found = sorted((r.year, r.filename, r.cik) for r in select.first_per_year(df).collect())
    assert found == [(2019, None, "a"), (2020, "z", "c")]


def test_corpus_shape_and_values(filings):
    assert tuple(profile.corpus_shape(filings).first()) == (5, 5, 2, 5, 2019, 2020)
    assert tuple(profile.corpus_shape(filings.limit(0)).first()) == (0, 5, 0, 0, None, None)
    values = {(r.attribute, r.value): r.n_filings for r in profile.corpus_values(filings).collect()}
    assert values[("year", "2019")] == 3 and values[("year", None)] == 1
    assert values[("cik", "10")] == 1 and len(values) == 8


def test_section_profile_without_shuffle(filings):
    df = profile.section_profile(filings)
    assert "Exchange" not in df._jdf.queryExecution().toString()
    rows = {r.cik: (r.n_sections, r.n_chars, r.sections) for r in df.collect()}
    assert rows["2"] == (1, 1234, "section_1 (1,234 chars)")
    assert rows["10"] == (1, 2, "section_7 (2 chars)")
    assert rows["11"] == (2, 4, "section_1 (2 chars), section_7 (2 chars)")
    assert rows["1"] == (0, 0, "")


def test_embedding_shape(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,)], "embedding ARRAY<FLOAT>")
    assert tuple(profile.embedding_shape(df).first()) == (1, 2)


def test_year_filter(filings):
    assert select.in_year(filings, 2019).agg(F.count("*")).first()[0] == 3
