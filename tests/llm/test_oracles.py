"""Registered queries against their SQL counterparts, and the pipeline's contract."""

from pathlib import Path

import pytest

from checks.compare import connect, rows_of
from docspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    result = connect(SF).sql(ORACLES[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(result.columns, result.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_one_row_per_input_row(spark, name):
    df = QUERIES[name](spark, SF)
    table = "pages" if name == "op1_html_extraction" else "documents"
    expected = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert df.count() == expected or name in ("op3_best_fit_packing", "op7_decontamination")


def test_every_number_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
