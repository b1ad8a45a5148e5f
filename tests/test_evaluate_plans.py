"""Validation items, answer checks and the three end-to-end jobs."""

import pytest

from docspark import schemas
from docspark.operators import evaluate
from docspark.operators.embed import hash_bow
from docspark.params import Params
from docspark.plans.explore import explore, write_plots
from docspark.plans.prepare import prepare
from docspark.plans.retrieve import ask, retrieve

ENCODER = hash_bow(4096)
ITEM = "item_id INT, query STRING, expected_section STRING, expected_answer STRING"


@pytest.fixture(scope="module")
def filings(spark):
    rows = [
        ("a.htm", "1", 2020, "the Big Bank has eleven offices", None, "x"),
        ("b.htm", "2", 2020, "eleven offices or more", "only later", "y"),
        ("c.htm", "3", 2019, "unrelated words", None, None),
    ]
    columns = ["section_1", "section_1A", "section_7", "section_8", "section_10"]
    return spark.createDataFrame(
        [(*r, None, None) for r in rows],
        "filename STRING, cik STRING, year INT, " + ", ".join(f"{c} STRING" for c in columns),
    )


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, "Big Bank offices", "section_1", "big bank"),
        (2, "eleven offices or", "section_1", "BIG BANK"),
        (3, "eleven", "section_1", "nowhere"),
        (4, "later", "section_1A", "only later"),
    ]
    return spark.createDataFrame(rows, ITEM)


def test_items_need_their_section_in_the_first_filing(filings, items):
    kept = evaluate.validation_items(filings, items, 2020)
    assert [(f.name, f.dataType) for f in kept.schema.fields] == [
        (f.name, f.dataType) for f in schemas.VALIDATION_ITEM.fields
    ]
    kept = kept.orderBy("item_id").collect()
    assert [(r.item_id, r.year, r.cik) for r in kept] == [(1, 2020, "1"), (2, 2020, "1"), (3, 2020, "1")]
    assert evaluate.validation_items(filings, items, 1999).count() == 0


def test_hits_are_checked_in_rank_order(spark, filings, items):
    done = retrieve(filings, items, ENCODER, year=2020)
    assert done.n_chunks == 6 == done.chunks.count()
    checked = {r.item_id: (r.hit_at_1, r.hit_rank, r.n_hits) for r in done.checked.collect()}
    assert checked == {1: (True, 1, 3), 2: (False, 2, 3), 3: (False, None, 3)}
    summary = done.summary.first()
    assert tuple(summary)[:4] == (3, 1, 2, 0)
    assert summary.hit_rate_at_1 == pytest.approx(1 / 3)
    more = ask(done.chunks, "unrelated", 2019, ENCODER, Params(preview_chars=4)).collect()
    assert [(r.chunk_id, r.chunk) for r in more] == [("c.htm_section_1_0", "unre...")]


def test_item_without_hits(spark):
    items = spark.createDataFrame(
        [(1, "q", "section_1", "a", 1999, "7")], ITEM + ", year INT, cik STRING"
    )
    hits = spark.createDataFrame([], "query_id INT, rank INT, full_text STRING")
    assert tuple(evaluate.check_hits(items, hits).first()) == (1, False, None, 0)


def test_explore(spark, tmp_path):
    text = "PART I\nITEM 1.\n{0} makes things\nITEM 7\n{0} sold {1} of them in many places\nITEM 8\n"
    rows = [(str(c), f"C{c}", "10-K", 2020, text.format("ab" * c, c)) for c in range(1, 9)]
    raw = spark.createDataFrame(
        rows, "cik STRING, company_name STRING, filing_type STRING, year INT, text STRING"
    )
    done = explore(raw, hash_bow(), Params(clusters=2, chunk_words=4))
    assert done.rows["filings"] == 5
    assert done.rows["chunks"] == done.rows["embedded"] == done.rows["clustered"] == 15
    assert done.clustered.count() == 15
    assert done.plots["points"].count() == 15
    assert done.plots["combined"].agg({"n_points": "sum"}).first()[0] == 15
    write_plots(done, str(tmp_path / "plots"))
    assert spark.read.parquet(str(tmp_path / "plots/sections")).agg({"n_points": "sum"}).first()[0] == 15
    two = explore(raw, hash_bow(), Params(clusters=2), ciks=["3", "4"])
    assert two.rows["filings"] == 2


def test_prepare(spark, filings, tmp_path):
    done = prepare(
        filings, cik="1", years=[2020], csv=str(tmp_path / "csv"), table=str(tmp_path / "table")
    )
    assert done.filings.count() == 1
    assert done.shape.first().n_filings == 1
    assert done.values.count() == 2
    assert done.sections.first().sections == "section_1 (31 chars), section_7 (1 chars)"
    assert spark.read.parquet(str(tmp_path / "table")).where("year = 2020").count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1
