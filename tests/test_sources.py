"""Scans, sinks, staging and the plans they lead to."""

import pytest
from pyspark.sql import functions as F

from docspark import schemas
from docspark.sources import filings as src, staging


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def wide_path(spark, tmp_path_factory):
    rows = [(f"f{i}.htm", str(i % 3), 2018 + i % 3, f"text {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "filename STRING, cik STRING, year INT, section_1 STRING")
    path = str(tmp_path_factory.mktemp("data") / "wide")
    src.write_table(df, path, partition_by="year")
    return path


def test_wide_scan_prunes_years_and_columns_and_pushes_the_company(spark, wide_path):
    df = src.read_wide(spark, wide_path, cik=1, years=[2019]).select("filename", "section_1")
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [(year" in plan
    assert "EqualTo(cik,1)" in plan
    assert "ReadSchema: struct<filename:string,cik:string,section_1:string>" in plan
    assert "cast" not in plan.split("Physical Plan")[1]
    assert df.count() == 10


@pytest.mark.parametrize("kind", ["BIGINT", "STRING"])
def test_filters_reach_the_scan_in_the_type_of_the_file(spark, tmp_path, kind):
    rows = [(f"f{i}", i % 3, 2018 + i % 3, "N/A") for i in range(12)]
    df = spark.createDataFrame(rows, "filename STRING, cik BIGINT, year BIGINT, section_1 STRING")
    path = str(tmp_path / kind)
    df.withColumn("cik", F.col("cik").cast(kind)).write.parquet(path)
    found = src.missing_to_null(src.read_wide(spark, path, cik=1, years=[2019]))
    assert "EqualTo(cik,1)" in plan_of(found) and "EqualTo(year,2019)" in plan_of(found)
    assert {(r.cik, r.year, r.section_1) for r in found.collect()} == {("1", 2019, None)}
    assert src.read_wide(spark, path, cik="01").count() == 0


def test_all_sections_are_kept_and_needed_columns_demanded(spark, tmp_path):
    df = spark.createDataFrame([("f", "1", 2020, "a", 7)], "filename STRING, cik STRING, year INT, section_9C STRING, section_16 INT")
    df.write.parquet(str(tmp_path / "wide"))
    row = src.read_wide(spark, str(tmp_path / "wide")).first()
    assert (row.section_9C, row.section_16, row.section_1) == ("a", "7", None)
    df.drop("year").write.parquet(str(tmp_path / "lacking"))
    with pytest.raises(ValueError, match="year"):
        src.read_wide(spark, str(tmp_path / "lacking"))
    df.withColumnRenamed("section_9C", "body").write.parquet(str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="text"):
        src.read_raw(spark, str(tmp_path / "raw"))


def test_csv_files_of_different_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("filename,cik,year,section_7\nf,1,2019,seven\n")
    (tmp_path / "b.csv").write_text("section_7,section_9C,year,cik,filename\nseven2,nine,2020,2,g\n")
    rows = src.read_csv(spark, str(tmp_path)).orderBy("filename").collect()
    found = [(r.filename, r.cik, r.year, r.section_7, r.section_9C) for r in rows]
    assert found == [("f", "1", 2019, "seven", None), ("g", "2", 2020, "seven2", "nine")]


def test_wide_scan_without_filters_fills_absent_sections(spark, wide_path):
    df = src.read_wide(spark, wide_path)
    assert set(df.columns) == set(schemas.WIDE_FILING.names)
    assert df.where(F.col("section_15").isNull()).count() == 30


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_raw_scan(spark, tmp_path, fmt):
    rows = [("1", "One", "10-K", 2020, "a\nb", "train"), ("2", "Two", "10-K", 2019, None, "test")]
    schema = [*schemas.RAW_FILING.names, "split"]
    path = str(tmp_path / fmt)
    spark.createDataFrame(rows, schema).withColumn("year", F.col("year").cast("int")).write.format(
        fmt
    ).save(path)
    assert src.read_raw(spark, path, fmt=fmt).schema == schemas.RAW_FILING
    assert src.read_raw(spark, path, fmt=fmt).count() == 2
    kept = src.read_raw(spark, path, fmt=fmt, year=2020, split="train").collect()
    assert [tuple(r) for r in kept] == [("1", "One", "10-K", 2020, "a\nb")]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_other_types_and_absent_columns(spark, tmp_path, fmt):
    rows = [(7, "2020", "t"), (8, "unknown", "u")]
    path = str(tmp_path / fmt)
    spark.createDataFrame(rows, "cik LONG, year STRING, text STRING").write.format(fmt).save(path)
    found = src.read_raw(spark, path, fmt=fmt).orderBy("cik").collect()
    assert [(r.cik, r.year, r.company_name) for r in found] == [("7", 2020, None), ("8", None, None)]
    assert src.read_raw(spark, path, fmt=fmt, year=2020).count() == 1


def test_missing_tokens(spark, tmp_path):
    texts = ["N/A", "None", "NA", "null", "None.", " ", "", 'say "hi", and\r\nbye \\n', "  pad "]
    rows = [(f"f{i}", "1", 2020, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "filename STRING, cik STRING, year INT, section_1 STRING")
    src.write_csv(df, str(tmp_path / "csv"))
    back = src.read_csv(spark, str(tmp_path / "csv"))
    assert back.schema["year"].dataType.typeName() == "integer"
    assert [r.section_1 for r in back.orderBy("filename").collect()] == [
        None, None, None, None, "None.", " ", None, 'say "hi", and\r\nbye \\n', "  pad ",
    ]


def test_csv_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text('section_1,year,filename,cik\n"a\nb",2020.0,f.htm,0012\nc,bad,g.htm,7\n')
    rows = src.read_csv(spark, str(path)).orderBy("filename").collect()
    assert [(r.filename, r.year, r.cik, r.section_1) for r in rows] == [
        ("f.htm", 2020, "0012", "a\nb"),
        ("g.htm", None, "7", "c"),
    ]


def test_stage_counts_while_writing(spark):
    df, rows = staging.stage(spark.range(1000).where("id > 9"), "numbers")
    assert rows == 990 == df.count()
    assert "numbers" in df.inputFiles()[0]
    folder = staging.shared_folder(spark).removeprefix("file:")
    assert df.inputFiles()[0].removeprefix("file://").startswith(folder)


def test_release_removes_what_was_staged(tmp_path, spark, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    staging.stage(spark.range(10), "numbers")
    (tmp_path / "other").mkdir()
    staging.release(spark)
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == [] and (tmp_path / "other").exists()


class Session:
    """As much of a session as the folder rule looks at."""

    def __init__(self, setting, master):
        self.folder = None
        self.master = master
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_is_the_named_one():
    assert staging.shared_folder(Session("/shared", "yarn")) == "/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session(None, "yarn"))
    local = Session(None, "local[2]")
    assert staging.shared_folder(local) == staging.shared_folder(local) != ""


def test_spread_only_deals_out_small_scans(spark, tmp_path):
    rows = spark.range(100)
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    one = src.spread(spark.read.parquet(str(tmp_path / "one")))
    assert one.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 9)
    assert src.spread(wide) is wide


def test_csv_headers_take_one_pass(spark, tmp_path):
    """Many files of few kinds, odd names, a header over two lines, an empty file."""
    names = ["a.csv", "b c%20+.csv", "d/e.csv", "q.csv", "two lines.csv", "empty.csv"]
    texts = [
        'filename,cik,year,section_1\nf0,1,2019,"x\ny"\n',
        "\nfilename,cik,year,section_1\nf1,1,2019,z\n",
        "year,section_1,filename,cik\n2020,w,f2,1\n",
        'filename,cik,year,"section_1"\nf3,1,2018,v\n',
        'filename,cik,year,"section\n_1"\nf4,1,2018,v\n',
        "",
    ]
    for name, text in zip(names, texts):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    found = {r.filename: (r.year, r.section_1) for r in src.read_csv(spark, str(tmp_path)).collect()}
    assert found == {"f0": (2019, "x\ny"), "f1": (2019, "z"), "f2": (2020, "w"), "f3": (2018, "v"), "f4": (2018, None)}
    assert sorted(map(len, src._alike(spark, str(tmp_path)))) == [1, 1, 1, 2]
