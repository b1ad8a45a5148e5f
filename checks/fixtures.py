"""Filing tables derived from the given ``documents`` and ``benchmark`` tables.

Each view is one SQL text that Spark and DuckDB both run.  Every document is used whole;
the year follows the language, so one year holds most of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docspark.sources.filings import spread

YEAR = "case lang when 'en' then 2020 when 'fr' then 2019 else 2018 end"

SEGMENTS = f"""
select doc_id, source, n_chars, text, {YEAR} as year, chr(10) as nl,
       substring(text, 1, cast(floor(length(text) / 3) as int)) as s1,
       substring(text, cast(floor(length(text) / 3) as int) + 1,
                 cast(floor(length(text) / 3) as int)) as s2,
       substring(text, 2 * cast(floor(length(text) / 3) as int) + 1) as s3
from documents"""

# Headers, an empty section, an inline title, a repeated title, a lost last section.
FILINGS_RAW = """
select doc_id, source as cik, concat('Company ', source) as company_name,
       '10-K' as filing_type, year,
       concat('PART I', nl, 'ITEM 1.', nl, s1, nl, 'Item 1A.', nl, s2, nl,
              'ITEM 7. Inline title', nl, 'ITEM 7', nl, s3, nl,
              case when n_chars > 2000 then concat('ITEM  1', nl, s2, nl) else '' end,
              'ITEM 15.', nl, 'closing') as text
from segments"""

# Null, blank and "missing" sections, and one section that is not searched.
FILINGS_WIDE = """
select concat(source, '_', cast(doc_id as varchar(20)), '.htm') as filename,
       source as cik, year, s1 as section_1,
       case when n_chars < 600 then null else s2 end as section_1A,
       concat('Properties of ', source) as section_2,
       case when source = 'src7' then '   ' else s3 end as section_7,
       case when source in ('src3', 'src5') then 'N/A' else text end as section_8,
       case when year = 2019 then null else s2 end as section_10
from segments"""

# Every benchmark text is asked in every year; a few of its letters are the expected answer,
# so that hits of any rank, or none, hold it.
ITEMS = """
select cast(item_id * 3 + year - 2018 as int) as item_id, text as query,
       case when length(text) < 130 then 'section_10' else 'section_8' end
         as expected_section,
       substring(text, 1, 4 + cast(item_id % 4 as int) * 2) as expected_answer, year
from (select item_id, text, 2018 as year from benchmark
      union all select item_id, text, 2019 from benchmark
      union all select item_id, text, 2020 from benchmark) asked"""


TABLES = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "benchmark": "item_id BIGINT, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def filings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = spark.sql(
        SEGMENTS.replace("from documents", "from {documents}"), documents=documents(spark, sf_dir)
    )
    return spark.sql(FILINGS_RAW.replace("from segments", "from {segments}"), segments=segments)


def filings_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = spark.sql(
        SEGMENTS.replace("from documents", "from {documents}"), documents=documents(spark, sf_dir)
    )
    return spark.sql(FILINGS_WIDE.replace("from segments", "from {segments}"), segments=segments)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return spark.sql(ITEMS.replace("from benchmark", "from {benchmark}"), benchmark=benchmark)
