"""Filing scans and the delimited-text sink."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docspark import schemas
from docspark.params import NA_TOKENS


def spread(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer pieces than the session has cores.

    One small or unsplittable file would otherwise keep the row-local text work in one
    task; a scan with enough pieces stays as it is, so large tables are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def conform(df: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns by name and type; absent ones and bad values are null.

    A column of ``required`` that is absent is an error.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    if absent := [name for name in required if name not in found]:
        raise ValueError(f"the table has no column {', '.join(absent)}")
    columns = []
    for field in schema.fields:
        column = F.col(field.name) if field.name in found else F.lit(None)
        if found.get(field.name) != field.dataType:
            column = column.try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def read_raw(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    year: int | None = None,
    split: str | None = None,
) -> DataFrame:
    """Filings with one text column; year and split become scan filters.

    Parquet knows its types, and a table without ``cik``, ``year`` or ``text`` is an error;
    JSON is read as text and cast, so nothing is inferred.
    """
    schema = schemas.RAW_FILING
    if split is not None:
        schema = T.StructType([*schema.fields, T.StructField("split", T.StringType())])
    reader = spark.read.format(fmt)
    if fmt != "parquet":
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in schema.names]))
    df = reader.load(path)
    needed = ("cik", "year", "text", *(["split"] if split is not None else []))
    df = conform(df if year is None else _in_years(df, [year]), schema, needed)
    if split is not None:
        df = df.where(F.col("split") == split).drop("split")
    return df


def read_wide(
    spark: SparkSession,
    path: str,
    *,
    cik: str | int | None = None,
    years: list[int] | None = None,
) -> DataFrame:
    """Filings with one column per section.

    Every ``section_*`` column of the table is kept, as text; declared sections that it
    lacks are null.  A table without ``filename``, ``cik`` or ``year`` is an error.
    """
    df = spark.read.parquet(path)
    more = [c for c in df.columns if c.startswith("section_") and c not in schemas.WIDE_FILING.names]
    schema = T.StructType(
        [*schemas.WIDE_FILING.fields, *[T.StructField(c, T.StringType()) for c in more]]
    )
    return conform(filter_cik_years(df, cik, years), schema, ("filename", "cik", "year"))


def filter_cik_years(
    df: DataFrame, cik: str | int | None = None, years: list[int] | None = None
) -> DataFrame:
    """Keep one company and some years; ``None`` keeps all.

    Values are compared in the type that the table has, so that the comparison reaches the
    scan.
    """
    if cik is not None:
        column, value = F.col("cik"), str(cik)
        if isinstance(df.schema["cik"].dataType, T.IntegralType):
            # Another spelling of a number, such as 007, is the text of no number.
            same = value.lstrip("-").isdecimal() and str(int(value)) == value
            df = df.where(column == int(value)) if same else df.where(F.lit(False))
        elif isinstance(df.schema["cik"].dataType, T.StringType):
            df = df.where(column == value)
        else:
            df = df.where(column.cast("string") == value)
    return df if years is None else _in_years(df, years)


def _in_years(df: DataFrame, years: list[int]) -> DataFrame:
    column = F.col("year")
    if not isinstance(df.schema["year"].dataType, T.IntegralType):
        column = column.try_cast("int")
    values = [int(y) for y in years]
    return df.where(column == values[0]) if len(values) == 1 else df.where(column.isin(values))


def missing_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Texts that stand for "missing" become null; blanks stay.

    The rule is one of delimited text, see :func:`read_csv`; on other tables it applies to
    the sections unless columns are named, so that filters on the rest still reach the scan.
    """
    if columns is None:
        columns = [c for c in df.columns if c.startswith("section_")]
    tokens = ", ".join(f"'{token}'" for token in NA_TOKENS)
    return df.withColumns(
        {c: F.expr(f"CASE WHEN `{c}` NOT IN ({tokens}) THEN `{c}` END") for c in columns}
    )


_CSV = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide filings from delimited text.

    Columns are taken by header name, file by file, so their order and the set of sections
    are free; a column that a file lacks is null there.  A file with quoted line breaks
    cannot be split, so one file is one task: this is the import format, and large tables
    belong in Parquet.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for paths in _alike(spark, path):
        header = spark.read.options(**_CSV).csv(paths[0]).columns
        by_header.setdefault(tuple(header), []).extend(paths)
    text = None
    for paths in by_header.values():
        part = spark.read.options(**_CSV).csv(paths)
        text = part if text is None else text.unionByName(part, allowMissingColumns=True)
    if text is None:
        text = spark.read.options(**_CSV).csv(path)
    text = missing_to_null(text, text.columns)
    if "year" in text.columns:
        text = text.withColumn("year", F.col("year").try_cast("double").try_cast("int"))
    return text


def _alike(spark: SparkSession, path: str) -> list[list[str]]:
    """Files in groups that begin with the same line; all first lines come from one distributed pass.

    Files whose first line ends inside quotes are groups of their own.
    """
    place = F.col("_metadata")
    lines = spark.read.option("recursiveFileLookup", "true").text(path).where("value <> ''")
    starts = lines.where(place["file_block_start"] == 0).select(place["file_path"].alias("file"), "value")
    # Only one task reads the beginning of a file, and reads it in order.
    heads = starts.groupBy("file").agg(F.first("value").alias("head")).orderBy("file")
    groups: dict[str, list[str]] = {}
    for row in heads.toLocalIterator():
        alike = row.head if row.head.count('"') % 2 == 0 else f"{row.head}\n{row.file}"
        groups.setdefault(alike, []).append(unquote(row.file))
    return list(groups.values())


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**{**_CSV, "emptyValue": ""}).csv(path)


def write_table(
    df: DataFrame, path: str, *, partition_by: str | None = None, mode: str = "errorifexists"
) -> None:
    """Parquet sink; partition filings by year so that year filters skip directories."""
    writer = df.write.mode(mode)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
