"""Declared table layouts; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Item numbers of the section columns of a wide filing.
SECTION_ITEMS = (
    "1", "1A", "1B", "2", "3", "4", "5", "6", "7", "7A", "8", "9", "9A", "9B",
    "10", "11", "12", "13", "14", "15",
)
SECTION_COLUMNS = tuple(f"section_{item}" for item in SECTION_ITEMS)


_TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType()}


def _struct(fields: str) -> T.StructType:
    """``name TYPE, …`` without a running session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_FILING = _struct(
    "cik STRING, company_name STRING, filing_type STRING, year INT, text STRING"
)

WIDE_FILING = _struct(
    "filename STRING, cik STRING, year INT, "
    + ", ".join(f"{name} STRING" for name in SECTION_COLUMNS)
)

RAW_CHUNK = _struct(
    "cik STRING, company_name STRING, filing_type STRING, year INT, "
    "section_title STRING, chunk_text STRING, chunk_index INT"
)

WIDE_CHUNK = _struct(
    "text STRING, year INT, cik STRING, filename STRING, section STRING, "
    "section_pos INT, chunk_index INT, chunk_id STRING"
)

QUERY = _struct("query_id INT, query STRING, year INT")

SEARCH_HIT = _struct(
    "query_id INT, rank INT, chunk STRING, full_text STRING, year INT, cik STRING, "
    "filename STRING, section STRING, chunk_id STRING, similarity_score DOUBLE"
)

VALIDATION_ITEM = _struct(
    "item_id INT, query STRING, expected_section STRING, expected_answer STRING, "
    "year INT, cik STRING"
)
