"""Whitespace, word windows and sections against hand-written and modelled results."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docspark import schemas
from docspark.functions import text as tx
from docspark.operators.chunk import chunk_raw, chunk_wide, chunk_words
from docspark.operators.sections import extract_sections

EDGE_FILINGS = [
    (
        "preamble\nPART I\nITEM 1.\nalpha beta\n gamma\nItem 1A.\nrisk text here\n"
        "ITEM 1. Business\nnot a header\nITEM 7\nmda \r\nmore\nitem 7a.\nlast section",
        [
            ("PART I", ""),
            ("ITEM 1", "alpha beta\n gamma"),
            ("ITEM 1A", "risk text here\nITEM 1. Business\nnot a header"),
            ("ITEM 7", "mda \r\nmore"),
        ],
    ),
    ("ITEM 1.\nfirst\nItem 1\nsecond\nPART II\nx\n", [("ITEM 1", "second")]),
    ("no headers", []),
    ("", []),
    (None, []),
    (
        "ITEM 1.\r\nwin\r\nITEM 2.\r\nprops\r\nITEM 3.\r\n",
        [("ITEM 1", "win"), ("ITEM 2", "props")],
    ),
    ("ITEM\n1.\nq\nITEM 2.", [("ITEM 1", "q")]),
    ("ITEM 1.\n\n\nITEM 2.\nz\nITEM 3.", [("ITEM 1", ""), ("ITEM 2", "z")]),
]


def sections_of(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    found = {i: [] for i in range(len(texts))}
    for r in extract_sections(rows, **options).orderBy("id", "section_pos").collect():
        found[r.id].append((r.section_title, r.section_text))
    return [found[i] for i in range(len(texts))]


def model_sections(text, keep_last=False):
    """Header positions first, then the text between them; the last of a title counts."""
    header = re.compile(r"^(?:ITEM\s+\d+[A-Z]?\.?|PART\s+[IVXLCDM]+)(?=\s*$)", re.I | re.M)
    marks = [(m.start(), m.end()) for m in header.finditer(text)]
    ends = [start for start, _ in marks[1:]] + ([len(text)] if keep_last else [])
    found = {}
    for (start, stop), end in zip(marks, ends):
        title = " ".join(text[start:stop].split()).strip(".").upper()
        found.pop(title, None)
        found[title] = text[stop:end].strip()
    return list(found.items())


def test_whitespace_is_what_python_calls_space(spark):
    assert set(tx.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    chars = spark.createDataFrame([(chr(c),) for c in range(1, 0x4000)], "c STRING")
    spaces = chars.where(F.regexp_like("c", F.lit(rf"\A{tx.WS}\z"))).collect()
    assert {r.c for r in spaces} == set(tx.WHITESPACE)
    assert chars.where(tx.collapse(F.col("c")) == "").count() == len(tx.WHITESPACE)


@pytest.mark.parametrize("case", range(len(EDGE_FILINGS)))
def test_section_edges(spark, case):
    text, expected = EDGE_FILINGS[case]
    assert sections_of(spark, [text]) == [expected]


def test_keep_last(spark):
    texts = ["ITEM 1.\none\nITEM 2\ntwo", "x\nITEM 3"]
    assert sections_of(spark, texts, keep_last=True) == [
        [("ITEM 1", "one"), ("ITEM 2", "two")],
        [("ITEM 3", "")],
    ]


def test_inline_titles(spark):
    text = "ITEM 1. Business\nwe sell\nItem 1A Risk Factors\nmany\nITEMS 12\nITEM 2.\nend"
    assert sections_of(spark, [text], inline_titles=True) == [
        [("ITEM 1", "we sell"), ("ITEM 1A", "many\nITEMS 12")]
    ]


def test_sections_equal_model_on_random_texts(spark):
    rng = random.Random(3)
    parts = [
        "ITEM 1.", "Item 1A", "item 7a.", "PART II", "Part iv", "ITEM\n2.", "PART I",
        "ITEM 3. Title", " ITEM 4", "word", "two words", "", "\t", "\r", " ", "\x1c",
        "\x85", "PART mix", "ITEM", "12", "ıtem 5",
    ]
    texts = [
        "".join(rng.choice(parts) + rng.choice(["\n", "\n", "\n\n", "\r\n", " "]) for _ in range(n))
        for n in range(200)
    ]
    for keep_last in (False, True):
        expected = [model_sections(t, keep_last) for t in texts]
        assert sections_of(spark, texts, keep_last=keep_last) == expected


def chunks_of(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    found = {i: [] for i in range(len(texts))}
    for r in chunk_words(rows, **options).orderBy("id", "chunk_index").collect():
        found[r.id].append((r.chunk_index, r.chunk_text))
    return [found[i] for i in range(len(texts))]


def test_chunk_edges(spark):
    texts = ["  a b  c d e f g ", "a b c", "", "   ", None, "a b c\x1cd"]
    assert chunks_of(spark, texts, size=3) == [
        [(0, "a b c"), (1, "d e f"), (2, "g")],
        [(0, "a b c")],
        [],
        [],
        [],
        [(0, "a b c"), (1, "d")],
    ]


@pytest.mark.parametrize("size,overlap", [(1, 0), (7, 0), (500, 0), (5, 2), (4, 3)])
def test_chunks_equal_model_on_random_texts(spark, size, overlap):
    rng = random.Random(size)
    gaps = [" ", "  ", "\n", "\t \r\n", *tx.WHITESPACE]
    words = ["a", "bc", "Ünïcode", "x.", "​", "日本", "😀"]
    texts = [
        "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n)) for n in range(0, 60)
    ] + [" ".join(rng.choice(words) for _ in range(1203))]
    step = size - overlap

    def model(text):
        split = text.split()
        starts = range(0, len(split), step)
        return [(n, " ".join(split[i : i + size])) for n, i in enumerate(starts)]

    assert chunks_of(spark, texts, size=size, overlap=overlap) == [model(t) for t in texts]


def test_long_text_and_large_window(spark):
    rows = spark.range(1).select(F.repeat(F.lit("word "), 300_000).alias("text"))
    sizes = chunk_words(rows, size=100_000).select(F.size(F.split("chunk_text", " ")).alias("n"))
    assert [r.n for r in sizes.collect()] == [100_000] * 3


def test_window_arguments(spark):
    for size, overlap in [(0, 0), (3, 3), (3, -1)]:
        with pytest.raises(ValueError):
            tx.word_windows(F.col("text"), size, overlap)


def types_of(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_chunk_raw_names_types_and_empty_sections(spark):
    text = "PART I\nITEM 1.\na b c d\nITEM 2.\nlost"
    rows = spark.createDataFrame(
        [("7", "Seven", "10-K", 2020, text)],
        "cik STRING, company_name STRING, filing_type STRING, year INT, text STRING",
    )
    chunks = chunk_raw(rows, size=3)
    assert types_of(chunks.schema) == types_of(schemas.RAW_CHUNK)
    assert [tuple(r) for r in chunks.orderBy("chunk_index").collect()] == [
        ("7", "Seven", "10-K", 2020, "ITEM 1", "a b c", 0),
        ("7", "Seven", "10-K", 2020, "ITEM 1", "d", 1),
    ]


def test_chunk_wide_ids_and_skipped_sections(spark):
    columns = ["section_1", "section_1A", "section_7", "section_8", "section_10", "section_2"]
    rows = spark.createDataFrame(
        [("f.htm", "7", 2020, "a b c", None, " \n", "d", "e", "unused")],
        "filename STRING, cik STRING, year INT, " + ", ".join(f"{c} STRING" for c in columns),
    )
    chunks = chunk_wide(rows, size=2)
    assert types_of(chunks.schema) == types_of(schemas.WIDE_CHUNK)
    chunks = chunks.orderBy("section_pos", "chunk_index").collect()
    assert [(r.chunk_id, r.text, r.section_pos) for r in chunks] == [
        ("f.htm_section_1_0", "a b", 0),
        ("f.htm_section_1_1", "c", 0),
        ("f.htm_section_8_0", "d", 3),
        ("f.htm_section_10_0", "e", 4),
    ]


def test_preview(spark):
    row = spark.createDataFrame([("x" * 300, "short")], "a STRING, b STRING").select(
        tx.preview(F.col("a"), 200).alias("a"), tx.preview(F.col("b"), 200).alias("b")
    ).first()
    assert row.a == "x" * 200 + "..." and row.b == "short..."


def test_text_operators_run_on_a_stream(spark, tmp_path):
    """All of them are row-local, so an arriving folder of filings needs nothing else."""
    text = "ITEM 1.\na b c d\nITEM 2.\nlost"
    rows = [("7", "Seven", "10-K", 2020, text)]
    schema = "cik STRING, company_name STRING, filing_type STRING, year INT, text STRING"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = chunk_raw(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), size=3)
    run = stream.writeStream.format("memory").queryName("chunks").start()
    run.processAllAvailable()
    run.stop()
    assert spark.table("chunks").count() == 2
