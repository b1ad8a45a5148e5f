"""The pipeline's stages on planted documents, and its contract."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline


def clean(i, n=60):
    return " ".join(f"w{(i * 131 + k * k * 7) % 4999}q{i}" for k in range(n))


@pytest.fixture
def folder(spark, tmp_path):
    leak = " ".join(f"secret{k}" for k in range(30))
    menu = "\nHome About Contact"
    rows = [(i, clean(i) + (menu if i < 20 else "")) for i in range(60)]
    rows += [(100 + i, " ".join(f"x{i}{k}###" for k in range(40))) for i in range(30)]
    rows += [(200, clean(7)), (201, clean(8) + " one more"), (300, clean(300) + "\n" + leak), (400, None), (401, "")]
    rows += [(500, " ".join(f"long{k}" for k in range(3000)))]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    labels = [(i, 1, 0) for i in range(50)] + [(100 + i, 0, 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == columns
            out[name] = {r.doc_id: r for r in docs.collect()}
    good = {*range(60), 200, 201, 300, 500}
    assert set(out["quality_rules"]) == good
    lined = out["line_dedup"]
    assert set(lined) == good
    assert all(lined[i].text == clean(i) and lined[i].n_chars == len(clean(i)) for i in range(60))
    assert set(out["near_dedup"]) == good - {200, 201}
    assert set(out["decontamination"]) == good - {200, 201, 300}

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = docs.collect()
    sequences = defaultdict(list)
    for r in rows:
        ids = [*exact.encode(out["decontamination"][r.doc_id].text, add_special_tokens=False).ids, 0]
        part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {r.doc_id for r in rows} == good - {200, 201, 300}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_equals_the_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder).where("piece = 0").count() == 61
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_empty_tables(spark, folder, tmp_path):
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).collect() == []
