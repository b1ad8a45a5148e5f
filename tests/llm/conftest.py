import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"
# Names that operators might use for columns of their own.
CLASHING = ("n_words", "kept", "label", "cls", "key", "piece", "bucket", "rank", "first", "_doc", "_gone", "row")


@pytest.fixture
def docs_of(spark):
    """A table of documents with further columns of unfortunate names."""

    def make(rows, clashing=True):
        extra = CLASHING if clashing else ()
        schema = "doc_id long, text string" + "".join(f", `{c}` string" for c in extra)
        return spark.createDataFrame([(*r, *(["x"] * len(extra))) for r in rows], schema).repartition(3)

    return make
