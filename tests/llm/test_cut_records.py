"""Record files that end too early, exactly behind a record."""

import os

import numpy as np
import pytest

from paperloom.llm import records
from paperloom.llm.tokens import tokenizer_path

pytestmark = pytest.mark.usefixtures("shared")


@pytest.mark.parametrize("kind,seed", [("records", None), ("index", 7)])
def test_file_cut_at_a_border(spark, tmp_path, kind, seed):
    path = str(tmp_path / "cut")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string").coalesce(1)
    records.write_records(docs, path, tokenizer_path(), 2)
    assert records.read_records(spark, path, seed).count() == 9
    index = max((tmp_path / "cut").glob("*.index"), key=os.path.getsize)
    last = np.frombuffer(index.read_bytes(), "<u8").reshape(-1, 2)[-1]
    os.truncate(index.with_suffix(f".{kind}"), int(last[0]) if kind == "records" else index.stat().st_size - 16)
    with pytest.raises(Exception, match="records and"):
        records.read_records(spark, path, seed).collect()
