"""A host's pages without a text are pages too."""

import pytest

from paperloom.llm import site_lines
from tests.llm import brute

pytestmark = pytest.mark.usefixtures("shared")


def test_null_texts_count_as_pages(spark):
    """A line on 6 of 100 pages stays, though it is on 6 of the 50 that have a text; one on 11 goes."""
    texts = [f"body {i}" + "\nsix" * (i < 6) + "\neleven" * (i >= 39) for i in range(50)]
    rows = [(t, host) for host in ("h", None) for t in [*texts, *[None] * 50]]
    rows += [(t, "without nulls") for t in texts]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string").repartition(3)
    found = {r["row"]["doc_id"]: r["text"] for r in site_lines.drop_boilerplate(docs).collect()}
    assert [found[i] for i in range(len(rows))] == brute.boilerplate_free(rows)
    assert found[0] == "body 0\nsix" and found[49] == "body 49" and found[200] == "body 0"
