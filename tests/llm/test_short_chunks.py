"""Shingles of texts that are shingled alone, with fewer words than a shingle."""

import pytest

from paperloom.llm import minhash
from tests.llm import brute

pytestmark = pytest.mark.usefixtures("shared")


@pytest.mark.parametrize("width", [3, 5])
@pytest.mark.parametrize("n", range(7))
def test_chunk_of_few_words(width, n):
    text = " ".join(f"w{i}" for i in range(n))
    alone = list(minhash.shingle_sets([text], width))
    assert [len(s) for s in alone] == [len(brute.shingles(text, width))]
    beside = list(minhash.shingle_sets(["many other words that stand before it", text], width))[1]
    assert alone[0].tolist() == beside.tolist()


def test_few_words_behind_a_long_text(monkeypatch):
    monkeypatch.setattr(minhash, "TEXT_BYTES", 20)
    texts = ["a text that is longer than a whole chunk may be", "two words", None, "", "now three words"]
    assert [len(s) for s in minhash.shingle_sets(texts, 5)] == [len(brute.shingles(t, 5)) for t in texts]


def test_keep_one_of_a_short_table(spark):
    docs = spark.createDataFrame([(2, "two words"), (1, "Two  words")], "doc_id long, text string").repartition(2)
    assert [r["doc_id"] for r in minhash.keep_one(docs).collect()] == [1]
