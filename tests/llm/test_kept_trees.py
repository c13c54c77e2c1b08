"""Segment trees that are written and take batch after batch of edits."""

import random

import pytest
from pyspark.sql import functions as F

from paperloom.llm import edit_counts
from paperloom.llm.shared import stored
from paperloom.llm.tokens import tokenizer_path
from tests.llm import brute

pytestmark = pytest.mark.usefixtures("shared")
EDIT = "doc_id long, seq int, start long, end long, new string"


def put(text, start, end, new):
    start = max(0, min(start, len(text)))
    return text[:start] + (new or "") + text[max(start, min(end, len(text))):]


def test_batches_of_edits(spark, dirty):
    """Counts after each batch are those of the edited texts; only touched documents are encoded."""
    rnd = random.Random(3)
    texts = {r["doc_id"]: r["text"] or "" for r in dirty.where("doc_id >= 100 or doc_id < 6 or doc_id = 10").collect()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    trees = stored(edit_counts.build_trees(docs, tokenizer_path()), "trees")
    for _ in range(3):
        touched = rnd.sample(sorted(texts), 8)
        edits = []
        for seq in range(24):
            doc, at = rnd.choice(touched), rnd.randrange(0, 900)
            new = rnd.choice(["inter", "national ", " a b", "", None, "word " * 900])
            edits.append((doc, seq, at, at + rnd.choice([0, 3, 400]), new))
        before = dict(texts)
        for doc, _, start, end, new in edits:
            texts[doc] = put(texts[doc], start, end, new)
        # Dealt out of order, with edits that meet no document.
        rows = [*edits, (None, 0, 0, 9, "x"), (10**6, 0, 0, 9, "x")]
        changed = stored(edit_counts.edit_trees(
            trees, spark.createDataFrame(rnd.sample(rows, len(rows)), EDIT), tokenizer_path()), "changed")
        found = {r["doc_id"]: r for r in changed.collect()}
        assert set(found) == {e[0] for e in edits}
        for doc, r in found.items():
            assert "".join(r["parts"]) == texts[doc] and sum(r["tokens"]) == r["edited_tokens"]
            assert (r["n_tokens"], r["edited_tokens"]) == tuple(len(i) - 1 for i in brute.ids_of([before[doc], texts[doc]], 0))
            assert r["edited_chars"] == len(texts[doc]) and r["n_edits"] == sum(e[0] == doc for e in edits)
            assert len(r["parts"]) == 1 or all(r["parts"])
        trees = stored(edit_counts.put_trees(trees, changed), "trees")
        assert {r[0]: r[1] for r in trees.select("doc_id", F.array_join("parts", "")).collect()} == texts


def test_small_edits_of_long_texts_encode_little(spark):
    text = "some words of a long text " * 40_000
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    trees = stored(edit_counts.build_trees(docs, tokenizer_path()), "trees")
    edits = spark.createDataFrame([(1, i, 9_000 * i, 9_000 * i + 2, "ab") for i in range(50)], EDIT)
    row, = edit_counts.edit_trees(trees, edits, tokenizer_path()).collect()
    assert row["encoded_chars"] < 50 * 600 and row["edited_chars"] == len(text)


def test_null_ids_repeats_and_nothing(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, "a b"), (2, "")], "doc_id long, text string")
    trees = stored(edit_counts.build_trees(docs, tokenizer_path()), "trees")
    edits = spark.createDataFrame([(1, 0, None, None, "new "), (None, 0, 0, 9, "no")], EDIT)
    changed = stored(edit_counts.edit_trees(trees, edits, tokenizer_path()), "changed")
    assert sorted("".join(r["parts"]) for r in changed.collect()) == ["new ", "new a b"]
    after = edit_counts.put_trees(trees, changed).select("doc_id", F.array_join("parts", "")).collect()
    assert sorted(map(tuple, after), key=str) == [(1, "new "), (1, "new a b"), (2, ""), (None, "a b")]
    assert edit_counts.edit_trees(trees, edits.limit(0), tokenizer_path()).count() == 0
    assert edit_counts.build_trees(docs.limit(0), tokenizer_path()).count() == 0
