"""The whole mix against a plain walk through each source in the order of its draws."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paperloom.llm import mixing, queries
from tests.llm import brute

pytestmark = pytest.mark.usefixtures("shared")


def copies_by_walk(rows, seed=mixing.SEED):
    """Copies of rows (doc_id, source, draw, size): down the draws, to where the words come nearest."""
    sizes = defaultdict(int)
    for _, source, _, size in rows:
        sizes[source] += size
    want = brute.targets(sizes)
    limit, whole = {}, {}
    for source, total in sizes.items():
        rate = min(3.0, want[source] / total) if total else 0.0
        whole[source] = int(rate)
        extra = (rate - int(rate)) * total
        grouped = defaultdict(int)
        for _, s, d, size in rows:
            if s == source and size:
                grouped[d] += size
        best, words = (extra, 0), 0
        if extra > 0:
            for d in sorted(grouped):
                words += grouped[d]
                best = min(best, (abs(words - extra), d + 1))
        limit[source] = best[1]
    return [whole[s] + (d < limit[s]) for _, s, d, _ in rows]


def drawn(docs, slices=None):
    draw = mixing.draw(F.lit(mixing.SEED), F.col("doc_id"), F.col("source"), F.col("text"))
    size = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0))
    return [tuple(r) for r in docs.select("doc_id", "source", draw, size).collect()]


@pytest.mark.parametrize("table", ["dirty", "documents"])
@pytest.mark.parametrize("bits", [33, 52])
def test_copies(request, table, bits, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 1 << bits)
    docs = request.getfixturevalue(table)
    rows = drawn(docs)
    expected = sorted(((i, s, n, c) for (i, s, _, n), c in zip(rows, copies_by_walk(rows))), key=repr)
    found = mixing.mix(docs).select("row.doc_id", "row.source", "size", "copies").collect()
    assert sorted(map(tuple, found), key=repr) == expected


def test_query_is_near_every_target(spark):
    """`taken` of the registered query strays by less than half of a source's longest document."""
    sf = "/root/testdata/sf0.01"
    found = queries.source_mix(spark, sf).collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    source = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect())
    taken, longest, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        assert r["taken"] <= 3 * r["size"]
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
        target[s] = r["target"]
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in target)
