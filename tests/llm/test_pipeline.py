"""Every stage of the pipeline against plain Python, on the rows that the stage before has kept."""

import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperloom.llm import shared as helpers
from paperloom.runtime import fresh_path
from tests.llm import brute
from tests.llm.test_mix_draws import copies_by_walk, drawn

pytestmark = pytest.mark.usefixtures("shared")
SF = "/root/testdata/sf0.001"
BASE = ("doc_id", "text", "source")


def rows_of(df):
    return [tuple(r) for r in df.select(*BASE).collect()]


def good(rows):
    hosts = defaultdict(list)
    failed = []
    for _, text, source in rows:
        m = brute.measures(text)
        failed.append(m[0] < 50 or 100 * m[4] > 50 * m[0])
        hosts[source].append(failed[-1])
    verdicts = brute.host_verdicts({h: (len(f), sum(f)) for h, f in hosts.items()}) if hosts else {}
    return [r for r, bad in zip(rows, failed) if not bad and verdicts[r[2]][1]]


def cleaned(rows):
    texts = brute.boilerplate_free([(text, source) for _, text, source in rows])
    return [(r[0], t, r[2]) for r, t in zip(rows, texts)]


def groups_of(rows):
    """Group number per row; rows without words are groups of their own."""
    _, links = brute.near_links([t for _, t, _ in rows], 5, 80)
    return brute.groups(len(rows), links)


def check_near(before, after):
    roots, left = groups_of(before), Counter(after)
    assert not left - Counter(before)
    by_root = defaultdict(list)
    for row, root in zip(before, roots):
        by_root[root].append(row)
    expected = Counter()
    for members in by_root.values():
        first = min((m[0] for m in members if m[0] is not None), default=None)
        choices = [m for m in members if m[0] == first]
        kept = [m for m in choices if left[m] > expected[m]]
        assert kept, members
        expected[kept[0]] += 1
    assert left == expected


def check_mix(docs, after):
    rows = drawn(docs)
    want = Counter()
    for row, n in zip([tuple(r) for r in docs.select(*BASE).collect()], copies_by_walk(rows)):
        want[row] += n
    assert Counter(after) == +want


def check_packed(rows, pieces):
    expected = Counter((doc, zlib.crc32(np.array(ids, "<u4").tobytes())) for (doc, _, _), ids in zip(rows, brute.ids_of([t for _, t, _ in rows], 1)))
    total = Counter(doc for doc, _, _ in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(int)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]] += p["length"]
    assert set(by_doc) == set(total) and all(n <= 2048 for n in by_sequence.values())
    for doc, own in by_doc.items():
        own.sort(key=lambda p: p["start"])
        if total[doc] == 1:
            whole = b"".join(p["ids"] for p in own)
            assert (doc, zlib.crc32(whole)) in expected and len(whole) == 4 * own[0]["doc_tokens"]


@pytest.mark.parametrize("table", ["dirty", "documents"])
def test_stages(spark, request, table):
    docs = request.getfixturevalue(table).limit(10_000)
    columns = docs.columns
    for name, work in corpus_pipeline.STAGES:
        before = rows_of(docs)
        path = fresh_path(spark, "stage")
        out = work(spark, docs, SF)
        out.write.parquet(path)
        given, docs = docs, spark.read.parquet(path)
        if name == "packing":
            check_packed(before, docs.collect())
            continue
        assert docs.columns == columns
        after = rows_of(docs)
        if name == "quality rules":
            assert sorted(after, key=repr) == sorted(good(before), key=repr)
        elif name == "line dedup":
            assert sorted(after, key=repr) == sorted(cleaned(before), key=repr)
            assert docs.where("n_chars is distinct from char_length(text)").isEmpty()
        elif name == "near dedup":
            check_near(before, after)
        else:
            check_mix(given, after)


@pytest.mark.parametrize("nothing", ["no rows", "null texts"])
def test_stages_of_nothing(spark, dirty, nothing):
    docs = dirty.limit(0) if nothing == "no rows" else dirty.withColumn("text", F.lit(None).cast("string"))
    for _, work in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage")
        work(spark, docs, SF).write.parquet(path)
        assert spark.read.parquet(path).columns


def test_run_and_what_it_leaves(spark):
    """The registered query; of the tables on the way, only those of the last stage are left."""
    before = set(helpers.SCRATCH)
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.count() > 0
    added = [p for p in helpers.SCRATCH if p not in before]
    assert added == [p for p in corpus_pipeline._LEFT if p in added]
    assert all(os.path.isdir(p.removeprefix("file:")) for p in added)
