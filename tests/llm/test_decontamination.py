"""Decontamination against plain Python over word lists."""

import hashlib
import re
import string

import duckdb
import pytest
from pyspark.sql import functions as F

from paperloom.llm import decontamination, queries

pytestmark = pytest.mark.usefixtures("shared")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
PASSAGE = "The Quick brown fox, jumps over the lazy dog; and then RUNS home Été 42"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, tests, window=10):
    """[(doc_id, n_words, hit places, ids)] of rows (doc_id, text), tests being rows (item_id, text)."""
    windows = {}
    for item, text in tests:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i:i + size])):
                    hit |= set(range(i, i + size))
                    items |= found
        out.append((doc, len(w), sorted(hit), sorted(str(i) for i in items if i is not None)))
    return out


def item_rows(docs):
    rows = [(i, PASSAGE) for i in (7, 7, 30)] + [(1, None), (2, " ,; "), (3, "one"), (None, "gamma delta"), (5, "a b c a b c a b c a b")]
    longest = max((t for _, t in docs if t), key=len)
    rows += [(8, " ".join(longest.split()[50:9000])), (9, "alpha3 BETA alpha4"), (10, "word1 thing1")]
    return rows + [(100 + i, t) for i, (_, t) in enumerate(docs[:6])]


def text_rows(dirty):
    rows = [(r["doc_id"], r["text"]) for r in dirty.select("doc_id", "text").collect()]
    rows += [(900, f"start {PASSAGE.upper()} mid {PASSAGE.replace(' ', '-')} end"), (901, PASSAGE[4:60]), (902, PASSAGE + "x")]
    return rows + [(903, "the quick BROWN fox jumps\nover the lazy dog and then"), (904, "a b c a b c a b c a b c a b")]


def scanned(df):
    return sorted(((r["row"]["doc_id"], r["n_words"], [i for s in r["spans"] for i in range(s["start"], s["end"])], r["items"])
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("part_words", [50, 5000, 1 << 20])
@pytest.mark.parametrize("group_words", [7, 1 << 18])
def test_scan(spark, dirty, monkeypatch, part_words, group_words):
    monkeypatch.setattr(decontamination, "GROUP_WORDS", group_words)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 600)
    docs = text_rows(dirty)
    if group_words == 7 or part_words == 50:
        docs = [(i, t if t is None or len(t) < 5000 else t[:5000]) for i, t in docs]
    tests = item_rows(docs)
    benchmark = spark.createDataFrame(tests, "item_id long, text string").withColumn("spans", F.lit(1))
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as spans", "3 as items", "4 as n_words")
    found = decontamination.scan(df.repartition(2), benchmark, part_words=part_words)
    expected = brute(docs, tests)
    assert scanned(found) == sorted(expected, key=repr)
    assert sum(bool(hit) for _, _, hit, _ in expected) > 10


def test_spans_are_apart_and_cut_out(spark):
    docs = [(0, f"Before. {PASSAGE}! {PASSAGE} after"), (1, "nothing here"), (2, None), (3, PASSAGE), (4, "éé " + PASSAGE[4:])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    found = decontamination.scan(df, tests)
    spans = {r["row"]["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found.collect()}
    assert spans == {0: [(1, 31)], 1: [], 2: [], 3: [(0, 15)], 4: [(1, 15)]}
    left = {r["row"]["doc_id"]: r["text"] for r in decontamination.remove_spans(found).collect()}
    assert left == {0: "Before.  after", 1: "nothing here", 2: None, 3: "", 4: "éé "}
    assert sorted(r["doc_id"] for r in decontamination.remove_documents(found).collect()) == [1, 2]


def test_codes_that_collide_are_verified(monkeypatch):
    monkeypatch.setattr(decontamination, "window_codes", lambda codes, size: codes[:max(0, len(codes) - size + 1)] % 2 if size > 1 else codes)
    tests = decontamination.hash_set([("1", [b"a", b"b"])], 10)
    numbers = decontamination.numbers_of(b"a c b b a b", tests.numbers)
    assert [p.tolist() for _, p, _ in decontamination.hits(tests, numbers)] == [[4]]


def test_empty_tables(spark, no_rows, dirty):
    tests = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    assert decontamination.scan(no_rows, tests).count() == 0
    none = decontamination.scan(dirty, tests.limit(0))
    assert none.where("size(spans) > 0").count() == 0 and none.count() == dirty.count()


def test_query_equals_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    found = sorted(tuple(r) for r in queries.benchmark_hits(spark, sf).collect())
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    assert found == sorted(con.execute(queries.ORACLES["op12_benchmark_hits"]).fetchall())
    read = con.execute("select doc_id, text from documents").fetchall(), con.execute("select item_id, text from benchmark").fetchall()
    expected = [(d, n, len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)) for d, n, hit, ids in brute(*read)]
    assert found == sorted(expected) and any(r[-1] for r in found) and not all(r[-1] for r in found)
