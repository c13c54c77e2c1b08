"""Redirect rounds, reuse of older files and verdicts on fetched ones."""

import pytest
from pyspark.sql import functions as F

from paperloom.operators import fetch, lookup, upsert


def page(link):
    return f'<html><a href="/x">no</a><a id="redirect" href="{link}">go</a></html>'.encode()


PAGES = [
    ("u0", b"%PDF-1"), ("u1", page("u0")), ("u2", page("u1")), ("u3", page("u2")), ("u4", page("u3")), ("u5", page("u4")),
    ("u6", page("u5")), ("self", page("self")), ("ping", page("pong")), ("pong", page("ping")), ("end", b"<html></html>"),
    ("away", page("http://new?a=1&amp;b=2")), ("none", None), ("blank", b""),
]


@pytest.mark.parametrize("split", [False, True])
def test_redirect_plan(spark, request, split):
    if split:
        request.getfixturevalue("split_all")
    pages = spark.createDataFrame(PAGES, "url string, payload binary")
    starts = [*(u for u, _ in PAGES), "unknown", None] + ["u2"] * 20
    plan = spark.createDataFrame([(f"i{n}", u) for n, u in enumerate(starts)], "id string, url string")
    got = [(r["url"], r["last_url"], r["round"], r["outcome"]) for r in fetch.redirect_plan(plan, pages).collect()]
    assert len(got) == len(starts)
    assert set(got) == {
        ("u0", "u0", 0, "pdf"), ("u1", "u0", 1, "pdf"), ("u2", "u0", 2, "pdf"), ("u3", "u0", 3, "pdf"), ("u4", "u0", 4, "pdf"),
        ("u5", "u0", 5, "pdf"), ("u6", "u1", 5, "too_many"), ("self", "self", 0, "loop"), ("ping", "pong", 1, "loop"),
        ("pong", "ping", 1, "loop"), ("end", "end", 0, "end"), ("away", "http://new?a=1&b=2", 1, "fetch"), ("none", "none", 0, "end"),
        ("blank", "blank", 0, "end"), ("unknown", "unknown", 0, "fetch"), (None, None, 0, "fetch"),
    }
    short = fetch.redirect_plan(plan.where("url in ('u1', 'u3')"), pages, rounds=1).collect()
    assert {(r["url"], r["outcome"]) for r in short} == {("u1", "pdf"), ("u3", "too_many")}


def test_redirects_without_rows(spark):
    pages = spark.createDataFrame(PAGES, "url string, payload binary")
    none = spark.createDataFrame([], "id string, url string")
    assert fetch.redirect_plan(none, pages).count() == 0
    one = spark.createDataFrame([("a", "u1")], "id string, url string")
    assert [r["outcome"] for r in fetch.redirect_plan(one, pages.limit(0)).collect()] == ["fetch"]


ENTRIES = [
    ("both", "10.1/B", "ftp://old", True, False), ("nxml", "10.1/n", "ftp://old", True, False), ("fake", "10.1/f", "ftp://old", True, False),
    ("nolink", "10.1/b", "", False, False), ("done", "10.1/b", "ftp://old", True, True), ("lost", None, "ftp://old", True, False),
    ("nowhere", "10.1/x", "ftp://old", None, None),
]
LEGACY = [("both", "pdf", True), ("both", "nxml", False), ("nxml", "nxml", True), ("fake", "pdf", False), ("nolink", "pdf", True),
          ("done", "pdf", True), ("lost", "pdf", True), ("nowhere", "pdf", True), ("both", "pdf", False)]


def test_reuse_legacy(spark):
    entries = spark.createDataFrame(ENTRIES, "id string, doi string, oa_link string, has_valid_oa_url boolean, has_valid_pdf boolean")
    legacy = spark.createDataFrame(LEGACY, "id string, kind string, valid boolean")
    places = spark.createDataFrame([("10.1/b", "http://b"), ("10.1/n", "http://n"), ("10.1/f", "http://f"), ("10.1/x", None)], "doi string, url string")
    after, copies = lookup.reuse_legacy(entries, legacy, places, "/old/")
    got = {r["id"]: (r["oa_link"], r["has_valid_oa_url"], r["has_valid_pdf"]) for r in after.collect()}
    assert got == {
        "both": ("http://b", True, True), "nxml": ("http://n", True, False), "fake": ("ftp://old", True, False),
        "nolink": ("", False, False), "done": ("ftp://old", True, True), "lost": ("ftp://old", True, True),
        "nowhere": ("ftp://old", False, True)}
    assert sorted(map(tuple, copies.collect())) == sorted([
        ("both", "pdf", "/old/bo/th/both/both.pdf"), ("both", "nxml", "/old/bo/th/both/both.nxml"), ("nxml", "nxml", "/old/nx/ml/nxml/nxml.nxml"),
        ("lost", "pdf", "/old/lo/st/lost/lost.pdf"), ("nowhere", "pdf", "/old/no/wh/er/e/nowhere/nowhere.pdf")])


def test_flags_follow_content_and_stay(spark):
    entries = spark.createDataFrame([("a", False), ("b", False), ("c", True)], "id string, has_valid_pdf boolean")
    found = spark.createDataFrame([("a", "pdf", True), ("b", "pdf", False), ("c", "pdf", False), ("b", "pdf_tei", True)], "id string, kind string, valid boolean")
    got = {r["id"]: (r["has_valid_pdf"], r["has_valid_tei"]) for r in upsert.advance_flags(entries, found).collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (True, False)}


def test_verdicts_on_files(spark):
    entries = spark.createDataFrame([("a", False), ("b", False), ("c", True), ("d", False)], "id string, has_valid_pdf boolean")
    attempts = spark.createDataFrame(
        [("a", 0, "plain", True), ("b", 0, "plain", True), ("d", 0, "plain", False)], "id string, attempt_no int, transport string, ok boolean")
    verdicts = spark.createDataFrame([("a", True), ("b", False), ("d", True)], "id string, valid boolean")
    got = {r["id"]: (r["has_valid_pdf"], r["fetch_status"]) for r in fetch.apply_verdicts(entries, attempts, verdicts).collect()}
    assert got == {"a": (True, "success"), "b": (False, "invalid"), "c": (True, "none"), "d": (False, "failed")}
