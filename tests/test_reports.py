import random

from pyspark.sql import functions as F

from paperloom import sinks
from paperloom.operators import coverage, fetch, reports, upsert
from paperloom.sources.listings import artifact_index, index_official
from paperloom.values import FLAGS


def entries(spark, n, seed=1):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(f"e{i}", *[rng.choice([True, False, None]) for _ in FLAGS]) for i in range(n)],
        "id string, " + ", ".join(f"{f} boolean" for f in FLAGS))


def test_waterfall_identities(spark):
    for seed in range(3):
        row = reports.state_waterfall(entries(spark, 60, seed)).first()
        for step in ("url", "pdf", "tei"):
            assert row[f"n_valid_{step}"] + row[f"n_invalid_{step}"] == row["n_total"] == 60
        assert row["n_invalid_url"] <= row["n_invalid_pdf"] <= row["n_invalid_tei"]
        assert row["n_valid_tei"] == row["n_fully_valid"]


def collection(spark):
    release = spark.createDataFrame([
        (1, "u1", "s1", "PMC1", "10.1/1", "1", "http://1", "2020-01-01"), (2, "u1", "", "", "", "", "http://dup", "1999"),
        (3, "u2", "s2", "", "", "", "http://2", "2021"), (4, "u3", "", "", "10.1/3", "", "http://3", ""),
        (5, "", "", "", "", "", "http://4", "2020"), (6, None, "s9", "", "", "", "http://5", "2020"),
    ], "row_no long, cord_uid string, sha string, pmcid string, doi string, pubmed_id string, url string, publish_time string")
    official = index_official(spark.createDataFrame(
        [("x/pmc_json/PMC1.xml.json",), ("x/pdf_json/s1.json",), ("x/pdf_json/s2.json",), ("x/pdf_json/.json",)], "path string"))
    files = artifact_index(spark.createDataFrame(
        [("u1/u1.grobid.tei.xml", 1), ("u1/u1.json", 1), ("u3/u3.pub2tei.tei.xml", 1), ("u2/u2.nxml", 1), ("u3/u3.json", 1), ("u2/u2.json", 1)],
        "path string, size long"))
    return release, official, files


def test_coverage_and_its_identities(spark):
    release, official, files = collection(spark)
    rows = coverage.coverage_rows(release, official, files)
    got = reports.coverage_report(rows, release.agg(F.count("*").alias("n_rows"))).first().asDict()
    # Blank and missing uids are one article here.
    assert got["n_rows"] == 6 and got["n_distinct"] == 4 and got["n_duplicates"] == 2
    assert got["n_official"] == 2 and got["n_official_pmc"] == 1 and got["n_official_pdf"] == 2
    assert got["n_missed"] == got["n_official"] - got["n_harvested"] == 1
    assert got["n_any_tei"] == got["n_harvested"] + got["n_extra"] == 2
    assert [tuple(r) for r in coverage.missed(rows).collect()] == [("u2", "http://2")]
    assert [tuple(r) for r in coverage.extra(rows, "/d/").collect()] == [("u3", "10.1/3", "", "", "", "/d/u3/u3/u3.pub2tei.tei.xml")]
    assert coverage.both(rows).count() == 1


def test_collection_description(spark):
    release, _, files = collection(spark)
    row = sinks.collection_description(release, files, "n", "d", "v", "h").first()
    documents = row["documents"].asDict()
    # Rows without uid are left out here.
    assert (documents["total_entries"], documents["total_distinct_entries"], documents["total_harvested_entries"]) == (6, 3, 2)
    assert documents["distribution_entries_per_year"] == {"2020": 1, "2021": 1}
    assert documents["distribution_harvested_per_year"] == {"2020": 1, "2021": 1}


def test_identifier_integrity_counts_rows_without_entry(spark):
    id_map = spark.createDataFrame([("id", "a", "a"), ("doi", "x", "a"), ("id", "b", "b"), ("doi", "y", "b"), ("pmid", "z", "b")], "kind string, key string, id string")
    row = reports.identifier_integrity(id_map, spark.createDataFrame([("a",)], "id string")).first()
    assert tuple(row) == (2, 3)


def test_flags_only_advance(spark):
    held = artifact_index(spark.createDataFrame([("e0.pdf", True), ("e1.pdf", False), ("e2-thumb-small.png", True), ("e3-ref-annotations.json", True), ("e4.grobid.tei.xml", True)], "path string, valid boolean"))
    before = entries(spark, 30)
    after = upsert.advance_flags(before, held)
    both = before.alias("b").join(after.alias("a"), "id")
    assert both.where(" or ".join(f"(b.{f} and not a.{f})" for f in FLAGS)).isEmpty()
    got = {r["id"]: r for r in after.collect()}
    assert got["e0"]["has_valid_pdf"] and got["e2"]["has_valid_thumbnail"] and got["e3"]["has_valid_ref_annotation"] and got["e4"]["has_valid_tei"]


def test_select_failed(spark):
    rows = entries(spark, 200)
    core = upsert.select_failed(rows).count()
    assert core == rows.where("not coalesce(has_valid_oa_url and has_valid_pdf and has_valid_tei, false)").count()
    assert upsert.select_failed(rows, thumbnail=True).count() >= core


def test_fetch_plan_keeps_a_host_even(spark):
    todo = spark.range(4000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("https://one.host/"), "id").alias("oa_link"), F.lit(None).cast("boolean").alias("has_valid_pdf"))
    plan = fetch.fetch_plan(todo, lanes=64)
    assert plan.count() == 4000 and plan.select("host").distinct().count() == 1
    assert plan.groupBy("lane").count().agg(F.max("count")).first()[0] < 150
    placed = fetch.by_lane(plan).select("host", "lane", F.spark_partition_id().alias("task")).distinct()
    assert placed.groupBy("host", "lane").count().where("count > 1").isEmpty()


def test_fetch_results(spark):
    rows = spark.createDataFrame([("a", False), ("b", False), ("c", False), ("d", True), ("e", False)], "id string, has_valid_pdf boolean")
    attempts = spark.createDataFrame([("a", 0, "s", False), ("a", 1, "p", True), ("b", 0, "s", True), ("c", 0, "s", False), ("d", 0, "s", False)], "id string, attempt_no int, transport string, ok boolean")
    payloads = spark.createDataFrame([("a", b"%PDF-1"), ("b", b"<html>"), ("c", b"%PDF-1")], "id string, payload binary")
    got = {r["id"]: (r["has_valid_pdf"], r["fetch_status"]) for r in fetch.apply_fetch_results(rows, attempts, payloads).collect()}
    assert got == {"a": (True, "success"), "b": (False, "invalid"), "c": (False, "failed"), "d": (True, "failed"), "e": (False, "none")}
