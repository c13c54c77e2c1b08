"""An update over kept snapshots derives no index of links; the wide rows of a release are written once."""

from dataclasses import replace

from pyspark.sql import functions as F

from checks.queries import Views
from paperloom.plans import ingest, ingest_release, keep_snapshots
from paperloom.schemas import ENTRY

SF = "/root/testdata/sf0.001"


def plain(rows):
    """`rows` as a sorted list; the open record as text."""
    return sorted(map(repr, rows.withColumn("raw", F.to_json("raw")).collect()))


def test_kept_links_spare_every_source(spark):
    v, reads = Views(spark, SF), spark.sparkContext.accumulator(0)
    watched = replace(v.snapshots, pub_files=v.pub_files.where(
        F.udf(lambda: reads.add(1) or True, "boolean").asNondeterministic()()))
    kept, made = keep_snapshots(watched), reads.value
    done = ingest_release(v.entries, v.id_map, v.meta, kept)
    assert made > 0 and reads.value == made
    wanted = ingest_release(v.entries, v.id_map, v.meta, v.snapshots)
    assert plain(done.changed) == plain(wanted.changed)


def test_wide_rows_are_written_once(spark, monkeypatch):
    v, wide = Views(spark, SF), []

    def noted(df, name, write=ingest.written):
        if {"title", "abstract"} <= set(df.columns):
            wide.append(name)
        return write(df, name)

    monkeypatch.setattr(ingest, "written", noted)
    done = ingest_release(v.entries, v.id_map, v.meta, v.snapshots)
    assert wide == ["changed"]
    assert done.changed.columns == ENTRY.names and done.changed.where("abstract is not null").count() > 0


def test_entries_are_read_for_known_rows_alone(spark):
    v, reads = Views(spark, SF), spark.sparkContext.accumulator(0)
    title = F.udf(lambda i: reads.add(1) or f"title of {i}", "string")
    entries = v.entries.withColumn("title", title("id"))
    ids = [r["id"] for r in v.entries.orderBy("id").limit(2).collect()]

    none = ingest_release(entries, v.id_map, v.meta, v.snapshots)
    assert none.changed.join(v.entries, "id", "left_semi").isEmpty() and reads.value == 0
    # A map that lacks the ids of two entries: their rows are taken again.
    known = v.meta.limit(2).withColumns({
        "cord_uid": F.when(F.col("row_no") == F.lit(v.meta.limit(2).agg(F.min("row_no")).first()[0]), ids[0]).otherwise(ids[1]),
        "doi": F.lit(""), "pmcid": F.lit(""), "pubmed_id": F.lit("")})
    some = ingest_release(entries, v.id_map.where(~F.col("id").isin(ids)), known, v.snapshots)
    assert {r["id"]: r["title"] for r in some.changed.collect()} == {i: f"title of {i}" for i in ids}
