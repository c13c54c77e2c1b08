"""Snapshots that several updates share are derived once; an update without new rows reads none of them."""

from dataclasses import fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.queries import Views
from paperloom.plans import ingest_release, keep_snapshots

SF = "/root/testdata/sf0.001"


def guarded(table, reads):
    """`table`, whose reading adds to `reads`."""
    return table.where(F.udf(lambda: reads.add(1) or True, "boolean").asNondeterministic()())


def test_kept_snapshots_are_not_derived_again(spark):
    v, reads = Views(spark, SF), spark.sparkContext.accumulator(0)
    plain = v.snapshots
    narrow = replace(plain, **{n: guarded(getattr(plain, n), reads) for n in ("legacy", "pub_map", "pmc_oa", "locations")})
    kept, made = keep_snapshots(narrow), reads.value
    done = ingest_release(v.entries, v.id_map, v.meta, kept)
    wanted = ingest_release(v.entries, v.id_map, v.meta, plain)
    assert made > 0 and reads.value == made
    assert sorted(done.keys.collect()) == sorted(wanted.keys.collect())
    columns = [c for c in wanted.changed.columns if c != "raw"]
    assert done.changed.select(columns).exceptAll(wanted.changed.select(columns)).isEmpty()
    assert done.changed.count() == wanted.changed.count() > 0


def test_an_update_without_new_rows_reads_no_snapshot(spark):
    v, reads = Views(spark, SF), spark.sparkContext.accumulator(0)
    once = ingest_release(v.entries, v.id_map, v.meta, v.snapshots)
    blank = v.meta.limit(3).withColumns({c: F.lit("") for c in ("cord_uid", "doi", "pmcid", "pubmed_id")})
    blank = blank.withColumn("row_no", F.col("row_no") + 1_000_000)
    watched = replace(v.snapshots, **{
        f.name: guarded(getattr(v.snapshots, f.name), reads) for f in fields(v.snapshots)
        if isinstance(getattr(v.snapshots, f.name), DataFrame)})
    again = ingest_release(once.entries(v.entries), once.id_map(v.id_map), v.meta.unionByName(blank), watched)
    assert again.changed.count() == again.keys.count() == reads.value == 0
    assert (again.changed.columns, again.keys.columns) == (once.changed.columns, once.keys.columns)
    assert again.errors.count() == 3
