"""The running waterfall: signed differences against a full count after each batch."""

import numpy as np
from pyspark.sql import functions as F

from paperloom import streaming
from paperloom.operators.dedup import last_wins
from paperloom.operators.reports import flag_classes, state_waterfall, waterfall_of
from paperloom.streaming import releases

SCHEMA = "id string, has_valid_oa_url boolean, has_valid_pdf boolean, has_valid_tei boolean, version int"


def batches(seed=2, n=6):
    rng = np.random.default_rng(seed)
    for at in range(n):
        ids = rng.choice(60, 25 if at != 3 else 0, replace=True)
        yield [(f"e{i}", *[(True, False, None)[k] for k in rng.integers(0, 3, 3)], int(rng.integers(0, 4)) + at) for i in ids]


def test_counts_equal_a_full_count_after_each_batch(spark, tmp_path):
    seen = spark.createDataFrame([], SCHEMA)
    for at, rows in enumerate(batches()):
        # Versions are unique per id, or the last of them would be anyone's guess.
        rows = list({(r[0], r[4]): r for r in rows if r[0] not in {s[0] for s in seen.where(F.col("version") == r[4]).select("id").collect()}}.values())
        fresh = spark.createDataFrame(rows, SCHEMA)
        fresh.coalesce(1).write.parquet(f"{tmp_path}/in/part{at}")
        seen = spark.createDataFrame([*seen.collect(), *rows], SCHEMA)
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        streaming.stream_waterfall(stream, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
        counts = spark.read.parquet(f"{tmp_path}/out/counts")
        last = counts.where(F.col("batch") == counts.agg(F.max("batch")).first()[0]).drop("batch")
        assert last.collect() == state_waterfall(last_wins(seen, ["id"], "version")).collect()


def test_waterfall_of_classes_is_the_waterfall(spark):
    rows = [r for part in batches(5) for r in part]
    entries = spark.createDataFrame(rows, SCHEMA)
    classes = flag_classes(entries).groupBy("oa_url", "pdf", "tei").agg(F.count("*").alias("n"))
    assert waterfall_of(classes).collect() == state_waterfall(entries).collect()
    assert tuple(waterfall_of(classes.limit(0)).first()) == (0,) * 8


def test_the_stream_looks_at_changed_entries_alone(spark, tmp_path):
    """No table is read beside the updates: what an entry was is in the state store, by its id."""
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    plan = streaming.flag_changes(stream)._jdf.queryExecution().logical().toString()
    assert "FlatMapGroupsInPandasWithState" in plan and plan.count("StreamingRelation") == 1 and "Join" not in plan


def test_entries_share_few_states(spark, tmp_path, monkeypatch):
    """One state per bucket, not per entry; old, null and repeated versions change nothing."""
    monkeypatch.setattr(releases, "STATE_BUCKETS", 4)
    first = [(f"e{i}", i % 2 == 0, i % 3 == 0, None, 1 if i % 5 else None) for i in range(50)] + [(None, True, True, True, 1)]
    second = [(f"e{i}", True, True, True, i % 3) for i in range(25)] + [("e60", True, None, False, 0)] * 2
    seen = []
    for at, rows in enumerate((first, second)):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/part{at}")
        seen += rows
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        query = streaming.stream_waterfall(stream, f"{tmp_path}/out", f"{tmp_path}/progress")
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
        latest = {}
        for row in seen:
            version = -1 if row[4] is None else row[4]
            if row[0] not in latest or version > latest[row[0]][0]:
                latest[row[0]] = (version, row)
        expected = state_waterfall(spark.createDataFrame([r for _, r in latest.values()], SCHEMA))
        assert spark.read.parquet(f"{tmp_path}/out/counts/batch={at}").collect() == expected.collect()
