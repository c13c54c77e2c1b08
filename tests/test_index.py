"""The kept index of a snapshot: same answers, and the snapshot stays where it lies."""

import pytest
from pyspark.errors import AnalysisException

from checks.compare import plan_text
from paperloom import sinks, sources
from paperloom.operators import lookup
from tests.test_lookup import ASKED, snapshots  # noqa: F401

SCHEMA = "row_no long, doi string, pmid string, pmcid string, istexid string"


@pytest.fixture
def plain_joins(spark):
    """No broadcast joins, so that every join has to deal out its rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("buckets", [1, 5])
def test_same_records_as_from_the_snapshots(spark, snapshots, tmp_path, request, split, buckets):  # noqa: F811
    if split:
        request.getfixturevalue("split_all")
    asked = spark.createDataFrame(ASKED + [(n, "10.1/a", None, None, None) for n in range(10, 20)], SCHEMA)
    sinks.write_biblio_index(spark, snapshots[0], str(tmp_path / "i"), snapshots[1], buckets)
    index = sources.read_biblio_index(spark, str(tmp_path / "i"))
    kept = lookup.biblio_from_index(asked, index).selectExpr("* except (raw)", "to_json(raw) as raw").collect()
    fresh = lookup.biblio_lookup(asked, *snapshots).selectExpr("* except (raw)", "to_json(raw) as raw").collect()
    assert sorted(map(repr, kept)) == sorted(map(repr, fresh)) and kept


def test_the_snapshot_is_not_moved(spark, snapshots, tmp_path, plain_joins):  # noqa: F811
    """Asked rows are dealt out into the buckets of the index; no exchange stands over a scan of it."""
    sinks.write_biblio_index(spark, snapshots[0], str(tmp_path / "i"), snapshots[1], 8)
    index = sources.read_biblio_index(spark, str(tmp_path / "i"))
    asked = spark.createDataFrame(ASKED, SCHEMA)
    lines = plan_text(lookup.biblio_from_index(asked, index)).splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line]
    assert len(scans) == 2 and all("Bucketed: true" in lines[i] for i in scans)
    for i in scans:
        above = []
        depth = lines[i].index("FileScan")
        for line in reversed(lines[:i]):
            at = len(line) - len(line.lstrip(" :+-*("))
            if at < depth:
                above.append(line)
                depth = at
            if "Join" in line and at <= depth:
                break
        assert not any("Exchange" in line for line in above), above


def test_without_layout_there_is_no_index(spark, snapshots, tmp_path):  # noqa: F811
    with pytest.raises(AnalysisException):
        sources.read_biblio_index(spark, str(tmp_path / "none"))
