"""Versioned writing of the state tables; see `sources.state` for the layout."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.schemas import COMMITS, ENTRY, ERRORS, ID_MAP, conform
from paperloom.sources.state import read_all_commits, read_errors, read_state, version_folder


class StateConflict(RuntimeError):
    """Another run has committed a version since this one has read the state."""


def write_state(
    spark: SparkSession, root: str, entries: DataFrame, id_map: DataFrame,
    batch: str = "", full: bool = False, errors: DataFrame | None = None, read_at: int | None = None,
) -> int:
    """Add a version and commit it; gives its number.

    A delta holds only the rows that changed, so an update costs what it changes. The version
    number follows from the commits; a run writes under a token of its own, which the commit names, so
    neither a dead run nor another writer gets into a version. `errors` (reason, line) go into the
    ledger with the version. `read_at` is the number of versions the caller's tables were made
    from: if there are more by now, another writer was quicker, and this one is refused. The commit
    itself is refused if its place is taken, so of two writers one fails and is run again.
    """
    commits = read_all_commits(spark, root)
    if read_at is not None and len(commits) != read_at:
        raise StateConflict(f"{len(commits)} versions under {root}, {read_at} when the state was read")
    version = commits[-1]["version"] + 1 if commits else 0
    full, token = full or not commits, uuid.uuid4().hex[:12]
    folder = version_folder(version, token)
    for name, table, schema in (("entries", entries, ENTRY), ("id_map", id_map, ID_MAP)):
        conform(table, schema).write.parquet(f"{root}/{name}/{folder}")
    failed = spark.createDataFrame([], ERRORS) if errors is None else errors.withColumn("batch", F.lit(batch))
    conform(failed, ERRORS).write.parquet(f"{root}/errors/{folder}")
    commit = spark.createDataFrame([(version, batch, full, token)], COMMITS).coalesce(1)
    try:
        commit.write.mode("errorifexists").parquet(f"{root}/commits/at={version}")
    except AnalysisException as taken:
        if taken.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise StateConflict(f"version {version} under {root} is another run's") from taken
    return version


def reset_state(spark: SparkSession, root: str) -> int:
    """Start over: an empty full version. Older files stay."""
    return write_state(
        spark, root, spark.createDataFrame([], ENTRY), spark.createDataFrame([], ID_MAP), "reset", True
    )


def compact_state(spark: SparkSession, root: str) -> int:
    """Fold base and deltas into one full version, after which readers need no merge."""
    seen = len(read_all_commits(spark, root))
    entries, id_map = read_state(spark, root)
    return write_state(spark, root, entries, id_map, "compact", True, read_errors(spark, root, last=True), seen)
