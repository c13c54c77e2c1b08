"""State of earlier runs: entries and identifier map.

Each table is a set of parquet folders `version=N-token`, the token of the run that wrote it. A version is
either full or a delta, and counts only once `commits/at=N` exists, so a run that dies halfway leaves no trace for
readers and may simply be run again.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.dedup import last_wins
from paperloom.schemas import COMMITS, ENTRY, ERRORS, ID_MAP


def version_folder(version: int, token: str) -> str:
    return f"version={version}-{token}"


def read_all_commits(spark: SparkSession, root: str) -> list:
    """Commit rows of all versions, oldest first: one row per run."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{root}/commits").orderBy("version").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_commits(spark: SparkSession, root: str) -> list:
    """Commit rows from the last full version on, oldest first: what the state is read from."""
    rows = read_all_commits(spark, root)
    last_full = max((i for i, r in enumerate(rows) if r["full"]), default=0)
    return rows[last_full:]


def is_taken(spark: SparkSession, root: str, batch: str) -> bool:
    """Whether a batch was ever committed, whatever was compacted or reset since."""
    return any(c["batch"] == batch for c in read_all_commits(spark, root))


def _table(spark: SparkSession, root: str, name: str, schema, keys: list[str], commits: list) -> DataFrame:
    def path(row) -> str:
        return f"{root}/{name}/{version_folder(row['version'], row['token'])}"

    if not commits:
        return spark.createDataFrame([], schema)
    base, deltas = spark.read.schema(schema).parquet(path(commits[0])), commits[1:]
    if not deltas:
        return base
    paths = [path(r) for r in deltas]
    newer = last_wins(
        spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(*paths)
        .withColumn("version", F.regexp_extract("_metadata.file_path", r"/version=(\d+)-", 1).cast("bigint")),
        keys, "version",
    ).drop("version")
    # The deltas are small next to the base: the base is not shuffled while they fit a broadcast.
    return base.join(newer.select(*keys), keys, "left_anti").unionByName(newer)


def read_state(spark: SparkSession, root: str, commits: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, id_map) as of the last committed version; both empty on a first run."""
    known = read_commits(spark, root) if commits is None else commits
    return (
        _table(spark, root, "entries", ENTRY, ["id"], known),
        _table(spark, root, "id_map", ID_MAP, ["kind", "key"], known),
    )


def read_errors(spark: SparkSession, root: str, last: bool = False) -> DataFrame:
    """The ledger (version, batch, reason, line) of rows that runs could not take, or the last run's."""
    commits = read_all_commits(spark, root)[-1 if last else 0:]
    paths = [f"{root}/errors/{version_folder(c['version'], c['token'])}" for c in commits]
    if not paths:
        return spark.createDataFrame([], ERRORS).withColumn("version", F.lit(0).cast("long"))
    rows = spark.read.schema(ERRORS).option("basePath", f"{root}/errors").parquet(*paths)
    version = F.regexp_extract("_metadata.file_path", r"/version=(\d+)-", 1).cast("bigint")
    return rows.select(version.alias("version"), *ERRORS.names)
