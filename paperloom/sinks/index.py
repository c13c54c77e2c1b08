"""Kept indexes of snapshots, laid out by key so that a lookup does not move them."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from paperloom.operators.joins import shuffle_tasks
from paperloom.operators.lookup import biblio_index


def write_bucketed(df: DataFrame, path: str, by: list[str], buckets: int) -> None:
    """Write `df` hashed by its keys into files that Spark knows as the buckets of a table.

    The table's name lives for this call; `sources.index` names the files again.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *by).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    df.sparkSession.sql(f"drop table {name}")


def write_biblio_index(
    spark: SparkSession, biblio: DataFrame, path: str, fallback: DataFrame | None = None, buckets: int | None = None
) -> None:
    """Keep the index of a snapshot, and of the fallback snapshot, under `path`.

    It costs one pass over the snapshots. There are as many buckets as shuffle tasks, unless told
    otherwise. The layout is written last: without it there is no index, so a run that dies
    halfway leaves none, and is run again with another path.
    """
    index, buckets = biblio_index(biblio, fallback), buckets or shuffle_tasks(biblio)
    write_bucketed(index.keys, f"{path}/keys", ["kind", "key"], buckets)
    write_bucketed(index.records, f"{path}/records", ["value"], buckets)
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/layout")
