"""Kept indexes of snapshots; `sinks.index` writes them."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paperloom.operators.lookup import RECORD_FIELDS, BiblioIndex
from paperloom.schemas import ENTRY

KEYS = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "key", "value")])
RECORDS = T.StructType([T.StructField("value", T.StringType()), *[f for f in ENTRY.fields if f.name in RECORD_FIELDS]])


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, by: list[str], buckets: int) -> DataFrame:
    """The files as a table whose buckets Spark knows, under a name of this session."""
    name, columns = f"bucketed_{uuid.uuid4().hex}", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(by)
    spark.sql(f"create table {name} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) "
              f"into {buckets} buckets location '{path}'")
    return spark.table(name)


def read_biblio_index(spark: SparkSession, path: str) -> BiblioIndex:
    """The index under `path`. Joins on its keys leave it where it lies and bring the asked rows to it."""
    buckets = spark.read.schema("buckets int").parquet(f"{path}/layout").first()["buckets"]
    return BiblioIndex(
        read_bucketed(spark, f"{path}/keys", KEYS, ["kind", "key"], buckets),
        read_bucketed(spark, f"{path}/records", RECORDS, ["value"], buckets))
