"""Metadata releases: CSV with two generations of headers."""

import csv
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paperloom import files
from paperloom.functions import present
from paperloom.sources.order import file_order, numbered
from paperloom.values import RELEASE_COLUMNS


def shape_release(df: DataFrame, position: str = "row_no") -> DataFrame:
    """`position` and the release columns: blanks become null, missing columns are null.

    `sha` keeps its blanks, because they overwrite an older value when merged.
    """
    def column(name: str):
        if name not in df.columns:
            return F.lit(None).cast("string").alias(name)
        if name == "sha":
            return F.coalesce(F.col(name), F.lit("")).alias(name)
        return present(F.col(name)).alias(name)

    return df.select(position, *[column(c) for c in RELEASE_COLUMNS])


def read_release(spark: SparkSession, *paths: str, multi_line: bool = True) -> DataFrame:
    """Rows of one or more releases in file order; each file is read by its own header.

    A file whose fields hold line breaks cannot be split, so it is read by one task; pass
    `multi_line=False` where no field does, or keep releases as parquet with `row_no`.
    """
    def one(header: str, names: list[str]) -> DataFrame:
        columns = next(csv.reader([header]), [])
        schema = StructType([StructField(c if c and c not in columns[:at] else f"_{at}", StringType())
                             for at, c in enumerate(columns)])
        rows = spark.read.schema(schema).csv(names, header=True, multiLine=multi_line, quote='"', escape='"')
        return shape_release(rows.withColumn("row_no", file_order()))

    groups = by_header(spark, paths)
    if not groups:
        raise FileNotFoundError(f"no release files under {', '.join(paths)}")
    return numbered(reduce(DataFrame.unionByName, [one(*group) for group in groups.items()]))


def as_pattern(path: str) -> str:
    """A path as a pattern that matches it alone, as readers take paths for patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def by_header(spark: SparkSession, paths: tuple[str, ...]) -> dict[str, list[str]]:
    """Files of each header line, as a reader takes the names of all its files from the first one.

    Tasks read the first line of each file and no more. The driver gets a header per file, no more
    than the listing that it holds anyway.
    """
    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads = []
            for path in batch["path"]:
                store, name = files.store_of(files.file_uri(path))
                with store.open_input_stream(name) as stream:
                    head = b""
                    while b"\n" not in head and (chunk := stream.read(8192)):
                        head += chunk
                heads.append(head.partition(b"\n")[0].decode())
            yield pd.DataFrame({"path": batch["path"], "header": heads})

    names = spark.read.format("binaryFile").load(list(paths)).select("path")
    groups: dict[str, list[str]] = {}
    for row in sorted(names.mapInPandas(first_lines, "path string, header string").collect()):
        groups.setdefault(row["header"].lstrip("\ufeff").strip(), []).append(as_pattern(row["path"]))
    return groups
