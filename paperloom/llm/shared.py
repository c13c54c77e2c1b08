"""Helpers that several operators use."""

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.runtime import fresh_path

# A word: a run without blank, tab, line feed, vertical tab, form feed and carriage return.
# Buckets whose totals are summed up together.
BLOCK = 1024
BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


# Folders that `stored` has made in this process, oldest first.
SCRATCH: list[str] = []
# Bytes that a writing task gathers before it writes them; whole texts make larger groups costly to hold.
ROW_GROUP = 16 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet to the shared folder and read it from there."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    SCRATCH.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders that `stored` has made, for a caller whose own result was written.

    Frames that still read from them are lost.
    """
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        SCRATCH.remove(path)


def words(text: Column) -> Column:
    """Array of the words of `text`; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def as_rows(docs: DataFrame) -> DataFrame:
    """The whole row as one struct `row`, so that no column of `docs` can clash with added ones."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def running_before(totals: DataFrame, value: str, within: list[str]) -> DataFrame:
    """`totals` (within..., bucket, value) with `before`: the sum of `value` in smaller buckets.

    Sums run inside blocks of buckets, and over blocks, so no task gets all buckets.
    """
    block = F.floor(F.col("bucket") / BLOCK)
    blocks = totals.withColumn("block", block).groupBy(*within, "block").agg(F.sum(value).alias("in_block"))
    ahead = W.rowsBetween(W.unboundedPreceding, -1)
    over_blocks = ahead.partitionBy(*within).orderBy("block")
    inside = ahead.partitionBy(*within, "block").orderBy("bucket")
    blocks = blocks.select(*within, "block", F.coalesce(F.sum("in_block").over(over_blocks), F.lit(0)).alias("to_block"))
    return totals.withColumn("block", block).join(blocks, [*within, "block"]).withColumn(
        "before", F.col("to_block") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    ).drop("block", "to_block")


# Bytes of a piece of text, and what no word holds: ASCII other than letters and digits.
PIECE, BREAK = 1 << 20, re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of a little over PIECE bytes, none of which ends inside a word."""
    start = 0
    while len(text) - start > PIECE and (found := BREAK.search(text, start + PIECE)):
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]
