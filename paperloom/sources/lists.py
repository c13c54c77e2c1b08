"""Identifier lists: one value per line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import clean_doi, strip
from paperloom.sources.order import file_order, numbered


def read_id_list(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows (row_no, kind, key) of a list of `doi`, `pmid` or `pmcid` values.

    Blank lines are dropped, DOIs cleaned, and the bare word `pmc` is not a PMC id.
    """
    if kind not in ("doi", "pmid", "pmcid"):
        raise ValueError(f"unknown identifier kind: {kind}")
    key = strip(F.col("value"))
    lines = spark.read.text(path).select(
        file_order().alias("row_no"),
        F.lit(kind).alias("kind"),
        (clean_doi(key) if kind == "doi" else key).alias("key"),
        (F.length(key) > 0).alias("filled"),
    ).where("filled")
    if kind == "pmcid":
        lines = lines.where(F.col("key") != "pmc")
    return numbered(lines.drop("filled"))


def id_list_size(spark: SparkSession, path: str) -> DataFrame:
    """Number of lines that are not blank."""
    return spark.read.text(path).agg(
        F.count_if(F.length(strip(F.col("value"))) > 0).alias("n_lines")
    )
