"""Declared schemas; no reader of the package infers one."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.values import FLAGS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


ENTRY = T.StructType(
    _strings(
        "id", "doi", "pmid", "pmcid", "arxiv_id", "pii", "title", "year", "cord_sha",
        "license_simplified", "abstract", "mag_id", "who_covidence", "oa_link", "oa_source",
    )
    + [T.StructField(f, T.BooleanType()) for f in FLAGS]
    + _strings("data_path")
    + [T.StructField("raw", T.VariantType())]
)

ID_MAP = T.StructType(_strings("kind", "key", "id"))

# The ledger of rows that a run could not take.
ERRORS = T.StructType(_strings("batch", "reason", "line"))

COMMITS = T.StructType(
    [T.StructField("version", T.LongType()), T.StructField("batch", T.StringType()),
     T.StructField("full", T.BooleanType()), T.StructField("token", T.StringType())]
)

LOCATION = T.StructType(_strings("url", "url_for_pdf"))

LOCATION_RECORD = T.StructType(
    _strings("doi")
    + [T.StructField("best_oa_location", LOCATION),
       T.StructField("oa_locations", T.ArrayType(LOCATION))]
)

PUBLISHER_META = T.StructType([
    T.StructField("full-text-retrieval-response", T.StructType([
        T.StructField("coredata", T.StructType(_strings("prism:doi", "pii"))),
        T.StructField("pubmed-id", T.StringType()),
    ])),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give `df` exactly the columns of `schema`; columns it lacks become null."""
    have = {c.lower() for c in df.columns}

    def column(field: T.StructField) -> Column:
        if field.name.lower() in have:
            return F.col(field.name).cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])
