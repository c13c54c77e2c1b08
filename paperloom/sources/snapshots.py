"""Snapshots of outside collections: archive list, publisher map, locations, records."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import present, prune_record
from paperloom.operators.dedup import last_wins
from paperloom.schemas import LOCATION_RECORD, PUBLISHER_META
from paperloom.sources.order import file_order, numbered


def index_pmc_oa(lines: DataFrame, order: str = "line_no") -> DataFrame:
    """One row per PMC id; the last line for an id is the one that counts."""
    return last_wins(lines, ["pmcid"], order).select("pmcid", "subpath", "pmid", "license")


def _pmc_oa_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line, f) of the list in file order, less the first line, which is a time stamp."""
    lines = numbered(spark.read.text(path).select(file_order().alias("line_no"), F.col("value").alias("line")))
    top = lines.agg(F.min("line_no").alias("line_no"))
    return lines.join(top, "line_no", "left_anti").withColumn("f", F.split("line", "\t"))


def read_pmc_oa_errors(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of the lines of the list that have fewer than five fields."""
    return _pmc_oa_lines(spark, path).where(F.size("f") < 5).select("line_no", "line")


def read_pmc_oa(spark: SparkSession, path: str) -> DataFrame:
    """PMC open-access list, by id. No quoting applies. The first line is a time stamp.

    Lines with fewer than five fields are not indexed; `read_pmc_oa_errors` returns them.
    """
    return index_pmc_oa(
        _pmc_oa_lines(spark, path).where(F.size("f") >= 5).select(
            "line_no",
            F.get("f", 0).alias("subpath"),
            F.get("f", 2).alias("pmcid"),
            F.get("f", 3).alias("pmid"),
            F.regexp_replace(F.get("f", 4), "[\r\n]", "").alias("license"),
        )
    )


def index_pub_map(rows: DataFrame, order: str = "line_no") -> DataFrame:
    """(kind, key, pdf): lower-case DOI and PII to PDF file; the last row for a key counts."""
    keys = F.array(
        F.struct(F.lit("doi").alias("kind"), F.lower(present(F.col("doi"))).alias("key")),
        F.struct(F.lit("pii").alias("kind"), present(F.col("pii")).alias("key")),
    )
    keyed = rows.select(order, "pdf", F.inline(keys)).where(F.col("key").isNotNull())
    return last_wins(keyed, ["kind", "key"], order).select("kind", "key", "pdf")


def read_pub_map(spark: SparkSession, path: str) -> DataFrame:
    """Publisher map from CSV, plain or gzip."""
    rows = spark.read.csv(path, header=True, quote='"', escape='"', inferSchema=False)
    return index_pub_map(rows.withColumn("line_no", file_order()))


def read_publisher_meta(spark: SparkSession, folder: str) -> DataFrame:
    """(doi, pii, pmid, pdf) of each article metadata file `*_meta.json` under `folder`."""
    files = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        .text(folder, wholetext=True)
        .select(F.from_json("value", PUBLISHER_META).alias("j"),
                F.col("_metadata.file_name").alias("file"))
    )
    body = F.col("j").getField("full-text-retrieval-response")
    core = body.getField("coredata")
    return files.select(
        F.coalesce(core.getField("prism:doi"), F.lit("")).alias("doi"),
        core.getField("pii").alias("pii"),
        F.coalesce(body.getField("pubmed-id"), F.lit("")).alias("pmid"),
        F.replace(F.col("file"), F.lit("_meta.json"), F.lit(".pdf")).alias("pdf"),
    )


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Open-access location records, one JSON object per line."""
    return spark.read.schema(LOCATION_RECORD).json(path)


def _text(record: Column, *names: str) -> Column:
    """First of the named fields, as text."""
    return present(F.coalesce(*[F.try_variant_get(record, f"$.{n}", "string") for n in names]))


def read_record_errors(spark: SparkSession, path: str) -> DataFrame:
    """(rec_id, line) of the lines that `read_biblio` and `read_fallback` leave out: those that are not JSON."""
    lines = spark.read.text(path).select(file_order().alias("rec_id"), F.col("value").alias("line"))
    return numbered(lines.where(F.try_parse_json("line").isNull()))


def _records(spark: SparkSession, path: str, pruned: tuple[str, ...] = ()) -> DataFrame:
    lines = spark.read.text(path).select(
        file_order().alias("rec_id"), F.try_parse_json("value").alias("raw")
    ).where(F.col("raw").isNotNull())
    raw = F.col("raw")
    return numbered(lines.select(
        "rec_id",
        _text(raw, "DOI", "doi").alias("doi"),
        _text(raw, "pmid").alias("pmid"),
        _text(raw, "pmcid").alias("pmcid"),
        _text(raw, "istexid", "istexId").alias("istexid"),
        _text(raw, "pii").alias("pii"),
        _text(raw, "oaLink").alias("oa_link"),
        _text(raw, "title").alias("title"),
        _text(raw, "year").alias("year"),
        _text(raw, "abstract").alias("abstract"),
        (prune_record(raw, *pruned) if pruned else raw).alias("raw"),
    ))


def read_biblio(spark: SparkSession, path: str) -> DataFrame:
    """Bibliographic records, one JSON object per line, the whole record kept in `raw`.

    The text is parsed once. Keep the result as parquet where a snapshot serves many runs.
    """
    return _records(spark, path)


def read_fallback(spark: SparkSession, path: str) -> DataFrame:
    """Records of the fallback service; their reference lists are dropped."""
    return _records(spark, path, pruned=("reference",))
