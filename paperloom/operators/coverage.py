"""What full texts exist, ours against the official ones."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions import present, storage_path
from paperloom.operators.dedup import first_by
from paperloom.operators.joins import Load, key_load, spread_join
from paperloom.values import ARTIFACT_SUFFIXES, EXTRA_COLUMNS, MISSED_COLUMNS


def kinds_by_article(artifacts: DataFrame, **flags: tuple[str, ...]) -> DataFrame:
    """(id, one boolean per flag): whether the article has a file of the flag's kinds."""
    wanted = sorted({k for kinds in flags.values() for k in kinds})
    return artifacts.where(F.col("kind").isin(*wanted)).groupBy("id").agg(
        *[F.bool_or(F.col("kind").isin(*kinds)).alias(name) for name, kinds in flags.items()]
    )


def _flag(name: str):
    return F.coalesce(F.col(name), F.lit(False)).alias(name)


def official_keys(rows: DataFrame) -> DataFrame:
    """`rows` plus the two keys of official full texts, null where blank."""
    return rows.withColumns({"_pmc": present(F.col("pmcid")), "_sha": present(F.col("sha"))})


def official_fulltext(rows: DataFrame, official: DataFrame, load: Load | None = None) -> DataFrame:
    """`rows` plus has_pmc_json (by PMC id), has_pdf_json (by digest) and has_official.

    `load` is the measure of `official_keys` where it is known from something cheaper.
    """
    def listed(kind: str, column: str, flag: str) -> DataFrame:
        keys = official.where(F.col("kind") == kind).select(F.col("key").alias(column))
        return keys.withColumn(flag, F.lit(True))

    keyed = official_keys(rows)
    load = key_load(keyed, "_pmc", "_sha") if load is None else load
    keyed = spread_join(keyed, listed("pmc", "_pmc", "has_pmc_json"), ["_pmc"], "left", "row_no", load)
    keyed = spread_join(keyed, listed("pdf", "_sha", "has_pdf_json"), ["_sha"], "left", "row_no", load)
    return keyed.drop("_pmc", "_sha").withColumns({
        "has_pmc_json": _flag("has_pmc_json"), "has_pdf_json": _flag("has_pdf_json"),
    }).withColumn("has_official", F.col("has_pmc_json") | F.col("has_pdf_json"))


def harvested_fulltext(rows: DataFrame, artifacts: DataFrame) -> DataFrame:
    """`rows` plus has_pdf_tei, has_jats_tei and has_tei, by id. `rows` are unique by uid."""
    ours = kinds_by_article(artifacts, has_pdf_tei=("pdf_tei",), has_jats_tei=("jats_tei",))
    joined = rows.join(ours.withColumnRenamed("id", "cord_uid"), "cord_uid", "left")
    return joined.withColumns({
        "has_pdf_tei": _flag("has_pdf_tei"), "has_jats_tei": _flag("has_jats_tei"),
    }).withColumn("has_tei", F.col("has_pdf_tei") | F.col("has_jats_tei"))


def with_fulltext(rows: DataFrame, artifacts: DataFrame) -> DataFrame:
    """`rows`, unique by uid, plus has_fulltext: a PDF, an NXML file or a TEI from the PDF."""
    held = kinds_by_article(artifacts, has_fulltext=("pdf", "nxml", "pdf_tei"))
    joined = rows.join(held.withColumnRenamed("id", "cord_uid"), "cord_uid", "left")
    return joined.withColumn("has_fulltext", _flag("has_fulltext"))


def fulltext_semi(rows: DataFrame, artifacts: DataFrame) -> DataFrame:
    """`rows` for which the tree holds a full text."""
    return with_fulltext(rows, artifacts).where("has_fulltext").drop("has_fulltext")


def tei_presence(artifacts: DataFrame) -> DataFrame:
    """(id, has_pdf_tei, has_jats_tei, has_tei) of each article that has a metadata file."""
    held = kinds_by_article(
        artifacts, has_json=("json",), has_pdf_tei=("pdf_tei",), has_jats_tei=("jats_tei",)
    )
    return held.where("has_json").select(
        "id", "has_pdf_tei", "has_jats_tei",
        (F.col("has_pdf_tei") | F.col("has_jats_tei")).alias("has_tei"),
    )


def coverage_rows(release: DataFrame, official: DataFrame, artifacts: DataFrame) -> DataFrame:
    """One row per distinct uid with the official and the harvested flags.

    Rows with a blank uid count as one article. Only the key columns enter the joins, and our
    own flags are joined first, as the rows already lie by uid then.
    """
    keys = release.select(
        "row_no", present(F.col("cord_uid")).alias("cord_uid"), "sha", "doi", "pmcid",
        "pubmed_id", "url",
    )
    firsts = first_by(keys, ["cord_uid"], "row_no")
    load = key_load(official_keys(release), "_pmc", "_sha")
    return official_fulltext(harvested_fulltext(firsts, artifacts), official, load)


def missed(rows: DataFrame) -> DataFrame:
    """Official full text exists, ours does not."""
    return rows.where(F.col("has_official") & ~F.col("has_tei")).select(*MISSED_COLUMNS)


def extra(rows: DataFrame, root: str = "") -> DataFrame:
    """Ours exists, no official one does; paths of our files."""
    stem = F.concat(F.lit(root), storage_path(F.col("cord_uid")), F.col("cord_uid"))

    def path(flag: str, kind: str):
        return F.when(F.col(flag), F.concat(stem, F.lit(ARTIFACT_SUFFIXES[kind]))).otherwise(F.lit(""))

    columns = (
        "cord_uid", "doi", "pmcid", "pubmed_id",
        path("has_pdf_tei", "pdf_tei"), path("has_jats_tei", "jats_tei"),
    )
    return rows.where(F.col("has_tei") & ~F.col("has_official")).select(*columns).toDF(*EXTRA_COLUMNS)


def both(rows: DataFrame) -> DataFrame:
    """Full text exists on both sides."""
    return rows.where(F.col("has_official") & F.col("has_tei"))
