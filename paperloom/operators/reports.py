"""Counts over state, inventory and releases."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import present, publish_year
from paperloom.operators.coverage import fulltext_semi, tei_presence, with_fulltext
from paperloom.operators.dedup import accept_first_come, first_by


def _count(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def state_waterfall(entries: DataFrame) -> DataFrame:
    """Entries lost at each step; a step that failed counts as failed for all later ones."""
    url, pdf, tei = (F.coalesce(F.col(f"has_valid_{n}"), F.lit(False)) for n in ("oa_url", "pdf", "tei"))
    counts = entries.agg(
        F.count("*").alias("n_total"),
        _count(~url, "n_invalid_url"),
        _count(~(url & pdf), "n_invalid_pdf"),
        _count(~(url & pdf & tei), "n_invalid_tei"),
        _count(url & pdf & tei, "n_fully_valid"),
    )
    return counts.select(
        "*",
        *[(F.col("n_total") - F.col(f"n_invalid_{s}")).alias(f"n_valid_{s}") for s in ("url", "pdf", "tei")],
    )


def flag_classes(entries: DataFrame, *more: str) -> DataFrame:
    """(id, oa_url, pdf, tei) of `entries`, and `more` columns: the flags of the waterfall, null counting as false."""
    return entries.select("id", *more, *[
        F.coalesce(F.col(f"has_valid_{n}"), F.lit(False)).alias(n) for n in ("oa_url", "pdf", "tei")])


def waterfall_of(classes: DataFrame) -> DataFrame:
    """The waterfall from counts (oa_url, pdf, tei, n) of entries per combination of flags."""
    url, pdf, tei = F.col("oa_url"), F.col("pdf"), F.col("tei")
    steps = {"n_total": F.lit(True), "n_invalid_url": ~url, "n_invalid_pdf": ~(url & pdf),
             "n_invalid_tei": ~(url & pdf & tei), "n_fully_valid": url & pdf & tei}
    counts = classes.agg(*[
        F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(name) for name, c in steps.items()])
    return counts.select(
        "*", *[(F.col("n_total") - F.col(f"n_invalid_{s}")).alias(f"n_valid_{s}") for s in ("url", "pdf", "tei")])


def identifier_integrity(id_map: DataFrame, entries: DataFrame) -> DataFrame:
    """Distinct ids of the map, and the number of map rows whose id has no entry.

    The map is folded to one row per id before the join, so no id can be a hot key.
    """
    ids = id_map.groupBy("id").agg(F.count("*").alias("n_rows"))
    known = entries.select("id", F.lit(True).alias("known"))
    return ids.join(known, "id", "left").agg(
        F.count("*").alias("n_ids"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n_rows"))), F.lit(0)).alias("n_rows_without_entry"),
    )


def tei_report(artifacts: DataFrame) -> DataFrame:
    """Articles with a TEI file from the PDF, from JATS, and from either."""
    return tei_presence(artifacts).agg(
        _count(F.col("has_pdf_tei"), "n_pdf_tei"), _count(F.col("has_jats_tei"), "n_jats_tei"),
        _count(F.col("has_tei"), "n_tei"),
    )


def _distinct_entries(release: DataFrame) -> DataFrame:
    keyed = release.select("row_no", present(F.col("cord_uid")).alias("cord_uid"), "publish_time")
    return first_by(keyed.where("cord_uid is not null"), ["cord_uid"], "row_no")


def _per_year(rows: DataFrame) -> DataFrame:
    dated = rows.select(publish_year(F.col("publish_time")).alias("year")).where("year is not null")
    return dated.groupBy("year").agg(F.count("*").alias("n"))


def entries_per_year(release: DataFrame) -> DataFrame:
    """Distinct articles per publication year; rows without uid or date are left out."""
    return _per_year(_distinct_entries(release))


def harvested_per_year(release: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The same for articles of which a full text is held."""
    return _per_year(fulltext_semi(_distinct_entries(release), artifacts))


def _summed(*parts: DataFrame) -> DataFrame:
    """One row from one-row frames of counts; a count missing in a part adds nothing."""
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rows.columns])


def _articles(release: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(cord_uid, n_rows, year, has_fulltext) of a release, one row per article, in one pass over it.

    The year is that of an article's first row. Rows without uid are counted in a row without uid, and
    there is such a row in any case, so that no release is too empty to be counted.
    """
    per_uid = release.groupBy(present(F.col("cord_uid")).alias("cord_uid")).agg(
        F.count("*").alias("n_rows"), F.min_by("publish_time", "row_no").alias("publish_time"))
    rest = release.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("cord_uid"), F.lit(0).cast("long").alias("n_rows"), F.lit(None).cast("string").alias("publish_time"))
    return with_fulltext(per_uid.unionByName(rest), artifacts).select(
        "cord_uid", "n_rows", F.when(F.col("cord_uid").isNotNull(), publish_year(F.col("publish_time"))).alias("year"), "has_fulltext")


def _collection_counts() -> list[Column]:
    is_article = F.col("cord_uid").isNotNull()
    return [F.sum("n_rows").alias("rows"), F.count_if(is_article).alias("articles"),
            F.count_if(is_article & F.col("has_fulltext")).alias("harvested")]


def collection_totals(release: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Rows, distinct articles and harvested articles of a release."""
    return _articles(release, artifacts).agg(*_collection_counts()).toDF(
        "total_entries", "total_distinct_entries", "total_harvested_entries")


def collection_rows(release: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The statistics of a collection as rows (metric, year, n): totals and years from one rollup."""
    counts = _articles(release, artifacts).rollup("year").agg(F.grouping("year").alias("whole"), *_collection_counts())

    def rows(year: Column, **metrics: str) -> Column:
        return F.array(*[F.struct(F.lit(m).alias("metric"), year.alias("year"), F.col(c).alias("n")) for m, c in metrics.items()])

    totals = rows(F.lit(""), total_entries="rows", total_distinct_entries="articles", total_harvested_entries="harvested")
    years = rows(F.col("year"), distribution_entries_per_year="articles", distribution_harvested_per_year="harvested")
    both = F.when(F.col("whole") == 1, totals).otherwise(F.filter(years, lambda r: r["n"] > 0))
    return counts.where("whole = 1 or year is not null").select(F.inline(both))


def coverage_report(rows: DataFrame, n_rows: DataFrame) -> DataFrame:
    """Counts over `coverage_rows`; `n_rows` is the one-row count `n_rows` of the release."""
    official, tei = F.col("has_official"), F.col("has_tei")
    pdf_tei, jats_tei = F.col("has_pdf_tei"), F.col("has_jats_tei")
    counts = rows.agg(
        F.count("*").alias("n_distinct"),
        _count(F.col("has_pmc_json"), "n_official_pmc"),
        _count(F.col("has_pdf_json"), "n_official_pdf"),
        _count(official, "n_official"),
        _count(official & tei, "n_harvested"),
        _count(official & pdf_tei, "n_harvested_pdf_tei"),
        _count(official & jats_tei, "n_harvested_jats_tei"),
        _count(official & ~tei, "n_missed"),
        _count(~official & tei, "n_extra"),
        _count(~official & pdf_tei, "n_extra_pdf_tei"),
        _count(~official & jats_tei, "n_extra_jats_tei"),
        _count(tei, "n_any_tei"),
    )
    counted = _summed(counts, n_rows)
    return counted.withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def duplicate_census(release: DataFrame) -> DataFrame:
    """Explicit duplicates repeat a uid; article-level ones share a key with a taken row."""
    firsts = first_by(
        release.select(present(F.col("cord_uid")).alias("cord_uid"), "row_no"), ["cord_uid"], "row_no"
    )
    taken = accept_first_come(release)
    counted = _summed(
        release.agg(F.count("*").alias("n_rows")), firsts.agg(F.count("*").alias("n_uids")),
        taken.agg(F.count("*").alias("n_distinct")),
    )
    return counted.select(
        "n_rows",
        (F.col("n_rows") - F.col("n_uids")).alias("n_explicit_duplicates"),
        (F.col("n_uids") - F.col("n_distinct")).alias("n_article_duplicates"),
        "n_distinct",
    )
