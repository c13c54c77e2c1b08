"""Lookups of articles in identifier map, snapshots, listings and earlier state."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.functions import (
    contains_any, doi_key, init_flags, join_url, present, stable_id, storage_path,
)
from paperloom.operators.dedup import first_location
from paperloom.operators.joins import Load, first_hit, heavy_frame, key_load, probe_keys, spread_join
from paperloom.schemas import ENTRY, conform
from paperloom.values import PMC_ARCHIVE_BASE, PMC_PDF_MARKS, PMC_WEB_BASE

RECORD_FIELDS = ("doi", "pmid", "pmcid", "pii", "title", "year", "abstract", "oa_link", "raw")


def resolve_ids(keys: DataFrame, id_map: DataFrame) -> DataFrame:
    """Rows (row_no, kind, key) plus `id` and `known`: the mapped id, else a stable new one."""
    known = id_map.select("kind", "key", "id")
    found = spread_join(keys, known, ["kind", "key"], "left", "row_no")
    return found.select(
        "row_no", "kind", "key",
        F.coalesce("id", stable_id(F.col("kind"), F.col("key"))).alias("id"),
        F.col("id").isNotNull().alias("known"),
    )


def reuse_entries(resolved: DataFrame, entries: DataFrame) -> DataFrame:
    """Resolved rows plus the struct `entry` of the article's earlier entry, or null."""
    fields = [c for c in entries.columns if c != "id"]
    known = entries.select("id", F.struct("id", *fields).alias("entry"))
    return spread_join(resolved, known, ["id"], "left", "row_no")


def _numbered(source: str) -> Column:
    """Number of a record as text, told apart by the snapshot it is from."""
    number = F.to_json(F.struct(F.col("rec_id").alias("n")))
    return F.concat(F.lit(source + ":"), number).alias("value")


def _records(snapshot: DataFrame, source: str) -> DataFrame:
    wanted = StructType([f for f in ENTRY.fields if f.name in RECORD_FIELDS])
    numbered = snapshot.withColumn("value", _numbered(source))
    return conform(numbered, StructType([numbered.schema["value"], *wanted.fields]))


def _record_index(snapshot: DataFrame, source: str, kinds: dict[str, Column]) -> DataFrame:
    keys = F.array(*[
        F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in kinds.items()
    ])
    keyed = snapshot.select("rec_id", F.inline(keys)).where(F.col("key").isNotNull())
    first = keyed.groupBy("kind", "key").agg(F.min("rec_id").alias("rec_id"))
    return first.select("kind", "key", _numbered(source))


@dataclass(frozen=True)
class BiblioIndex:
    """Keys (kind, key, value) of bibliographic records, unique by (kind, key), and the records by `value`."""

    keys: DataFrame
    records: DataFrame


def biblio_index(biblio: DataFrame, fallback: DataFrame | None = None) -> BiblioIndex:
    """The index of a snapshot and of the fallback snapshot. Where records share a key, the first one counts.

    `sinks.write_biblio_index` keeps it, so that an update need not go through the snapshot again.
    """
    keys = _record_index(biblio, "biblio", {
        "doi": doi_key(F.col("doi")),
        "pmid": present(F.col("pmid")),
        "pmcid": present(F.col("pmcid")),
        "istexid": present(F.col("istexid")),
    })
    records = _records(biblio, "biblio")
    if fallback is not None:
        keys = keys.unionByName(_record_index(fallback, "fallback", {"fallback": doi_key(F.col("doi"))}))
        records = records.unionByName(_records(fallback, "fallback"))
    return BiblioIndex(keys, records)


def biblio_lookup(keys: DataFrame, biblio: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """`biblio_from_index` over snapshots that have no kept index."""
    return biblio_from_index(keys, biblio_index(biblio, fallback), fallback is not None)


def biblio_from_index(keys: DataFrame, index: BiblioIndex, fallback: bool = True) -> DataFrame:
    """(row_no, matched_by, record fields) of the rows for which a record exists.

    `keys` has row_no, doi, pmid, pmcid and optionally istexid. The first hit counts, in the
    order doi, pmid, pmcid, istexid, then the fallback snapshot by doi. Only keys travel
    through the ladder; the record itself is joined once, by its number.
    """
    rungs = [("doi", "doi", F.col("doi")), ("pmid", "pmid", F.col("pmid")),
             ("pmcid", "pmcid", F.col("pmcid"))]
    if "istexid" in keys.columns:
        rungs.append(("istexid", "istexid", F.col("istexid")))
    if fallback:
        rungs.append(("fallback", "fallback", F.col("doi")))
    cleaned = keys.withColumns({
        c: doi_key(F.col(c)) if c == "doi" else present(F.col(c))
        for c in ("doi", "pmid", "pmcid", "istexid") if c in keys.columns
    })
    probes = probe_keys(cleaned, "row_no", rungs)
    load = key_load(probes, "key")
    hits = first_hit(probes, index.keys, load)
    # A record has few keys, so it can only be asked for often if one of them is heavy.
    often = []
    if load.heavy["key"]:
        heavy = heavy_frame(keys.sparkSession, "key", load.heavy["key"])
        often = [r["value"] for r in index.keys.join(heavy, "key").select("value").distinct().collect()]
    found = spread_join(
        hits, index.records, ["value"], "inner", "row", Load(load.rows, {"value": often}, {"value": False})
    )
    return found.select(
        F.col("row").alias("row_no"), F.col("rung").alias("matched_by"), *RECORD_FIELDS
    )


def pub_file_lookup(
    entries: DataFrame, pub_map: DataFrame, pub_files: DataFrame, base: str, load: Load | None = None
) -> DataFrame:
    """(id, matched_by, pdf_path, file_exists): the publisher's file by DOI, else by PII.

    A DOI that is mapped to a missing file still ends the search, as the map is asked first.
    """
    files = pub_files.select("pdf").distinct().withColumn("there", F.lit(True))
    listed = spread_join(
        pub_map.withColumn("_k", F.concat_ws(":", "kind", "key")), files, ["pdf"], "left", "_k"
    )
    index = listed.select(
        "kind", "key",
        F.struct("pdf", F.coalesce("there", F.lit(False)).alias("there")).alias("value"),
    )
    rungs = [("doi", "doi", doi_key(F.col("doi"))), ("pii", "pii", present(F.col("pii")))]
    return first_hit(probe_keys(entries, "id", rungs), index, load).select(
        F.col("row").alias("id"), F.col("rung").alias("matched_by"),
        join_url(base, F.col("value.pdf")).alias("pdf_path"),
        F.col("value.there").alias("file_exists"),
    )


def pmc_lookup(
    entries: DataFrame, pmc_oa: DataFrame, base: str = PMC_ARCHIVE_BASE, load: Load | None = None
) -> DataFrame:
    """(id, url, license) of the archive of each entry whose PMC id is on the list."""
    asked = entries.select("id", present(F.col("pmcid")).alias("pmcid")).where("pmcid is not null")
    found = spread_join(
        asked, pmc_oa.select("pmcid", "subpath", "license"), ["pmcid"], "inner", "id", load
    )
    return found.select(
        "id", join_url(base, F.col("subpath")).alias("url"),
        F.regexp_replace("license", "[\r\n]", "").alias("license"),
    )


def choose_location(records: DataFrame, pmc_base: str = PMC_WEB_BASE) -> DataFrame:
    """(doi, url) of location records: the best place to get the PDF from, else null.

    Works inside each record, without a shuffle.
    """
    best, others = F.col("best_oa_location"), F.col("oa_locations")
    has_pdf = lambda o: o["url_for_pdf"].isNotNull()
    hosted = first_location(
        others, lambda o: has_pdf(o) & contains_any(o["url_for_pdf"], PMC_PDF_MARKS)
    )
    url = (
        F.when(best.isNull(), F.lit(None).cast("string"))
        .when(present(best["url_for_pdf"]).isNotNull(), best["url_for_pdf"])
        .when(best["url"].startswith(pmc_base), F.concat(best["url"], F.lit("/pdf/")))
        .when(hosted.isNotNull(), F.concat(hosted["url"], F.lit("/pdf/")))
        .otherwise(first_location(others, has_pdf)["url_for_pdf"])
    )
    return records.select(doi_key(F.col("doi")).alias("doi"), url.alias("url"))


def choose_flat_location(locations: DataFrame, pmc_base: str = PMC_WEB_BASE) -> DataFrame:
    """The same choice over one row per location (doi, pos, is_best, url, url_for_pdf).

    Every rule is a combinable aggregate, so no list of locations is ever collected.
    """
    pdf, url = F.col("url_for_pdf"), F.col("url")
    hosted = pdf.isNotNull() & contains_any(pdf, PMC_PDF_MARKS)
    ranked = locations.groupBy(doi_key(F.col("doi")).alias("doi")).agg(
        F.min_by(F.struct(url, pdf), F.when(F.col("is_best"), F.col("pos"))).alias("best"),
        F.min_by(F.struct(url), F.when(hosted, F.col("pos"))).alias("hosted"),
        F.min_by(pdf, F.when(pdf.isNotNull(), F.col("pos"))).alias("any_pdf"),
    )
    best = F.col("best")
    chosen = (
        F.when(best.isNull(), F.lit(None).cast("string"))
        .when(present(best["url_for_pdf"]).isNotNull(), best["url_for_pdf"])
        .when(best["url"].startswith(pmc_base), F.concat(best["url"], F.lit("/pdf/")))
        .when(F.col("hosted").isNotNull(), F.concat(F.col("hosted.url"), F.lit("/pdf/")))
        .otherwise(F.col("any_pdf"))
    )
    return ranked.select("doi", chosen.alias("url"))


def legacy_lookup(entries: DataFrame, legacy: DataFrame, root: str) -> DataFrame:
    """(id, pdf_path, nxml_path) of files that an older tree already holds for an entry.

    `legacy` has id, kind and `valid`. A PDF counts if its content is one; an NXML file if it is there.
    """
    held = legacy.where(F.col("kind").isin("pdf", "nxml")).groupBy("id").agg(
        F.bool_or((F.col("kind") == "pdf") & F.col("valid")).alias("pdf"),
        F.bool_or(F.col("kind") == "nxml").alias("nxml"),
    )
    stem = F.concat(F.lit(root.rstrip("/") + "/"), storage_path(F.col("id")), F.col("id"))
    both = entries.select("id").join(held, "id")
    return both.select(
        "id",
        F.when(F.col("pdf"), F.concat(stem, F.lit(".pdf"))).alias("pdf_path"),
        F.when(F.col("nxml"), F.concat(stem, F.lit(".nxml"))).alias("nxml_path"),
    ).where("pdf_path is not null or nxml_path is not null")


def reuse_legacy(entries: DataFrame, legacy: DataFrame, locations: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Entries that take over files of an older tree, and the copies (id, kind, source) to make.

    Only entries with a link and without a valid PDF are looked at. A valid PDF of the older tree sets
    their PDF flag. Whether PDF or NXML is taken over, the link becomes the online one again: the
    location (doi, url) chosen for the DOI, if there is one, else it stays as it is. The others pass
    as they are, without a shuffle.
    """
    flagged = init_flags(entries)
    open_ = present(F.col("oa_link")).isNotNull() & ~F.col("has_valid_pdf")
    asked = flagged.where(open_)
    held = legacy_lookup(asked, legacy, root)
    online = spread_join(
        asked.select("id", doi_key(F.col("doi")).alias("doi")).where("doi is not null").join(held.select("id"), "id", "left_semi"),
        locations.where("doi is not null and url is not null").select("doi", F.col("url").alias("_online")),
        ["doi"], "inner", "id").select("id", "_online")
    taken = asked.join(held, "id", "left").join(online, "id", "left").withColumns({
        "has_valid_pdf": F.col("has_valid_pdf") | F.col("pdf_path").isNotNull(),
        "oa_link": F.coalesce("_online", "oa_link"),
    }).drop("pdf_path", "nxml_path", "_online")
    files = F.array(F.struct(F.lit("pdf").alias("kind"), F.col("pdf_path").alias("source")),
                    F.struct(F.lit("nxml").alias("kind"), F.col("nxml_path").alias("source")))
    copies = held.select("id", F.inline(files)).where("source is not null")
    return flagged.where(~open_).unionByName(taken.select(*flagged.columns)), copies


def missing_entries(id_map: DataFrame, entries: DataFrame) -> DataFrame:
    """Map rows whose id has no entry: what a silent failure leaves behind."""
    rows = id_map.withColumn("_k", F.concat_ws(":", "kind", "key"))
    return spread_join(rows, entries.select("id"), ["id"], "left_anti", "_k").select(
        "kind", "key", "id"
    )
