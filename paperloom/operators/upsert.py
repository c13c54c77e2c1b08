"""Changes of state: merge, upsert, selection, flags."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.functions import doi_key, init_flags, present, storage_path
from paperloom.operators.coverage import kinds_by_article
from paperloom.schemas import ENTRY, conform
from paperloom.values import FLAGS


def merge_release(rows: DataFrame, *carried: str) -> DataFrame:
    """Entries of release rows, each with `id` and a struct `record` of what was found, or null.

    Title and year come from the row only if nothing was found. The id and the digest are
    always the row's, blank digest included. License, abstract and the two outside ids are
    overwritten where the row has a value; article identifiers are only filled where absent.
    Columns named by `carried` stay beside the entry.
    """
    known = set(rows.schema["record"].dataType.names)
    record = F.col("record")

    def old(name: str) -> Column:
        return record[name] if name in known else F.lit(None).cast(ENTRY[name].dataType)

    def row(name: str) -> Column:
        return present(F.col(name)) if name in rows.columns else F.lit(None).cast("string")

    nothing = record.isNull()
    merged = {
        "id": F.col("id"),
        "title": F.when(nothing, row("title")).otherwise(old("title")),
        "year": F.when(nothing, row("publish_time")).otherwise(old("year")),
        "cord_sha": F.col("sha") if "sha" in rows.columns else old("cord_sha"),
    }
    overwritten = {"license_simplified": "license", "abstract": "abstract", "mag_id": "mag_id",
                   "who_covidence": "who_covidence_id"}
    filled = {"doi": "doi", "pmcid": "pmcid", "pmid": "pubmed_id", "arxiv_id": "arxiv_id"}
    merged |= {to: F.coalesce(row(frm), old(to)) for to, frm in overwritten.items()}
    merged |= {to: F.coalesce(present(old(to)), row(frm)) for to, frm in filled.items()}
    merged |= {n: old(n) for n in ("pii", "oa_link", "oa_source", *FLAGS, "data_path", "raw")}
    schema = StructType([*ENTRY.fields, *[rows.schema[c] for c in carried]])
    return init_flags(conform(rows.select(*[c.alias(n) for n, c in merged.items()], *carried), schema))


def union_keys(entries: DataFrame, *carried: str) -> DataFrame:
    """(kind, key, id) of every identifier an entry carries, and the columns `carried`; its id is a key as well."""
    names = [n for n in ("id", "doi", "pmcid", "pmid") if n in entries.columns]
    keys = F.array(*[
        F.struct(F.lit(n).alias("kind"),
                 (doi_key(F.col(n)) if n == "doi" else present(F.col(n))).alias("key"))
        for n in names
    ])
    return entries.select("id", *carried, F.inline(keys)).where("key is not null").select("kind", "key", "id", *carried)


def upsert_keys(id_map: DataFrame, keys: DataFrame) -> DataFrame:
    """Identifier map after `keys`, unique by (kind, key), have been put."""
    kept = id_map.select("kind", "key", "id").join(keys, ["kind", "key"], "left_anti")
    return kept.unionByName(keys)


def latest_keys(entries: DataFrame, order: str) -> DataFrame:
    """The keys of `entries`, one row each; where ids share a key, the last put holds it.

    `order` is the column that puts follow; of equal places the greater id counts as later.
    """
    put = entries.select("id", F.col(order).alias("_put"))
    keys = union_keys(entries).join(put, "id")
    return keys.groupBy("kind", "key").agg(F.max_by("id", F.struct("_put", "id")).alias("id"))


def upsert_id_map(id_map: DataFrame, entries: DataFrame, order: str) -> DataFrame:
    """Identifier map after every entry, unique by id, has put its keys in `order`; the last put wins."""
    return upsert_keys(id_map, latest_keys(entries, order))


def upsert_entries(entries: DataFrame, new: DataFrame) -> DataFrame:
    """Entries after `new`, unique by id, have replaced those of the same id.

    The old table needs no shuffle while the new ids fit a broadcast.
    """
    kept = entries.join(new.select("id"), "id", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def select_failed(entries: DataFrame, thumbnail: bool = False, annotation: bool = False) -> DataFrame:
    """Entries to process again: a needed flag is not set."""
    needed = ["has_valid_oa_url", "has_valid_pdf", "has_valid_tei"]
    needed += ["has_valid_thumbnail"] if thumbnail else []
    needed += ["has_valid_ref_annotation"] if annotation else []
    done = F.lit(True)
    for flag in needed:
        done = done & F.coalesce(F.col(flag), F.lit(False))
    return entries.where(~done)


def advance_flags(entries: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Flags set from the files found for an entry; a set flag is never taken back.

    `artifacts` has id, kind and `valid`, which content decides: a file that is empty, or an error
    page under the name of a PDF, sets nothing.
    """
    found = kinds_by_article(
        artifacts.where("valid"), found_pdf=("pdf",), found_tei=("pdf_tei",),
        found_ref_annotation=("ref_annotations",), found_thumbnail=("thumb_small",),
    )
    joined = init_flags(entries).join(found, "id", "left")
    names = [c for c in found.columns if c != "id"]
    return joined.withColumns({
        n.replace("found_", "has_valid_"):
            F.col(n.replace("found_", "has_valid_")) | F.coalesce(F.col(n), F.lit(False))
        for n in names
    }).drop(*names)


def with_data_path(entries: DataFrame) -> DataFrame:
    return entries.withColumn("data_path", storage_path(F.col("id")))
