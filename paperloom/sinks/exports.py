"""Catalogue, dump, lists, collection description and the placing of files.

Targets are any path a Hadoop connector serves, object stores included.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import files as store
from paperloom.functions import artifact_name, canonical_json, present, storage_path, target_key
from paperloom.operators.coverage import extra, missed
from paperloom.operators.reports import collection_rows
from paperloom.values import ARTIFACT_SUFFIXES, ENTRY_JSON_NAMES, FLAGS, PUB_MAP_COLUMNS


def ordered_output(df: DataFrame, key: str) -> DataFrame:
    """Rows in key order over the output files, by ranges instead of one sorted task."""
    return df.repartitionByRange(key).sortWithinPartitions(key)


def catalogue(entries: DataFrame, root: str = "") -> DataFrame:
    """(id, line): one JSON object per entry with its identifiers and the paths of its files."""
    stem = F.concat(F.lit(root), storage_path(F.col("id")), F.col("id"))

    def path(kind: str, flag: str | None = None) -> Column:
        full = F.concat(stem, F.lit(ARTIFACT_SUFFIXES[kind]))
        return full if flag is None else F.when(F.col(flag), full)

    fields = {
        "id": F.col("id"),
        "DOI": present(F.col("doi")),
        "pmid": present(F.col("pmid")),
        "pmcid": present(F.col("pmcid")),
        "oaLink": present(F.col("oa_link")),
        "pdf_file_path": path("pdf", "has_valid_pdf"),
        "tei_file_path": path("pdf_tei", "has_valid_tei"),
        "json_metadata_file_path": path("json"),
    }
    line = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return entries.select("id", line.alias("line"))


def dump_metadata(entries: DataFrame) -> DataFrame:
    """(id, line): the whole entry as JSON with sorted keys, absent fields left out.

    There is one DOI key, whichever spelling the record had.
    """
    raw = F.col("raw") if "raw" in entries.columns else None
    fields = {
        ENTRY_JSON_NAMES.get(c, c): F.col(c) if c in FLAGS or c == "cord_sha" else present(F.col(c))
        for c in entries.columns if c not in ("raw", "oa_source")
    }
    return entries.select("id", canonical_json(fields, raw, ("doi",)).alias("line"))


def _write_lines(lines: DataFrame, path: str) -> None:
    ordered_output(lines, "id").select("line").write.mode("errorifexists").text(path)


def write_catalogue(entries: DataFrame, path: str, root: str = "") -> None:
    _write_lines(catalogue(entries, root), path)


def write_dump(entries: DataFrame, path: str) -> None:
    _write_lines(dump_metadata(entries), path)


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.mode("errorifexists").options(header="true", quote='"', escape='"', **options).csv(path)


def write_missed(rows: DataFrame, path: str) -> None:
    write_csv(missed(rows), path)


def write_extra(rows: DataFrame, path: str, root: str = "") -> None:
    write_csv(extra(rows, root), path)


def write_pub_map(rows: DataFrame, path: str) -> None:
    write_csv(rows.select(*PUB_MAP_COLUMNS), path, compression="gzip")


def collection_description(
    release: DataFrame, artifacts: DataFrame, name: str, description: str, version: str, harvester: str
) -> DataFrame:
    """One nested row; `collection_rows` has the same numbers flat.

    The two maps hold one number per year, so their size is the number of distinct years.
    """
    rows = collection_rows(release, artifacts)
    metric = F.col("metric")

    def total(of: str) -> Column:
        return F.max(F.when(metric == of, F.col("n"))).alias(of)

    def years(of: str) -> Column:
        pairs = F.collect_list(F.when(metric == of, F.struct("year", "n")))
        return F.map_from_entries(F.array_sort(pairs)).alias(of)

    counted = rows.agg(
        total("total_entries"), total("total_distinct_entries"), total("total_harvested_entries"),
        years("distribution_entries_per_year"), years("distribution_harvested_per_year"),
    )
    texts = {"name": name, "description": description, "version": version, "harvester": harvester}
    return counted.select(
        *[F.lit(v).alias(k) for k, v in texts.items()], F.struct(*counted.columns).alias("documents")
    )


def write_collection(described: DataFrame, path: str) -> None:
    described.write.mode("errorifexists").json(path)


def place_artifacts(entries: DataFrame) -> DataFrame:
    """(id, kind, path) of every file an entry owns, under the sharded layout."""
    owned = {
        "json": F.lit(True), "pdf": F.col("has_valid_pdf"), "pdf_tei": F.col("has_valid_tei"),
        "ref_annotations": F.col("has_valid_ref_annotation"),
        "thumb_small": F.col("has_valid_thumbnail"), "thumb_medium": F.col("has_valid_thumbnail"),
        "thumb_large": F.col("has_valid_thumbnail"),
    }
    kinds = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in owned.items()]))
    files = entries.select("id", F.explode(kinds).alias("kind"))
    name = artifact_name(F.col("id"), F.col("kind"))
    return files.withColumn("path", target_key(storage_path(F.col("id")), name))


def write_payloads(files: DataFrame, root: str) -> None:
    """Write (path, content) rows, one file each, under `root`; tasks write on their own.

    A file appears under its name when it is whole; a retried task puts the same bytes there again.
    """
    uri = store.file_uri(root)

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = store.store_of(uri)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                store.write_file(target, f"{base}/{path}", [content])
            yield pd.DataFrame({"n": [len(batch)]})

    written = files.select("path", "content").mapInPandas(put, "n long")
    written.write.format("noop").mode("overwrite").save()
