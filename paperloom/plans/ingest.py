"""Incremental updates of the state by releases and identifier lists."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.functions import doi_key, init_flags, present, stable_id
from paperloom.operators.dedup import accept_first_come, last_wins
from paperloom.operators.lookup import BiblioIndex, biblio_from_index, biblio_index, biblio_lookup, resolve_ids
from paperloom.operators.upsert import (
    merge_release, select_failed, union_keys, upsert_entries, upsert_keys, with_data_path,
)
from paperloom.plans.links import link_index, links_from_index
from paperloom.runtime import written
from paperloom.schemas import ENTRY, ID_MAP, conform
from paperloom.values import FLAGS

# The columns by which a release row is identified.
KEYS = ("cord_uid", "doi", "pmcid", "pubmed_id")
# What the ladder of links settles, and what it and the identifier map need of an entry.
LINK = ("oa_link", "oa_source", "has_valid_oa_url")
IDENTITY = ("doi", "pmid", "pmcid", "pii", *dict.fromkeys((*LINK, *FLAGS)))


@dataclass(frozen=True)
class Snapshots:
    """Outside collections an update consults."""

    biblio: DataFrame
    fallback: DataFrame
    pub_map: DataFrame
    pub_files: DataFrame
    legacy: DataFrame
    pmc_oa: DataFrame
    locations: DataFrame
    pub_base: str
    legacy_root: str
    # Kept indexes of the first two and of the others, which spare a pass over them.
    index: BiblioIndex | None = None
    links: DataFrame | None = None


def keep_snapshots(snapshots: Snapshots) -> Snapshots:
    """`snapshots` for several updates: what each of them would derive anew is written once, in narrow rows."""
    index, links = snapshots.index, snapshots.links
    if index is None:
        found = biblio_index(snapshots.biblio, snapshots.fallback)
        index = BiblioIndex(written(found.keys, "biblio-keys"), found.records)
    if links is None:
        # The map is read twice, as its join is measured first.
        mapped = replace(snapshots, pub_map=written(snapshots.pub_map, "pub-map"))
        links = written(_link_index(mapped), "links")
    return replace(snapshots, index=index, links=links)


@dataclass(frozen=True)
class Ingested:
    """Outcome of an update: what it changed. `errors` (reason, line) are rows that no key identifies."""

    changed: DataFrame
    keys: DataFrame
    errors: DataFrame

    def entries(self, before: DataFrame) -> DataFrame:
        return upsert_entries(conform(before, ENTRY), self.changed)

    def id_map(self, before: DataFrame) -> DataFrame:
        return upsert_keys(before, self.keys)


def sample(rows: DataFrame, n: int) -> DataFrame:
    """A repeatable sample of `n` articles: those whose id has the lowest digest."""
    return rows.orderBy(F.md5("id"), "id").limit(n)


def _sampled(rows: DataFrame, n: int | None) -> DataFrame:
    """`rows` (id, ...), or those of a sample of `n` articles."""
    return rows if n is None else rows.join(sample(rows.select("id"), n), "id", "left_semi")


def _found(asked: DataFrame, snapshots: Snapshots) -> DataFrame:
    if snapshots.index is not None:
        return biblio_from_index(asked, snapshots.index)
    return biblio_lookup(asked, snapshots.biblio, snapshots.fallback)


def rejected(rows: DataFrame, reason: str) -> DataFrame:
    """(reason, line) of rows for the ledger of errors, as JSON without their place, equal rows once."""
    columns = [c for c in rows.columns if c != "row_no"]
    return rows.select(F.lit(reason).alias("reason"), F.to_json(F.struct(*columns)).alias("line")).distinct()


def with_retries(release: DataFrame, errors: DataFrame) -> DataFrame:
    """`release` behind the rows of a ledger of errors (reason, line), which are tried again first."""
    columns = [c for c in release.columns if c != "row_no"]
    schema = StructType([release.schema[c] for c in columns])
    lines = errors.select("line").distinct()
    again = F.struct(F.lit(0).alias("turn"), F.lit(None).cast(release.schema["row_no"].dataType).alias("row"), F.md5("line").alias("digest"))
    fresh = F.struct(F.lit(1).alias("turn"), F.col("row_no").alias("row"), F.lit("").alias("digest"))
    old = lines.select(again.alias("row_no"), F.from_json("line", schema).alias("r")).select("row_no", "r.*")
    return old.unionByName(release.select(fresh.alias("row_no"), *columns))


def _link_index(snapshots: Snapshots) -> DataFrame:
    s = snapshots
    return link_index(s.pub_map, s.pub_files, s.legacy, s.pmc_oa, s.locations, s.pub_base, s.legacy_root)


def _linked(entries: DataFrame, snapshots: Snapshots) -> DataFrame:
    return links_from_index(entries, _link_index(snapshots) if snapshots.links is None else snapshots.links)


def _link(entries: DataFrame, snapshots: Snapshots) -> DataFrame:
    return conform(with_data_path(_linked(entries, snapshots)), ENTRY)


def _as_record(entries: DataFrame) -> DataFrame:
    return conform(entries, ENTRY).select("id", F.struct(*ENTRY.names).alias("record"))


def ingest_release(
    entries: DataFrame, id_map: DataFrame, release: DataFrame, snapshots: Snapshots,
    sample: int | None = None, errors: DataFrame | None = None,
) -> Ingested:
    """Take the rows of a release that are new, in file order, into the state.

    Known rows are skipped, so a second run over the same release changes nothing. `sample` takes that
    many of the new articles only. `errors` are the rows that the last run could not take; they are
    tried again before the release, and those that fail once more are errors of this run too.
    """
    if errors is not None:
        release = with_retries(release, errors)
    taken = accept_first_come(release.select("row_no", *KEYS), id_map)
    uid, doi = present(F.col("cord_uid")), doi_key(F.col("doi"))
    pmcid, pmid = present(F.col("pmcid")), present(F.col("pubmed_id"))
    article = F.coalesce(
        uid,
        stable_id(F.lit("doi"), doi),
        stable_id(F.lit("pmcid"), pmcid),
        stable_id(F.lit("pmid"), pmid),
    )
    # Rows without uid and DOI may still share a PMC id or PMID; the last such row counts, unless the
    # map holds the id that follows from it.
    keyless = uid.isNull() & doi.isNull()
    mapped = id_map.where("kind = 'id'").select(F.col("key").alias("id"))
    identified = written(taken.withColumn("id", article), "identified")
    # A row without any key has no rival and is in no map, so it is always taken: its own columns tell.
    failed = rejected(release.where(article.isNull()), "no identifier")
    identified = identified.where("id is not null")
    fresh = identified.where(~keyless).unionByName(
        identified.where(keyless).join(mapped, "id", "left_anti"))
    rows = written(_sampled(last_wins(fresh, ["id"], "row_no"), sample), "rows")
    if rows.isEmpty():
        return Ingested(conform(rows.limit(0), ENTRY), conform(rows.limit(0), ID_MAP), failed)

    # Few of the rows have an entry already. Ids tell which, so whole entries are read for those alone.
    held = written(rows.select("row_no", "id").join(entries.select("id"), "id", "left_semi"), "held")
    unknown = rows.join(held.select("row_no"), "row_no", "left_anti")
    asked = unknown.select(
        "row_no", F.col("doi"), F.col("pubmed_id").alias("pmid"), F.col("pmcid")
    )
    records = _record(_found(asked, snapshots))
    if not held.isEmpty():
        records = held.join(_as_record(entries), "id").select("row_no", "record").unionByName(records)
    # The ladder of links reads its entries several times, and needs identifiers and flags alone. The
    # wide rows of the release are joined to what was found and settled for them, and written, once.
    found = written(rows.join(records, "row_no", "left"), "found")
    narrow = merge_release(found, "row_no").select("row_no", "id", *IDENTITY)
    link = F.struct(*LINK).alias("link")
    settled = found.select("row_no", "id", "record").join(_linked(narrow, snapshots).select("id", link), "id")
    merged = merge_release(release.join(settled, "row_no"), "link")
    linked = merged.withColumns({n: F.col("link")[n] for n in LINK})
    changed = written(conform(with_data_path(linked), ENTRY), "changed")
    return Ingested(changed, _last_keys(union_keys(narrow, "row_no")), failed)


def _record(found: DataFrame) -> DataFrame:
    """(row_no, record): looked-up fields in the shape of an entry."""
    schema = StructType([found.schema["row_no"], *ENTRY.fields])
    return conform(found, schema).select("row_no", F.struct(*ENTRY.names).alias("record"))


def _last_keys(keyed: DataFrame) -> DataFrame:
    return last_wins(keyed, ["kind", "key"], "row_no").select("kind", "key", "id")


def ingest_ids(
    entries: DataFrame, id_map: DataFrame, keys: DataFrame, snapshots: Snapshots, sample: int | None = None
) -> Ingested:
    """Take a list (row_no, kind, key) into the state.

    Unlike releases, known identifiers are processed again under their id. An entry keeps
    the identifier it was asked for. Where several lines lead to one id, the last one counts.
    `sample` takes that many articles only.
    """
    resolved = resolve_ids(keys, id_map).where("id is not null")
    last = last_wins(resolved, ["id"], "row_no").select("row_no", "kind", "key", "id")
    rows = written(_sampled(last, sample), "rows")
    given = {k: F.when(F.col("kind") == k, F.col("key")) for k in ("doi", "pmid", "pmcid")}

    known = rows.select("row_no", "id").join(_as_record(entries), "id", "inner")
    unknown = rows.join(known.select("row_no"), "row_no", "left_anti")
    looked_up = _found(unknown.select("row_no", *[c.alias(k) for k, c in given.items()]), snapshots)
    records = known.select("row_no", "record").unionByName(_record(looked_up))
    joined = rows.join(records, "row_no", "left")
    record = F.col("record")
    filled = joined.select("id", *[
        (F.coalesce(given[n], record[n]) if n in given else record[n]).alias(n)
        for n in ENTRY.names if n != "id"
    ])
    merged = written(init_flags(filled), "merged")
    changed = written(_link(merged, snapshots), "changed")
    keyed = rows.select("id", "row_no").join(union_keys(merged), "id")
    return Ingested(changed, _last_keys(keyed), rejected(keys.where("key is null"), "no identifier"))


def reprocess_failed(
    entries: DataFrame, snapshots: Snapshots, thumbnail: bool = False, annotation: bool = False
) -> DataFrame:
    """The entries that failed, looked up again; `upsert_entries` puts them back."""
    return _link(select_failed(conform(entries, ENTRY), thumbnail, annotation), snapshots)
