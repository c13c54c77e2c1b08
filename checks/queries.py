"""Every registered query, on the views of `checks.views`. Each reads its whole tables."""

import gzip
import io
import tarfile
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import LEGACY_ROOT, PUB_BASE, TABLES, view
from paperloom import functions as fn
from paperloom import plans, sinks, sources, streaming
from paperloom.operators import archives, coverage, dedup, fetch, lookup, reports, upsert
from paperloom.files import file_uri
from paperloom.operators.joins import shuffle_tasks, spread_join
from paperloom.plans import Snapshots, ingest_ids, ingest_release, resolve_oa_link
from paperloom.plans import sample as take_sample
from paperloom.runtime import fresh_path
from paperloom.sources.listings import artifact_index
from paperloom.values import FLAGS

REGISTRY = {}
ENTRY_OUT = ("id", "doi", "pmid", "pmcid", "pii", "title", "year", "cord_sha", "license_simplified",
             "abstract", "oa_link", "oa_source", *FLAGS, "data_path")


def query(make):
    """Register `make(views) -> DataFrame` under its own name, less a `_query` at its end."""
    REGISTRY[make.__name__.removesuffix("_query")] = lambda spark, sf_dir: make(Views(spark, sf_dir))
    return make


class Views:
    """Attribute access to the views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.table = cache(lambda name: spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet"))
        self.view = cache(lambda name: view(name, self.table))

    def __getattr__(self, name: str) -> DataFrame:
        return self.view(f"fx_{name}")

    def path(self, name: str) -> str:
        return fresh_path(self.spark, name)

    @property
    def artifacts(self) -> DataFrame:
        return artifact_index(self.files.select("path", "size"))

    @property
    def judged(self) -> DataFrame:
        """The files with a verdict on their content."""
        heads = self.files.select("path", "size", F.unhex("head_hex").alias("head"))
        return fn.judge_artifacts(artifact_index(heads)).drop("head")

    @property
    def payload_bytes(self) -> DataFrame:
        return self.payloads.select("id", F.unhex("payload_hex").alias("payload"))

    @property
    def snapshots(self) -> Snapshots:
        return Snapshots(
            biblio=self.biblio, fallback=self.crossref.drop("reference"),
            pub_map=sources.index_pub_map(self.pub_map), pub_files=self.pub_files,
            legacy=self.judged, pmc_oa=sources.index_pmc_oa(self.pmc_oa),
            locations=lookup.choose_flat_location(self.oa_loc),
            pub_base=PUB_BASE, legacy_root=LEGACY_ROOT,
        )

    @property
    def coverage(self) -> DataFrame:
        return coverage.coverage_rows(self.meta, sources.index_official(self.official), self.artifacts)


# Scalar functions


@query
def clean_doi(v):
    return v.meta.select("row_no", "doi", fn.clean_doi(F.col("doi")).alias("cleaned"))


@query
def storage_path(v):
    return v.entries.select("id", fn.storage_path(F.col("id")).alias("path"))


@query
def init_flags(v):
    flags = v.entries.select(F.col("id").alias("cord_uid"), *FLAGS)
    rows = spread_join(v.meta.select("row_no", "cord_uid"), flags, ["cord_uid"], "left", "row_no")
    return fn.init_flags(rows)


@query
def content_validity(v):
    return fetch.content_validity(v.payload_bytes, "pdf")


@query
def redirect_links(v):
    return v.payload_bytes.select("id", fn.redirect_link(F.col("payload")).alias("link"))


# Indexes over listings


@query
def artifact_index_query(v):
    return v.artifacts


@query
def pmc_oa_index(v):
    return sources.index_pmc_oa(v.pmc_oa)


@query
def pub_map_index(v):
    return sources.index_pub_map(v.pub_map)


@query
def official_index(v):
    return sources.index_official(v.official)


# Lookups


def _keys(v) -> DataFrame:
    """Identifiers of the release as one list (row_no, kind, key)."""
    keys = F.array(
        F.struct(F.lit("doi").alias("kind"), fn.doi_key(F.col("doi")).alias("key")),
        F.struct(F.lit("pmid").alias("kind"), fn.present(F.col("pubmed_id")).alias("key")),
        F.struct(F.lit("pmcid").alias("kind"), fn.present(F.col("pmcid")).alias("key")),
    )
    return v.meta.select("row_no", F.inline(keys)).where("key is not null")


@query
def resolve_ids(v):
    return lookup.resolve_ids(_keys(v), v.id_map)


@query
def not_yet_seen(v):
    return dedup.not_yet_seen(v.meta, v.id_map).select("row_no", "cord_uid", "doi")


@query
def reuse_entries(v):
    resolved = lookup.resolve_ids(_keys(v).where("kind = 'doi'"), v.id_map)
    return lookup.reuse_entries(resolved, v.entries).select(
        "row_no", "id", "known", F.col("entry").isNotNull().alias("reused"),
        F.col("entry.doi").alias("entry_doi"), F.col("entry.pmid").alias("entry_pmid"),
        F.col("entry.oa_link").alias("entry_oa_link"),
    )


def _asked(v) -> DataFrame:
    """Release rows as lookup keys; a few carry an archive id as well."""
    return v.meta.select(
        "row_no", "doi", F.col("pubmed_id").alias("pmid"), "pmcid",
        F.substring(F.md5(F.concat(F.lit("istex"), F.col("row_no").cast("string"))), 1, 12).alias("istexid"),
    )


@query
def biblio_lookup(v):
    return lookup.biblio_lookup(_asked(v), v.biblio, v.crossref).drop("raw")


@query
def biblio_from_index(v):
    """The same through an index that was kept."""
    path = v.path("index")
    sinks.write_biblio_index(v.spark, v.biblio, path, v.crossref)
    return lookup.biblio_from_index(_asked(v), sources.read_biblio_index(v.spark, path)).drop("raw")


@query
def pub_file_lookup(v):
    return lookup.pub_file_lookup(v.entries, sources.index_pub_map(v.pub_map), v.pub_files, PUB_BASE)


@query
def pmc_lookup(v):
    return lookup.pmc_lookup(v.entries, sources.index_pmc_oa(v.pmc_oa))


@query
def choose_location(v):
    return lookup.choose_flat_location(v.oa_loc)


@query
def legacy_lookup(v):
    return lookup.legacy_lookup(v.entries, v.judged, LEGACY_ROOT)


def _reused(v) -> tuple[DataFrame, DataFrame]:
    """Entries of which some with a file in the older tree lack a PDF, and some of these a link."""
    link = F.when(F.col("pmid").isNotNull(), F.coalesce("oa_link", F.lit("https://example.org/lost")))
    entries = v.entries.withColumns({"has_valid_pdf": F.col("has_valid_tei"), "oa_link": link})
    return lookup.reuse_legacy(entries, v.judged, lookup.choose_flat_location(v.oa_loc), LEGACY_ROOT)


@query
def reuse_legacy(v):
    return _reused(v)[0].select("id", "oa_link", "has_valid_oa_url", "has_valid_pdf")


@query
def reuse_legacy_copies(v):
    return _reused(v)[1]


@query
def resolve_oa_link_query(v):
    s = v.snapshots
    linked = resolve_oa_link(
        v.entries, s.pub_map, s.pub_files, s.legacy, s.pmc_oa, s.locations, s.pub_base, s.legacy_root
    )
    return linked.select("id", "doi", "oa_link", "oa_source", "has_valid_oa_url", "has_valid_pdf")


@query
def missing_entries(v):
    return lookup.missing_entries(v.id_map, v.entries)


# Coverage and reports


@query
def coverage_rows(v):
    return v.coverage


@query
def coverage_report(v):
    return reports.coverage_report(v.coverage, v.meta.agg(F.count("*").alias("n_rows")))


@query
def missed_entries(v):
    return coverage.missed(v.coverage)


@query
def extra_entries(v):
    return coverage.extra(v.coverage)


@query
def both_entries(v):
    return coverage.both(v.coverage).select("cord_uid", "has_pdf_tei", "has_jats_tei")


@query
def entries_per_year(v):
    return reports.entries_per_year(v.meta)


@query
def harvested_per_year(v):
    return reports.harvested_per_year(v.meta, v.artifacts)


@query
def collection_description(v):
    return reports.collection_rows(v.meta, v.artifacts)


@query
def collection_totals(v):
    nested = sinks.collection_description(v.meta, v.artifacts, "sample", "test", "1", "paperloom")
    return nested.select(
        "name", "documents.total_entries", "documents.total_distinct_entries", "documents.total_harvested_entries",
        F.size("documents.distribution_entries_per_year").cast("bigint").alias("n_years"),
        F.size("documents.distribution_harvested_per_year").cast("bigint").alias("n_years_harvested"),
    )


@query
def tei_presence(v):
    return coverage.tei_presence(v.artifacts)


@query
def tei_report(v):
    return reports.tei_report(v.artifacts)


@query
def state_waterfall(v):
    return reports.state_waterfall(v.entries)


@query
def identifier_integrity(v):
    return reports.identifier_integrity(v.id_map, v.entries)


@query
def duplicate_census(v):
    return reports.duplicate_census(v.meta)


# Which row counts


@query
def first_per_uid(v):
    return dedup.first_by(v.meta.select("row_no", "cord_uid", "doi", "publish_time"), ["cord_uid"], "row_no")


@query
def accept_first_come(v):
    return dedup.accept_first_come(v.meta).select("row_no", "cord_uid", "doi")


@query
def accept_after_earlier_run(v):
    return dedup.accept_first_come(v.meta, v.id_map).select("row_no", "cord_uid", "doi")


@query
def accept_long_chain(v):
    """All articles in one chain: each shares its uid with the one before or its DOI, in turn."""
    uid = F.concat(F.lit("u"), F.floor((F.col("row_no") + 1) / 2))
    doi = F.concat(F.lit("10.1/"), F.floor(F.col("row_no") / 2))
    chained = v.meta.select("row_no", uid.alias("cord_uid"), doi.alias("doi"))
    return dedup.accept_first_come(chained).select("row_no", "cord_uid", "doi")


@query
def select_members(v):
    return dedup.select_members(v.members)


@query
def first_success(v):
    return dedup.first_success(v.attempts)


@query
def conversion_batch(v):
    return archives.conversion_batch(v.artifacts)


# State


@query
def merge_release(v):
    found = lookup.biblio_lookup(_asked(v).drop("istexid"), v.biblio)
    record = F.struct(*[c for c in found.columns if c != "row_no"]).alias("record")
    rows = v.meta.withColumn("id", F.col("cord_uid")).join(found.select("row_no", record), "row_no", "left")
    return upsert.merge_release(rows).select(*[c for c in ENTRY_OUT if c not in ("oa_source", "data_path")])


def _updates(v) -> DataFrame:
    """A new version of the first entry of every release uid."""
    firsts = dedup.first_by(
        v.meta.select("row_no", F.col("cord_uid").alias("id"), "doi", F.col("pubmed_id").alias("pmid"), "pmcid"),
        ["id"], "row_no",
    )
    return firsts.select("id", "row_no", *[fn.present(F.col(c)).alias(c) for c in ("doi", "pmid", "pmcid")])


@query
def upsert_id_map(v):
    return upsert.upsert_id_map(v.id_map, _updates(v), "row_no")


@query
def upsert_entries(v):
    return upsert.upsert_entries(v.entries, _updates(v)).select("id", "doi", "pmid", "pmcid", "oa_link")


@query
def select_failed(v):
    return upsert.select_failed(v.entries).select("id")


@query
def select_failed_with_extras(v):
    return upsert.select_failed(v.entries, thumbnail=True, annotation=True).select("id")


@query
def advance_flags(v):
    return upsert.advance_flags(v.entries, v.judged).select("id", *FLAGS)


@query
def ingest_release_query(v):
    done = ingest_release(v.entries, v.id_map, v.meta, v.snapshots)
    return done.entries(v.entries).select(*ENTRY_OUT)


@query
def ingest_release_keys(v):
    done = ingest_release(v.entries, v.id_map, v.meta, v.snapshots)
    return done.id_map(v.id_map)


@query
def ingest_sample(v):
    """A run that takes twenty of the new articles."""
    done = ingest_release(v.entries, v.id_map, v.meta, v.snapshots, sample=20)
    return done.changed.select(*ENTRY_OUT)


@query
def ingest_errors(v):
    """The ledger after two runs of a release of which every seventh row has no key at all."""
    blank = F.col("row_no") % 7 == 0
    keys = ("cord_uid", "doi", "pmcid", "pubmed_id")
    release = v.meta.withColumns({c: F.when(blank, F.lit("")).otherwise(F.col(c)) for c in keys})
    root, snapshots = v.path("state"), plans.keep_snapshots(v.snapshots)
    for batch in ("first", "second"):
        entries, id_map = sources.read_state(v.spark, root)
        done = ingest_release(entries, id_map, release, snapshots, errors=sources.read_errors(v.spark, root, last=True))
        sinks.write_state(v.spark, root, done.changed, done.keys, batch, errors=done.errors)
    line = F.from_json("line", "title string, source_x string")
    return sources.read_errors(v.spark, root).select("version", "batch", "reason", line["title"].alias("title"))


@query
def ingest_release_again(v):
    """The same release twice: the second run changes nothing."""
    once = ingest_release(v.entries, v.id_map, v.meta, v.snapshots)
    again = ingest_release(once.entries(v.entries), once.id_map(v.id_map), v.meta, v.snapshots)
    return once.changed.select("id", F.lit("first").alias("run")).unionByName(again.changed.select("id", F.lit("second").alias("run")))


@query
def ingest_id_list(v):
    return _ingest_list(v, "doi")


@query
def ingest_pmid_list(v):
    return _ingest_list(v, "pmid")


@query
def ingest_pmcid_list(v):
    return _ingest_list(v, "pmcid")


def _ingest_list(v, kind: str) -> DataFrame:
    done = ingest_ids(v.entries, v.id_map, _keys(v).where(F.col("kind") == kind), v.snapshots)
    return done.changed.select(*[c for c in ENTRY_OUT if c not in ("cord_sha", "license_simplified", "abstract")])


@query
def reprocess_failed(v):
    again = plans.reprocess_failed(v.entries, v.snapshots)
    return again.select("id", "oa_link", "oa_source", *FLAGS, "data_path")


@query
def sample_articles(v):
    return take_sample(v.entries, 20).select("id")


# Fetching


@query
def fetch_plan(v):
    linked = resolve_oa_link_query(v)
    plan = fetch.fetch_plan(linked)
    return plan.select(
        "id", "url", "class", "target", F.concat_ws(",", "transports").alias("transports"), "host"
    )


@query
def redirect_plan(v):
    pages = v.hops.select("url", F.unhex("payload_hex").alias("payload"))
    return fetch.redirect_plan(v.starts, pages)


@query
def apply_fetch_results(v):
    done = fetch.apply_fetch_results(v.entries, v.attempts, v.payload_bytes)
    return done.select("id", "has_valid_pdf", "fetch_status")


# Sinks


@query
def catalogue(v):
    return sinks.catalogue(v.entries)


@query
def dump_metadata(v):
    return sinks.dump_metadata(v.entries)


@query
def dump_open_records(v):
    """The dump of entries that carry a whole open record."""
    raw = F.to_variant_object(F.struct(
        F.lit(1).alias("z"), F.col("pii").alias("pii"), F.lit("old").alias("DOI"), F.col("pmid").alias("note")))
    return sinks.dump_metadata(v.entries.select("id", "doi", "pmcid", raw.alias("raw")))


@query
def place_artifacts(v):
    return sinks.place_artifacts(v.entries)


@query
def place_found_artifacts(v):
    return sinks.place_found(v.entries, v.judged)


# Through files: derived from the tables, written with a sink, read with a source


def _written_lines(v, lines: DataFrame, name: str) -> str:
    """Write ordered lines (n, value) as text and give the path."""
    path = v.path(name)
    lines.repartitionByRange("n").sortWithinPartitions("n").select("value").write.text(path)
    return path


@query
def release_files(v):
    path = v.path("release")
    sinks.write_csv(v.meta.drop("row_no"), path)
    return sources.read_release(v.spark, path).drop("row_no", "authors", "journal", "mag_id", "who_covidence_id", "arxiv_id")


@query
def id_list_files(v):
    lists = []
    for kind, column in (("doi", "doi"), ("pmid", "pubmed_id"), ("pmcid", "pmcid")):
        lines = v.meta.select(F.col("row_no").alias("n"), F.concat(F.lit(" "), column, F.lit("\t")).alias("value"))
        lists.append(sources.read_id_list(v.spark, _written_lines(v, lines, kind), kind).select("kind", "key"))
    return lists[0].unionByName(lists[1]).unionByName(lists[2]).groupBy("kind", "key").agg(F.count("*").alias("n"))


@query
def id_list_sizes(v):
    lines = v.meta.select(F.col("row_no").alias("n"), F.col("pmcid").alias("value"))
    return sources.id_list_size(v.spark, _written_lines(v, lines, "sizes"))


@query
def pmc_oa_files(v):
    value = F.concat_ws("\t", "subpath", F.lit("cite"), "pmcid", "pmid", "license")
    return sources.read_pmc_oa(v.spark, _pmc_list(v, value))


def _pmc_list(v, value) -> str:
    """The archive list with a time stamp on top, and a torn line after every tenth article."""
    lines = v.pmc_oa.select((F.col("line_no") * 2).alias("n"), value.alias("value"))
    torn = v.pmc_oa.where("line_no % 10 = 0").select(
        (F.col("line_no") * 2 + 1).alias("n"), F.concat_ws("\t", "subpath", "pmcid").alias("value"))
    stamp = lines.agg((F.min("n") - 1).alias("n"), F.lit("2020-09-11 10:00:00").alias("value"))
    return _written_lines(v, lines.unionByName(torn).unionByName(stamp), "pmc")


@query
def pmc_oa_errors(v):
    value = F.concat_ws("\t", "subpath", F.lit("cite"), "pmcid", "pmid", "license")
    return sources.read_pmc_oa_errors(v.spark, _pmc_list(v, value)).select("line")


@query
def pub_map_files(v):
    path = v.path("pubmap")
    ordered = v.pub_map.repartitionByRange("line_no").sortWithinPartitions("line_no")
    sinks.write_pub_map(ordered, path)
    return sources.read_pub_map(v.spark, path)


def _put(v, files: DataFrame, name: str) -> str:
    """Write (path, content) rows as single files under a new folder."""
    root = v.path(name)
    sinks.write_payloads(files, root)
    return root


@query
def publisher_meta_files(v):
    core = F.struct(
        F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("10.1/"), F.col("page_id").cast("string"))).alias("prism:doi"),
        F.concat(F.lit("S"), F.col("page_id").cast("string")).alias("pii"),
    )
    body = F.struct(core.alias("coredata"), F.when(F.col("page_id") % 2 == 0, F.col("page_id").cast("string")).alias("pubmed-id"))
    files = v.table("pages").select(
        F.concat(F.lit("S"), F.col("page_id").cast("string"), F.lit("_meta.json")).alias("path"),
        F.to_json(F.struct(body.alias("full-text-retrieval-response"), F.col("html").alias("page"))).cast("binary").alias("content"),
    )
    return sources.read_publisher_meta(v.spark, _put(v, files, "pubmeta"))


def _tree(v) -> DataFrame:
    """A harvested tree with one file per page."""
    kinds = F.array(*[F.lit(k) for k in ("pdf", "pdf_tei", "json", "ref_annotations", "thumb_small", "nxml", "jats_tei")])
    page = v.table("pages").select(
        F.substring(F.md5(F.col("page_id").cast("string")), 1, 12).alias("id"),
        F.element_at(kinds, (F.col("page_id") % 7 + 1).cast("int")).alias("kind"),
        F.col("html").cast("binary").alias("content"),
    )
    return page.select(
        F.concat(fn.storage_path(F.col("id")), fn.artifact_name(F.col("id"), F.col("kind"))).alias("path"), "content"
    )


@query
def artifact_scan(v):
    return sources.scan_artifacts(v.spark, _put(v, _tree(v), "tree")).select("id", "kind", "file", "size")


def _mixed_tree(v) -> DataFrame:
    """A tree with one file per page, a third of which is not what its name says, or cut off."""
    page = F.col("page_id")
    html, tail = F.col("html"), F.col("page_id").cast("string")
    right = (
        F.when(F.col("kind") == "pdf", F.concat(F.lit("%PDF-1.7 "), html))
        .when(F.col("kind").isin("pdf_tei", "nxml", "jats_tei"), F.concat(F.lit(" \n<?xml version='1.0'?>"), html))
        .otherwise(F.concat(F.lit('["'), F.repeat(tail, 300), F.lit('"'), F.when(page % 4 != 0, F.lit("]")).otherwise(F.lit("")))))
    content = F.when(page % 3 == 0, F.when(page % 2 == 0, html).otherwise(F.lit(""))).otherwise(right).cast("binary")
    content = F.when((F.col("kind") == "thumb_small") & (page % 3 != 0), F.concat(F.lit(b"\x89PNG\r\n\x1a\n"), html.cast("binary"))).otherwise(content)
    kinds = F.array(*[F.lit(k) for k in ("pdf", "pdf_tei", "json", "ref_annotations", "thumb_small", "nxml", "jats_tei")])
    rows = v.table("pages").select("page_id", "html", F.element_at(kinds, (page % 7 + 1).cast("int")).alias("kind"))
    article = F.substring(F.md5(F.col("page_id").cast("string")), 1, 12)
    return rows.select(
        F.concat(fn.storage_path(article), fn.artifact_name(article, F.col("kind"))).alias("path"), content.alias("content"))


@query
def artifact_validity(v):
    """Files of a real tree, judged by what tasks read of them."""
    return sources.scan_judged(v.spark, _put(v, _mixed_tree(v), "mixed")).select("id", "kind", "size", "valid")


@query
def official_scan(v):
    name = F.md5(F.col("page_id").cast("string"))
    files = v.table("pages").select(
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("document_parses/pmc_json/PMC"), F.col("page_id").cast("string"), F.lit(".xml.json")))
        .otherwise(F.concat(F.lit("document_parses/pdf_json/"), name, F.lit(".json"))).alias("path"),
        F.lit(b"{}").alias("content"),
    )
    return sources.scan_official(v.spark, _put(v, files, "official"))


def _packed(v) -> DataFrame:
    """One archive (id, content) per page; some are broken, some lack a PDF."""
    def packed(page: int, html: str) -> tuple[str, bytes]:
        buffer, body = io.BytesIO(), html.encode()
        members = [("a.txt", body)]
        if page % 5:
            members += [("p/one.PDF", b"%PDF-1.7 " + body), ("p/two.pdf", b"%PDF-1.4 x")]
        if page % 3:
            members += [("n/first.nxml", b"<a/>"), ("n/last.nxml", body)]
        with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
            for name, content in members:
                info = tarfile.TarInfo(name)
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
        content = buffer.getvalue()
        return f"a{page}", content if page % 11 else b"not an archive" + body

    def pack(batches):
        rows = (packed(*row) for row in archives.rows_of(batches))
        yield from archives.gathered(rows, pa.schema([("id", pa.string()), ("content", pa.binary())]))

    pages = v.table("pages")
    return pages.repartition(shuffle_tasks(pages), "page_id").select("page_id", "html").mapInArrow(pack, "id string, content binary")


def _members_found(found: DataFrame) -> DataFrame:
    return found.select(
        "id", "pdf_name", F.md5("pdf").alias("pdf_md5"), "nxml_name", F.md5("nxml").alias("nxml_md5"),
        "no_pdf", F.col("error").isNotNull().alias("failed"),
    )


@query
def extract_archives(v):
    return _members_found(archives.extract_archives(_packed(v)))


@query
def archive_files(v):
    files = _packed(v).select(F.concat("id", F.lit(".tar.gz")).alias("path"), "content")
    root = _put(v, files, "archives")
    return _members_found(archives.extract_archives(sources.read_content(sources.scan_archives(v.spark, root), root)))


@query
def archives_to_tree(v):
    """Archives unpacked into a tree; what is there is read again."""
    files = _packed(v).select(F.concat("id", F.lit(".tar.gz")).alias("path"), "content")
    root, tree = _put(v, files, "archives"), v.path("unpacked")
    manifest = sinks.archives_to_tree(sources.scan_archives(v.spark, root), root, tree)
    placed = manifest.where("error is null").select("id", "kind", F.col("path").alias("key"), "size")
    whole = placed.withColumn("path", F.concat(F.lit(file_uri(tree) + "/"), "key"))
    found = sources.read_content(whole, tree).select(
        "id", "kind", F.col("key").alias("path"), "size", F.md5("content").alias("md5"), F.lit(None).cast("string").alias("error"))
    return found.unionByName(manifest.where("error is not null").withColumn("md5", F.lit(None).cast("string")))


@query
def place_files(v):
    """Copies of a tree's files in a second tree, and of files that are not there."""
    root, target = _put(v, _tree(v), "tree"), v.path("copied")
    found = sources.scan_artifacts(v.spark, root).select("id", "kind", F.col("path").alias("source"))
    gone = found.where("kind = 'pdf'").select("id", F.lit("nxml").alias("kind"), F.concat("source", F.lit(".gone")).alias("source"))
    manifest = sinks.place_files(found.unionByName(gone), target)
    there = sources.scan_artifacts(v.spark, target).select("id", "kind", F.col("size").alias("size_there"))
    return manifest.join(there, ["id", "kind"], "left").select("id", "kind", "path", "size", "size_there", "error")


@query
def decompress(v):
    def one(page: int, text: str) -> bytes:
        return gzip.compress(text.encode()) if page % 3 == 0 else b"\x1f\x8b broken" if page % 3 == 1 else text.encode()

    @F.arrow_udf("binary")
    def zipped(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        rows = ((one(p.as_py(), t.as_py()),) for pages, texts in batches for p, t in zip(pages, texts))
        for batch in archives.gathered(rows, pa.schema([("payload", pa.binary())])):
            yield batch.column(0)

    packed = v.table("pages").select(F.col("page_id").alias("id"), zipped("page_id", "html").alias("payload"))
    return archives.decompress(packed).select("id", F.md5("payload").alias("payload_md5"), "usable")


@query
def convert_files(v):
    def upper(file: str, content: bytes) -> bytes:
        if len(file) % 5 == 0:
            raise ValueError("no luck")
        return b"<tei>" + content + b"</tei>"

    pages = v.table("pages").select(
        F.concat(F.lit("d"), F.col("page_id").cast("string"), F.lit(".nxml")).alias("file"), F.col("html").cast("binary").alias("content")
    )
    placed = archives.place_converted(archives.convert(pages, upper))
    return placed.select("id", "target", F.md5("content").alias("content_md5"))


@query
def biblio_files(v):
    path = v.path("biblio")
    record = v.biblio.select(
        F.when(F.col("rec_id") % 4 == 0, F.col("doi")).alias("DOI"),
        F.when(F.col("rec_id") % 4 != 0, F.col("doi")).alias("doi2"), "pmid", "pmcid", "istexid", "pii", "title", "year",
        F.col("oa_link").alias("oaLink"), F.array(F.lit("r1"), F.col("title")).alias("reference"),
    )
    text = F.regexp_replace(F.to_json(F.struct("*")), '"doi2":', '"doi":')
    record.select(text).write.text(path)
    whole = sources.read_biblio(v.spark, path)
    pruned = sources.read_fallback(v.spark, path)
    kept = F.try_variant_get("raw", "$.reference[1]", "string")
    return whole.select("doi", "pmid", "pmcid", "istexid", "pii", "oa_link", "title", "year", kept.alias("reference")).unionByName(
        pruned.select("doi", "pmid", "pmcid", "istexid", "pii", "oa_link", "title", "year", kept.alias("reference")))


@query
def location_files(v):
    """Nested location records, one per page, through JSON."""
    place = lambda url, pdf: F.struct(url.alias("url"), pdf.alias("url_for_pdf"))
    page, url = F.col("page_id"), F.col("url")
    number = page.cast("string")
    pmc = F.concat(F.lit("https://www.ncbi.nlm.nih.gov/pmc/articles/PMC"), number)
    none = F.lit(None).cast("string")
    best = F.when(page % 7 == 0, F.lit(None)).when(page % 5 == 0, place(pmc, none)).when(
        page % 5 == 1, place(url, F.concat(url, F.lit(".pdf")))).otherwise(place(url, none))
    others = F.array(
        place(url, none),
        place(url, F.when(page % 3 == 0, F.concat(url, F.lit("?format=pdf")))),
        place(pmc, F.when(page % 4 == 0, F.concat(F.lit("https://europepmc.org/articles/pmc"), number))),
    )
    path = v.path("locations")
    v.table("pages").select(
        F.concat(F.lit("10.1/X"), number).alias("doi"), best.alias("best_oa_location"), others.alias("oa_locations")
    ).write.json(path)
    return lookup.choose_location(sources.read_locations(v.spark, path))


@query
def state_versions(v):
    """Two runs written as versions and read back: the update wins over the first state."""
    root = v.path("state")
    sinks.write_state(v.spark, root, v.entries, v.id_map)
    new = _updates(v)
    sinks.write_state(v.spark, root, new, upsert.latest_keys(new, "row_no"))
    entries, id_map = sources.read_state(v.spark, root)
    return entries.select(F.lit("entry").alias("kind"), F.col("doi").alias("key"), "id").unionByName(id_map)


@query
def state_reset(v):
    """A state that is reset and written anew holds the new rows alone; the ledger goes on."""
    root = v.path("state")
    sinks.write_state(v.spark, root, v.entries, v.id_map)
    sinks.reset_state(v.spark, root)
    new = _updates(v)
    sinks.write_state(v.spark, root, new, upsert.latest_keys(new, "row_no"))
    entries, id_map = sources.read_state(v.spark, root)
    return entries.select(F.lit("entry").alias("kind"), F.col("doi").alias("key"), "id").unionByName(id_map)


# Streams


def _releases(v, parts: int, turned: bool = False):
    """The release as several folders of files, one written per step, in row order.

    `turned`: every second folder has its columns in another order, and one more.
    """
    folder, rows = v.path("parts"), v.meta
    last = rows.agg(F.max("row_no")).first()[0]
    for at in range(parts):
        low, high = last * at // parts, last * (at + 1) // parts
        part = rows.where((F.col("row_no") > low - (at == 0)) & (F.col("row_no") <= high))
        ordered = part.repartitionByRange("row_no").sortWithinPartitions("row_no").drop("row_no")
        if turned and at % 2:
            ordered = ordered.select(*reversed(ordered.columns), F.lit("more").alias("note"))
        sinks.write_csv(ordered, f"{folder}/part{at}")
        yield folder


@query
def release_two_headers(v):
    for folder in _releases(v, 3, turned=True):
        pass
    paths = [f"{folder}/part{at}" for at in range(3)]
    return sources.read_release(v.spark, *paths).drop("row_no", "authors", "journal", "mag_id", "who_covidence_id", "arxiv_id")


def _streamed(v, turned: bool) -> DataFrame:
    """Each release is written and taken by a run of the stream that goes on from the last."""
    root, progress = v.path("state"), v.path("progress")
    sinks.write_state(v.spark, root, v.entries, v.id_map)
    snapshots = plans.keep_snapshots(v.snapshots)
    for folder in _releases(v, 2, turned):
        found = streaming.release_files(v.spark, folder)
        streaming.stream_releases(found, root, snapshots, progress).awaitTermination()
    return sources.read_state(v.spark, root)[0].select(*ENTRY_OUT)


@query
def stream_releases(v):
    return _streamed(v, turned=False)


@query
def stream_two_headers(v):
    return _streamed(v, turned=True)


@query
def stream_first_seen(v):
    out, progress = v.path("seen"), v.path("progress")
    for folder in _releases(v, 2, turned=True):
        rows = streaming.release_rows(streaming.release_files(v.spark, folder))
        (streaming.stream_first_seen(rows).select("cord_uid").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", progress)
         .trigger(availableNow=True).start().awaitTermination())
    return v.spark.read.parquet(out)


def _versions(v):
    """Entries arrive three times: without any flag, then as they are, then half of them once more, older."""
    folder = v.path("versions")
    blank = v.entries.withColumns({f: F.lit(False) for f in FLAGS}).withColumn("version", F.lit(0))
    older = v.entries.where("has_valid_pdf").withColumns({f: F.lit(True) for f in FLAGS}).withColumn("version", F.lit(0))
    for at, rows in enumerate((blank, v.entries.withColumn("version", F.lit(1)), older)):
        rows.write.parquet(f"{folder}/part{at}")
        yield v.spark.readStream.schema(blank.schema).option("recursiveFileLookup", "true").parquet(folder)


@query
def stream_waterfall(v):
    """The counts after each of the batches."""
    out, progress = v.path("counts"), v.path("progress")
    for updates in _versions(v):
        streaming.stream_waterfall(updates, out, progress).awaitTermination()
    return v.spark.read.parquet(f"{out}/counts")


@query
def stream_entries(v):
    root, progress = v.path("state"), v.path("progress")
    for at, updates in enumerate(_versions(v)):
        if at < 2:
            streaming.stream_entries(updates, root, progress).awaitTermination()
    return sources.read_state(v.spark, root)[0].select("id", "doi", "oa_link", *FLAGS)
