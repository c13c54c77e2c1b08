"""Where the full text of an article is to be had."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import doi_key, init_flags, join_url, present, storage_path
from paperloom.operators.joins import spread_join
from paperloom.values import PMC_ARCHIVE_BASE

# What the rungs behind the publisher's are called.
SOURCES = ("legacy", "pmc", "location")


def link_index(
    pub_map: DataFrame,
    pub_files: DataFrame,
    legacy: DataFrame,
    pmc_oa: DataFrame,
    locations: DataFrame,
    pub_base: str,
    legacy_root: str,
    pmc_base: str = PMC_ARCHIVE_BASE,
) -> DataFrame:
    """What the four sources of links offer, as narrow rows (kind, key, at, there, url), unique by (kind, key).

    `at` is the rung of the ladder; `there` is false where the publisher's file is missing.
    """
    def offers(rows: DataFrame, kind, key: str, at, url, there=F.lit(True)) -> DataFrame:
        kind, at = (F.lit(x) if not isinstance(x, Column) else x for x in (kind, at))
        return rows.select(kind.alias("kind"), F.col(key).alias("key"), at.cast("int").alias("at"), there.alias("there"), url.alias("url"))

    local = F.lit("file://")
    files = pub_files.select("pdf").distinct().withColumn("there", F.lit(True))
    mapped = spread_join(pub_map.withColumn("_k", F.concat_ws(":", "kind", "key")), files, ["pdf"], "left", "_k")
    held = legacy.where((F.col("kind") == "pdf") & F.col("valid")).select("id").distinct()
    stem = F.concat(local, F.lit(legacy_root.rstrip("/") + "/"), storage_path(F.col("id")), F.col("id"), F.lit(".pdf"))
    return reduce(DataFrame.unionByName, [
        offers(mapped, F.concat(F.lit("pub-"), "kind"), "key", F.when(F.col("kind") == "doi", 0).otherwise(1),
               F.concat(local, join_url(pub_base, F.col("pdf"))), F.coalesce("there", F.lit(False))),
        offers(held, "id", "id", 2, stem),
        offers(pmc_oa, "pmcid", "pmcid", 3, join_url(pmc_base, F.col("subpath"))),
        offers(locations.where("url is not null"), "place", "doi", 4, F.col("url")),
    ]).where("key is not null")


def resolve_oa_link(
    entries: DataFrame,
    pub_map: DataFrame,
    pub_files: DataFrame,
    legacy: DataFrame,
    pmc_oa: DataFrame,
    locations: DataFrame,
    pub_base: str,
    legacy_root: str,
    pmc_base: str = PMC_ARCHIVE_BASE,
) -> DataFrame:
    """`links_from_index` over sources that have no kept index."""
    return links_from_index(
        entries, link_index(pub_map, pub_files, legacy, pmc_oa, locations, pub_base, legacy_root, pmc_base))


def links_from_index(entries: DataFrame, index: DataFrame) -> DataFrame:
    """Entries with `oa_link`, `oa_source` and `has_valid_oa_url` settled.

    Ladder: publisher file, file of an older tree, PMC archive, chosen location (doi, url),
    the link the entry already has. Only entries without a valid address or PDF are looked at.
    A DOI that the publisher map leads to a missing file ends the publisher's rung, so its PII
    is not asked.

    The entries make one list of probes (id, kind, key). One inner join brings them to the index, the best
    per entry is a combinable minimum, and entries are joined to it once. Entries that need nothing are
    not shuffled.
    """
    flagged = init_flags(entries)
    settled = F.col("has_valid_oa_url") & F.col("has_valid_pdf")
    todo = flagged.where(~settled)

    doi = doi_key(F.col("doi"))
    keys = {"pub-doi": doi, "pub-pii": present(F.col("pii")), "id": F.col("id"), "pmcid": present(F.col("pmcid")), "place": doi}
    probes = todo.select("id", F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in keys.items()]))).where("key is not null")
    hits = spread_join(probes, index, ["kind", "key"], "inner", "id").groupBy("id").agg(
        F.min(F.when(F.col("at") < 2, F.struct("at", "there", "url"))).alias("published"),
        F.min(F.when(F.col("at") >= 2, F.struct("at", "url"))).alias("other"))
    sources = F.array(*map(F.lit, SOURCES))
    is_published = F.coalesce(F.col("published.there"), F.lit(False))
    best = hits.select(
        "id", F.when(is_published, F.col("published.url")).otherwise(F.col("other.url")).alias("_url"),
        F.when(is_published, F.lit("publisher")).otherwise(F.get(sources, F.col("other.at") - 2)).alias("_source"))

    old = present(F.col("oa_link"))
    resolved = todo.join(best, "id", "left").withColumns({
        "oa_link": F.coalesce("_url", old),
        "oa_source": F.coalesce("_source", F.when(old.isNotNull(), F.lit("existing"))),
        "has_valid_oa_url": F.col("has_valid_oa_url") | F.coalesce("_url", old).isNotNull(),
    }).drop("_url", "_source")
    return flagged.where(settled).unionByName(resolved, allowMissingColumns=True)
