"""Planning of fetches and judging of their results."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions import (
    content_kind, fetch_target, init_flags, is_valid, present, redirect_link, transport_order, url_class, url_host,
)
from paperloom.operators.dedup import first_success
from paperloom.operators.joins import shuffle_tasks, spread_join
from paperloom.runtime import cut_lineage

# Redirects that are followed from one address (fixed value).
REDIRECTS = 5


def fetch_plan(entries: DataFrame, lanes: int | None = None) -> DataFrame:
    """(id, url, class, target, transports, host, lane) of entries that lack a valid PDF.

    A fetcher that must be polite to hosts works on one (host, lane) at a time; the lanes keep
    a host with a large share of the addresses from ending in one task. There are as many
    lanes as shuffle tasks unless `lanes` says otherwise.
    """
    lanes = lanes or shuffle_tasks(entries)
    url = present(F.col("oa_link"))
    todo = entries.where(~F.coalesce(F.col("has_valid_pdf"), F.lit(False))).where(url.isNotNull())
    kind = url_class(url)
    return todo.select(
        "id", url.alias("url"), kind.alias("class"),
        fetch_target(F.col("id"), kind).alias("target"),
        transport_order(url).alias("transports"),
        url_host(url).alias("host"),
        F.pmod(F.xxhash64("id"), F.lit(lanes)).cast("int").alias("lane"),
    )


def by_lane(plan: DataFrame) -> DataFrame:
    """The plan laid out so that one (host, lane) stays in one task."""
    return plan.repartition("host", "lane")


def content_validity(payloads: DataFrame, kind: str = "pdf") -> DataFrame:
    """(id, kind, valid) of fetched payloads against the wanted kind."""
    return payloads.select(
        "id", content_kind(F.col("payload")).alias("kind"),
        is_valid(F.col("payload"), kind).alias("valid"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(url, is_pdf, link) of fetched pages (url, payload), one per address; payloads stay behind."""
    body = F.col("payload")
    return pages.select(
        F.col("url"), F.coalesce(content_kind(body) == "pdf", F.lit(False)).alias("is_pdf"),
        present(redirect_link(body)).alias("link"))


def redirect_plan(plan: DataFrame, pages: DataFrame, rounds: int = REDIRECTS) -> DataFrame:
    """(id, url, last_url, round, outcome): where the addresses of a plan (id, url) lead to.

    `pages` (url, payload) holds what was fetched so far, one row per address. A page that is no PDF but
    names another address is followed, `rounds` times at most and never to an address seen before on
    the way. Outcomes: `pdf`, `fetch` (the last address has not been fetched yet, so it is to be
    planned next), `end` (neither PDF nor link), `loop`, `too_many`.

    Only addresses travel: pages are reduced to their links once, and every round is one join of the
    rows still under way. An address that many articles share is spread like any frequent key.
    """
    links = cut_lineage(page_links(pages).withColumnRenamed("url", "at"))
    under_way = plan.select(
        "id", "url", F.col("url").alias("at"), F.array("url").alias("seen"), F.lit(0).alias("round"))
    settled = []
    for turn in range(rounds + 1):
        looked = spread_join(under_way, links, ["at"], "left", "id")
        outcome = (
            F.when(F.col("is_pdf").isNull(), F.lit("fetch")).when(F.col("is_pdf"), F.lit("pdf"))
            .when(F.col("link").isNull(), F.lit("end"))
            .when(F.array_contains("seen", F.col("link")), F.lit("loop"))
            .when(F.lit(turn == rounds), F.lit("too_many")))
        judged = cut_lineage(looked.select("id", "url", "at", "seen", "round", "link", outcome.alias("outcome")))
        settled.append(judged.where("outcome is not null"))
        under_way = judged.where("outcome is null").select(
            "id", "url", F.col("link").alias("at"), F.array_append("seen", F.col("link")).alias("seen"),
            (F.col("round") + 1).alias("round"))
        if under_way.isEmpty():
            break
    return reduce(DataFrame.unionByName, settled).select(
        "id", "url", F.col("at").alias("last_url"), "round", "outcome")


def apply_fetch_results(entries: DataFrame, attempts: DataFrame, payloads: DataFrame) -> DataFrame:
    """`apply_verdicts` for payloads (id, payload) at hand. They are judged where they lie."""
    return apply_verdicts(entries, attempts, content_validity(payloads, "pdf"))


def apply_verdicts(entries: DataFrame, attempts: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Entries after a fetch: the PDF flag is set where an attempt worked and gave a PDF.

    `verdicts` has id and `valid` of each fetched file, be it a payload or the head of a file that
    was put into a folder. Adds `fetch_status`: success, invalid (fetched, but no PDF), failed or none.
    """
    tried = first_success(attempts).select("id", "status")
    valid = verdicts.groupBy("id").agg(F.bool_or("valid").alias("good"))
    joined = init_flags(entries).join(tried, "id", "left").join(valid, "id", "left")
    fetched = F.coalesce(F.col("status") == "success", F.lit(False))
    good = fetched & F.coalesce(F.col("good"), F.lit(False))
    return joined.withColumns({
        "has_valid_pdf": F.col("has_valid_pdf") | good,
        "fetch_status": F.when(F.col("status").isNull(), F.lit("none"))
        .when(good, F.lit("success")).when(fetched, F.lit("invalid")).otherwise(F.lit("failed")),
    }).drop("status", "good")
