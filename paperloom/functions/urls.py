"""Column functions over addresses and storage keys."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.identifiers import present
from paperloom.values import FTP_TRANSPORTS, WEB_TRANSPORTS


def join_url(base: str, rest: Column) -> Column:
    """`base` and `rest` with exactly one separator between them."""
    return F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(rest, r"^/+", ""))


def target_key(prefix: Column, name: Column) -> Column:
    """Destination key: prefix, one slash, file name; a blank prefix adds nothing."""
    folder = F.when(present(prefix).isNull(), F.lit("")).otherwise(
        F.concat(F.regexp_replace(prefix, "/+$", ""), F.lit("/"))
    )
    return F.concat(folder, name)


def url_class(url: Column) -> Column:
    """`file`, `archive` or `direct`; null without an address."""
    return (
        F.when(present(url).isNull(), F.lit(None).cast("string"))
        .when(url.startswith("file://"), F.lit("file"))
        .when(url.endswith(".tar.gz"), F.lit("archive"))
        .otherwise(F.lit("direct"))
    )


def url_host(url: Column) -> Column:
    """Host of an address; null for local files."""
    return present(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]+)", 1)))


def fetch_target(article: Column, kind: Column) -> Column:
    """Name under which a fetched file is kept."""
    return F.concat(article, F.when(kind == "archive", F.lit(".tar.gz")).otherwise(F.lit(".pdf")))


def transport_order(url: Column) -> Column:
    """Transports to try, in order."""
    ftp = F.array(*[F.lit(t) for t in FTP_TRANSPORTS])
    web = F.array(*[F.lit(t) for t in WEB_TRANSPORTS])
    return F.when(url.startswith("ftp"), ftp).otherwise(web)


def contains_any(c: Column, marks: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(m) for m in marks])
