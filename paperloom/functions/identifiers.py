"""Column functions over identifiers, paths and dates."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.values import ARTIFACT_SUFFIXES, DOI_PREFIXES

# Every kind of white space, the four ASCII separators included.
_BLANKS = r"[\s\x{1c}-\x{1f}]+"


def present(c: Column) -> Column:
    """Null for an empty string. A value of blanks only counts as present."""
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.regexp_replace(c, rf"(?U)\A{_BLANKS}|{_BLANKS}\z", "")


def clean_doi(c: Column) -> Column:
    """Bare lower-case DOI. A prefix counts only at the very start of the value."""
    bare = reduce(
        lambda rest, prefix: F.when(
            c.startswith(prefix + "10."), F.replace(c, F.lit(prefix), F.lit(""))
        ).otherwise(rest),
        DOI_PREFIXES,
        c,
    )
    return F.lower(strip(bare))


def doi_key(c: Column) -> Column:
    """Cleaned DOI for joins, null where there is none."""
    return present(clean_doi(c))


def publish_year(c: Column) -> Column:
    """Text before the first dash of a date; absent stays absent."""
    return F.substring_index(present(c), "-", 1)


def storage_path(article: Column) -> Column:
    """`aa/bb/cc/dd/<id>/`, with the segments that a short id lacks left out."""
    steps = [F.substring(article, at, 2) for at in (1, 3, 5, 7)]
    kept = F.filter(F.array(*steps, article), lambda s: s != "")
    return F.when(article == "", F.lit("")).when(
        article.isNotNull(), F.concat(F.concat_ws("/", kept), F.lit("/"))
    )


def artifact_name(article: Column, kind: Column) -> Column:
    """File name of one artifact of an article."""
    suffixes = F.create_map(*[F.lit(x) for pair in ARTIFACT_SUFFIXES.items() for x in pair])
    return F.concat(article, F.element_at(suffixes, kind))


def artifact_parts(path: Column) -> Column:
    """Struct (id, kind, file) of an artifact path; kind is null for other files.

    The id runs to the first dot, or to the dash of a dashed suffix.
    """
    file = F.substring_index(path, "/", -1)
    dotted = F.substring_index(file, ".", 1)
    kind, article = F.lit(None).cast("string"), dotted
    # The longest suffix is tested first, so it is the outermost branch.
    for name, suffix in sorted(ARTIFACT_SUFFIXES.items(), key=lambda kv: len(kv[1])):
        hit = file.endswith(suffix)
        kind = F.when(hit, F.lit(name)).otherwise(kind)
        if suffix.startswith("-"):
            stem = F.left(file, F.length(file) - F.lit(len(suffix)))
            article = F.when(hit, stem).otherwise(article)
    return F.struct(article.alias("id"), kind.alias("kind"), file.alias("file"))


def stable_id(kind: Column, key: Column) -> Column:
    """Id in UUID layout that follows from the key alone, so a retry gives it again."""
    digest = F.md5(F.concat(kind, F.lit(":"), key))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
