"""What a fetched payload is, judged by its bytes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.identifiers import present

# Leading bytes of each format (fixed values).
SIGNATURES = {
    "pdf": b"%PDF-",
    "png": b"\x89PNG\r\n\x1a\n",
    "gzip": b"\x1f\x8b",
}
# Content that a file of each artifact kind must have (fixed values).
CONTENT_KINDS = {
    "pdf": "pdf", "nxml": "xml", "nlm": "xml", "pdf_tei": "xml", "jats_tei": "xml", "json": "json",
    "ref_annotations": "json", "thumb_small": "png", "thumb_medium": "png", "thumb_large": "png",
}
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def content_kind(payload: Column) -> Column:
    """pdf, png, gzip, xml or json; null for anything else and for an empty payload.

    XML may open with a byte order mark and blanks. JSON must parse as a whole and be an
    object or an array.
    """
    text = payload.cast("string")
    kind = F.when(F.coalesce(F.octet_length(payload), F.lit(0)) == 0, F.lit(None).cast("string"))
    for name, head in SIGNATURES.items():
        kind = kind.when(F.substring(payload, 1, len(head)) == F.lit(bytearray(head)), F.lit(name))
    kind = kind.when(text.rlike(r"\A\x{feff}?\s*<\?xml"), F.lit("xml"))
    kind = kind.when(
        text.rlike(r"\A\s*[\[{]") & F.try_parse_json(text).isNotNull(), F.lit("json")
    )
    return kind.otherwise(F.lit(None).cast("string"))


def is_valid(payload: Column, kind: Column | str) -> Column:
    """True where the payload is of the wanted kind; empty or missing is false."""
    wanted = F.lit(kind) if isinstance(kind, str) else kind
    return F.coalesce(content_kind(payload) == wanted, F.lit(False))


def judge_artifacts(artifacts: DataFrame) -> DataFrame:
    """`artifacts` (kind, head, ...) plus `valid`: whether a file's content is what its name says.

    `head` is the start of the file, or all of a JSON file. Files of other kinds are not valid.
    """
    wanted = F.create_map(*[F.lit(x) for pair in CONTENT_KINDS.items() for x in pair])
    return artifacts.withColumn("valid", is_valid(F.col("head"), F.element_at(wanted, F.col("kind"))))


def _plain(token: Column) -> Column:
    """The character an entity stands for; any other token as it is."""
    digits = F.regexp_extract(token, "(?i)^&#(x?)([0-9a-f]+);$", 2)
    base = F.when(F.lower(token).startswith("&#x"), 16).otherwise(10)
    code = F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
    is_character = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    plain = F.when(is_character, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    for entity, character in ENTITIES.items():
        plain = plain.when(token == entity, F.lit(character))
    return plain.otherwise(token)


def unescaped(text: Column) -> Column:
    """`text` with named and numeric entities decoded, once."""
    tokens = F.regexp_extract_all(text, F.lit("(?s)&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[a-z]+;|[^&]+|&"), F.lit(0))
    return F.array_join(F.transform(tokens, _plain), "")


def redirect_link(payload: Column) -> Column:
    """Address behind the first `a` element with id `redirect` of a page that is not a PDF."""
    text = payload.cast("string")
    tags = F.regexp_extract_all(text, F.lit(r"(?is)<a\s[^>]*>"), F.lit(0))
    marked = r"""(?i:\sid)\s*=\s*(?:"redirect"|'redirect'|redirect(?=[\s>]))"""
    tag = F.get(F.filter(tags, lambda t: t.rlike(marked)), 0)
    href = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    link = F.coalesce(*[present(F.regexp_extract(tag, href, g)) for g in (1, 2, 3)])
    return F.when(~F.coalesce(text.startswith("%PDF-"), F.lit(False)), unescaped(link))
