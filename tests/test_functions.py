import pytest
from pyspark.sql import functions as F

from paperloom import functions as fn


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{k} {'binary' if isinstance(v, (bytes, bytearray)) else 'string'}" for k, v in values.items()))
    return rows.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, cleaned", [
    ("https://doi.org/10.1/AbC", "10.1/abc"),
    ("http://dx.doi.org/10.1/x", "10.1/x"),
    ("http://doi.org/10.1/x", "http://doi.org/10.1/x"),
    (" https://doi.org/10.1/x", "https://doi.org/10.1/x"),
    ("https://doi.org/11.1/X", "https://doi.org/11.1/x"),
    ("\t10.1/X  \x1f\n", "10.1/x"),
    ("https://doi.org/10.1/https://doi.org/2", "10.1/2"),
    ("", ""), (None, None),
])
def test_clean_doi(spark, raw, cleaned):
    assert one(spark, fn.clean_doi(F.col("a")), a=raw) == cleaned


@pytest.mark.parametrize("article, path", [
    ("123456789", "12/34/56/78/123456789/"), ("98da17ff-bf7e", "98/da/17/ff/98da17ff-bf7e/"),
    ("1234", "12/34/1234/"), ("abc", "ab/c/abc/"), ("", ""), (None, None),
])
def test_storage_path(spark, article, path):
    assert one(spark, fn.storage_path(F.col("a")), a=article) == path


@pytest.mark.parametrize("path, article, kind", [
    ("a/b/x1.pdf", "x1", "pdf"), ("x1.grobid.tei.xml", "x1", "pdf_tei"), ("q/x1.pub2tei.tei.xml", "x1", "jats_tei"),
    ("q/98da-17-ff-ref-annotations.json", "98da-17-ff", "ref_annotations"), ("q/98da-17.json", "98da-17", "json"),
    ("q/98da-17-thumb-small.png", "98da-17", "thumb_small"), ("q/x1.nxml", "x1", "nxml"), ("q/x1.nlm", "x1", "nlm"),
    ("q/x1.tar.gz", "x1", None), ("q/plain", "plain", None),
])
def test_artifact_parts(spark, path, article, kind):
    got = one(spark, fn.artifact_parts(F.col("a")), a=path)
    assert (got["id"], got["kind"], got["file"]) == (article, kind, path.rsplit("/", 1)[-1])


@pytest.mark.parametrize("date, year", [("2020-03-01", "2020"), ("2020", "2020"), ("", None), (None, None)])
def test_publish_year(spark, date, year):
    assert one(spark, fn.publish_year(F.col("a")), a=date) == year


def test_stable_id_has_uuid_layout_and_follows_from_the_key(spark):
    a, b = (one(spark, fn.stable_id(F.lit("doi"), F.col("a")), a="10.1/x") for _ in range(2))
    assert a == b and [len(p) for p in a.split("-")] == [8, 4, 4, 4, 12]
    assert a != one(spark, fn.stable_id(F.lit("pmid"), F.col("a")), a="10.1/x")


@pytest.mark.parametrize("payload, kind", [
    (b"%PDF-1.4 x", "pdf"), (b"\x89PNG\r\n\x1a\nx", "png"), (b"\x1f\x8b\x08", "gzip"), (b"<?xml version='1.0'?>", "xml"),
    (b"\xef\xbb\xbf \n<?xml ?>", "xml"), (b'{"a": 1}', "json"), (b" [1, 2]", "json"), (b'{"a": ', None), (b"12", None),
    (b"", None), (b"<html>", None), (b" %PDF-1", None),
])
def test_content_kind(spark, payload, kind):
    assert one(spark, fn.content_kind(F.col("a")), a=payload) == kind
    assert one(spark, fn.is_valid(F.col("a"), "pdf"), a=payload) is (kind == "pdf")


def test_missing_payload_is_not_valid(spark):
    row = spark.sql("select cast(null as binary) as a").select(fn.is_valid(F.col("a"), "pdf").alias("x")).first()
    assert row["x"] is False


@pytest.mark.parametrize("page, link", [
    (b'<a id="redirect" href="http://h/x?a=1&amp;b=2">', "http://h/x?a=1&b=2"),
    (b"<A class=q HREF='/y' ID='redirect'>", "/y"),
    (b'<a id="redirect" href="/x?a&#38;b&#x26;c&#X2f;d&#233;&#x1F600;">', "/x?a&b&c/d\u00e9\U0001F600"),
    (b'<a id="redirect" href="/x?a&amp;#38;b&c&unknown;&#55296;&#0;&">', "/x?a&#38;b&c&unknown;&#55296;&#0;&"),
    (b'<a href="/no">1</a><a href="/first" id=redirect>2</a><a id="redirect" href="/second">', "/first"),
    (b'<a data-id="redirect" href="/no">', None), (b'<a id="redirected" href="/no">', None),
    (b'<abbr id="redirect" href="/no">', None), (b'<a id="redirect">', None),
    (b'%PDF-1 <a id="redirect" href="/no">', None),
])
def test_redirect_link(spark, page, link):
    assert one(spark, fn.redirect_link(F.col("a")), a=page) == link


@pytest.mark.parametrize("url, cls, order, host", [
    ("ftp://F.org/a.tar.gz", "archive", "wget,ftp,session,plain", "f.org"),
    ("https://h/a.pdf", "direct", "session,plain,wget", "h"), ("file:///a.pdf", "file", "session,plain,wget", None),
])
def test_addresses(spark, url, cls, order, host):
    assert one(spark, fn.url_class(F.col("a")), a=url) == cls
    assert one(spark, F.concat_ws(",", fn.transport_order(F.col("a"))), a=url) == order
    assert one(spark, fn.url_host(F.col("a")), a=url) == host


@pytest.mark.parametrize("prefix, key", [("a/b", "a/b/f"), ("a/b/", "a/b/f"), ("a//", "a/f"), ("", "f"), (None, "f")])
def test_target_key(spark, prefix, key):
    assert one(spark, fn.target_key(F.col("a"), F.lit("f")), a=prefix) == key


def test_join_url_puts_one_separator(spark):
    for base in ("ftp://x/pub", "ftp://x/pub/"):
        for rest in ("a/b", "/a/b"):
            assert one(spark, fn.join_url(base, F.col("a")), a=rest) == "ftp://x/pub/a/b"


def test_canonical_json_sorts_and_merges(spark):
    rows = spark.sql("""select parse_json('{"z": {"k": [1, null]}, "DOI": "old", "b": null, "é": "ü\\\\"q"}') as raw, 'x' as id, cast(null as string) as doi""")
    both = fn.canonical_json({"id": F.col("id"), "DOI": F.col("doi")}, F.col("raw"))
    assert rows.select(both.alias("x")).first()["x"] == '{"DOI":"old","b":null,"id":"x","z":{"k":[1,null]},"é":"ü\\"q"}'
    assert rows.select(fn.canonical_json({"id": F.col("id"), "DOI": F.col("doi")}).alias("x")).first()["x"] == '{"id":"x"}'


def test_prune_record(spark):
    raw = spark.sql("""select parse_json('{"reference": [1], "a": 2}') as raw""")
    assert raw.select(F.to_json(fn.prune_record(F.col("raw"), "reference")).alias("x")).first()["x"] == '{"a":2}'
