"""Jobs over file content: archives, gzip payloads, conversion of JATS files."""

import gzip
import io
import tarfile
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions import artifact_name, content_kind, storage_path
from paperloom.operators.dedup import first_by
from paperloom.values import CONVERTED_SUFFIXES

# Bytes of results, and rows, that a task gathers before it hands them on.
HELD, HELD_ROWS = 4 << 20, 5_000


def gathered(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """`rows` in batches of a little over HELD bytes, so that a task holds few whole files as objects at a time."""
    def as_batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes | str))
        if size >= HELD or len(held) >= HELD_ROWS:
            yield as_batch()
            held, size = [], 0
    if held:
        yield as_batch()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, ...]]:
    """The rows of `batches`; each value becomes an object of its own only when its turn comes."""
    for batch in batches:
        for row in zip(*batch.columns):
            yield tuple(v.as_py() for v in row)


def extract_archives(archives: DataFrame) -> DataFrame:
    """(id, pdf_name, pdf, nxml_name, nxml, no_pdf, error) of archives (id, content).

    The first PDF and the last NXML file of an archive are kept. Members are read from the
    bytes in memory. A broken archive gives a row with `error`, and the job goes on. A task holds the
    archives of one Arrow batch, as they are packed, and what is unpacked of a few.
    """
    schema = pa.schema([("id", pa.string()), ("pdf_name", pa.string()), ("pdf", pa.binary()),
                        ("nxml_name", pa.string()), ("nxml", pa.binary()), ("error", pa.string())])

    def wanted(content: bytes) -> tuple:
        pdf = nxml = None
        with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
            for member in tar:
                if not member.isfile():
                    continue
                if pdf is None and member.name.endswith((".pdf", ".PDF")):
                    pdf = (member.name, tar.extractfile(member).read())
                elif member.name.endswith(".nxml"):
                    nxml = (member.name, tar.extractfile(member).read())
        return (pdf or (None, None)) + (nxml or (None, None))

    def unpacked(article: str, content: bytes) -> tuple:
        try:
            return article, *wanted(content), None
        except (tarfile.TarError, EOFError, OSError, zlib.error) as broken:
            return article, None, None, None, None, type(broken).__name__

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from gathered((unpacked(*row) for row in rows_of(batches)), schema)

    out = archives.select("id", "content").mapInArrow(
        unpack, "id string, pdf_name string, pdf binary, nxml_name string, nxml binary, error string"
    )
    return out.select(
        "id", "pdf_name", "pdf", "nxml_name", "nxml",
        F.col("pdf_name").isNull().alias("no_pdf"), "error",
    )


def decompress(payloads: DataFrame) -> DataFrame:
    """`payloads` with gzip content replaced by what it holds, plus `usable`.

    Empty payloads and those that fail to unpack are not usable. Only gzip rows reach Python, where
    a task holds the payloads of one Arrow batch, as they are packed, and what is unpacked of a few.
    """
    def one(content: bytes | None) -> bytes | None:
        if content is None:
            return None
        try:
            return gzip.decompress(content)
        except (OSError, EOFError, zlib.error):
            return None

    @F.arrow_udf("binary")
    def unzip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows = ((one(content.as_py()),) for batch in batches for content in batch)
        for batch in gathered(rows, pa.schema([("payload", pa.binary())])):
            yield batch.column(0)

    body = F.col("payload")
    zipped = content_kind(body) == "gzip"
    plain = payloads.where(~F.coalesce(zipped, F.lit(False)))
    packed = payloads.where(zipped).withColumn("payload", unzip(body))
    return plain.unionByName(packed).withColumn(
        "usable", F.coalesce(F.octet_length("payload"), F.lit(0)) > 0
    )


def conversion_batch(artifacts: DataFrame) -> DataFrame:
    """(id, file, path, target) of the JATS files to convert, one per file name."""
    jats = artifacts.where(F.col("kind").isin("nxml", "nlm")).select("file", "path")
    return first_by(jats, ["file"], "path").select(
        F.substring_index("file", ".", 1).alias("id"), "file", "path",
    ).withColumn("target", _converted_target())


def _converted_target():
    article = F.col("id")
    return F.concat(storage_path(article), artifact_name(article, F.lit("jats_tei")))


def convert(sources: DataFrame, converter: Callable[[str, bytes], bytes], output_suffix: str = ".xml") -> DataFrame:
    """Run the caller's `converter(file, content)` over rows (file, content).

    Gives (file, content, error); a converter that raises yields an error row.
    """
    schema = pa.schema([("file", pa.string()), ("content", pa.binary()), ("error", pa.string())])

    def converted(file: str, content: bytes) -> tuple:
        try:
            return file + output_suffix, converter(file, content), None
        except Exception as failed:  # the converter is foreign code
            return file + output_suffix, None, f"{type(failed).__name__}: {failed}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from gathered((converted(*row) for row in rows_of(batches)), schema)

    return sources.select("file", "content").mapInArrow(
        run, "file string, content binary, error string"
    )


def place_converted(results: DataFrame) -> DataFrame:
    """(id, target, content) of converter outputs that count, at their place in the tree."""
    counts = F.lit(False)
    for suffix in CONVERTED_SUFFIXES:
        counts = counts | F.col("file").endswith(suffix)
    good = results.where(counts & F.col("content").isNotNull())
    return good.select(F.substring_index("file", ".", 1).alias("id"), "content").withColumn(
        "target", _converted_target()
    ).select("id", "target", "content")
