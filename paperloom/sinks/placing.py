"""Putting files into the sharded tree: found artifacts, copies, members of archives.

Tasks stream from source to target and hold a chunk at a time. A file is written under a name of the
attempt's own and takes its place when it is whole, so a retry or a lost executor leaves nothing
half done under a name that counts. The manifest, a table that Spark commits, says what was placed.
"""

import tarfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom import files
from paperloom.functions import artifact_name, storage_path, target_key
from paperloom.functions.content import SIGNATURES
from paperloom.operators.joins import shuffle_tasks
from paperloom.runtime import cut_lineage

# Kinds that move from the working folder into the tree.
PLACED = ("pdf", "nxml", "pdf_tei", "json", "ref_annotations", "thumb_small", "thumb_medium", "thumb_large")
MANIFEST = "id string, kind string, path string, size long, error string"


def place_found(entries: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(id, kind, source, path): the files of entries to place, and their keys in the tree.

    `artifacts` has id, kind, path and `valid`. A PDF moves only if its content is one; all else if it is
    there, NXML included. Of several files of a kind the first by path counts.
    """
    kept = artifacts.where(F.col("kind").isin(*PLACED) & ((F.col("kind") != "pdf") | F.col("valid")))
    firsts = kept.groupBy("id", "kind").agg(F.min("path").alias("source"))
    owned = firsts.join(entries.select("id"), "id", "left_semi")
    name = artifact_name(F.col("id"), F.col("kind"))
    return owned.withColumn("path", target_key(storage_path(F.col("id")), name))


def _in_tasks(rows: DataFrame, columns: list[str], work: Callable) -> DataFrame:
    """The manifest of `work(row)`, which yields manifest rows; it runs once and is written."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [line for row in batch.itertuples(index=False) for line in work(row)]
            yield pd.DataFrame(out, columns=["id", "kind", "path", "size", "error"]).astype({"size": "Int64"})

    dealt = rows.select(*columns).repartition(shuffle_tasks(rows))
    return cut_lineage(dealt.mapInPandas(run, MANIFEST))


def place_files(copies: DataFrame, root: str) -> DataFrame:
    """Copy files (id, kind, source) to their place under `root`; gives the manifest.

    The manifest has id, kind, path below the root, size and error. A source that is gone is a row with an error.
    """
    uri = files.file_uri(root)
    named = copies.withColumn("path", target_key(storage_path(F.col("id")), artifact_name(F.col("id"), F.col("kind"))))

    def copy(row) -> Iterator[tuple]:
        target, base = files.store_of(uri)
        store, source = files.store_of(files.file_uri(row.source))
        try:
            with store.open_input_stream(source, compression=None) as stream:
                size = files.write_file(target, f"{base}/{row.path}", files.chunks_of(stream))
            yield row.id, row.kind, row.path, size, None
        except FileNotFoundError:
            yield row.id, row.kind, None, None, "gone"

    return _in_tasks(named, ["id", "kind", "source", "path"], copy)


def archives_to_tree(archives: DataFrame, source: str, root: str) -> DataFrame:
    """Unpack archives (id, path) under `source` into the tree under `root`; gives the manifest.

    The first PDF and the last NXML file of each archive are placed, one member at a time. A broken
    archive places nothing; it, an archive without PDF and a PDF that is none are rows with an error.
    """
    from_uri, to_uri, signature = files.file_uri(source), files.file_uri(root), SIGNATURES["pdf"]
    named = archives.withColumn("stem", F.concat(storage_path(F.col("id")), F.col("id")))

    def unpack(row) -> Iterator[tuple]:
        store, _ = files.store_of(from_uri)
        target, base = files.store_of(to_uri)
        held: dict[str, tuple[str, int, bytes]] = {}
        error = None

        def put(kind: str, member) -> None:
            head = []

            def chunks() -> Iterator[bytes]:
                for chunk in files.chunks_of(tar.extractfile(member)):
                    head[:] = head or [chunk[:16]]
                    yield chunk

            before = held.pop(kind, None)
            held[kind] = (*files.write_aside(target, f"{base}/{row.stem}.{kind}", chunks()), b"".join(head))
            if before:
                target.delete_file(before[0])

        try:
            with store.open_input_stream(row.path, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|gz") as tar:
                for member in tar:
                    if member.isfile() and member.name.endswith((".pdf", ".PDF")) and "pdf" not in held:
                        put("pdf", member)
                    elif member.isfile() and member.name.endswith(".nxml"):
                        put("nxml", member)
        except (tarfile.TarError, EOFError, OSError, zlib.error) as broken:
            error = type(broken).__name__
        if error is None and not held.get("pdf", (None, 0, b""))[2].startswith(signature):
            yield row.id, "pdf", None, None, "not a pdf" if "pdf" in held else "no pdf"
        for kind, (aside, size, head) in held.items():
            if error is None and (kind != "pdf" or head.startswith(signature)):
                target.move(aside, f"{base}/{row.stem}.{kind}")
                yield row.id, kind, f"{row.stem}.{kind}", size, None
            else:
                target.delete_file(aside)
        if error is not None:
            yield row.id, None, None, None, error

    return _in_tasks(named, ["id", "path", "stem"], unpack)
