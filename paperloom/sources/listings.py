"""File listings: harvested tree, official full texts, archives."""

from collections import deque
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from paperloom import files
from paperloom.files import file_uri
from paperloom.functions import CONTENT_KINDS, artifact_parts, judge_artifacts
from paperloom.operators.joins import shuffle_tasks
from paperloom.runtime import cut_lineage

# Folders that a task lists in one round, those it was given included, before it hands back the rest.
WALK = 1000
# Rows of a frame that a listing task gives at once, and bytes of content that a reading one holds.
PAGE, HELD = 10_000, 4 << 20
# Stands in the place of a size.
FOLDER = -1


def _walk(uri: str, walk: int) -> Callable:
    """Lists the folders of each batch, then folders below them; those left over come back as rows."""
    folder, rows_at_once = FOLDER, PAGE

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = files.store_of(uri)
        for batch in batches:
            waiting, page = deque(path or base for path in batch["path"]), []
            for _ in range(max(walk, len(waiting))):
                if not waiting:
                    break
                for path, size in files.list_folder(store, waiting.popleft()):
                    if size is None:
                        waiting.append(path)
                    else:
                        page.append((path, size))
                    if len(page) >= rows_at_once:
                        yield pd.DataFrame(page, columns=["path", "size"])
                        page = []
            page += [(path, folder) for path in waiting]
            yield pd.DataFrame(page, columns=["path", "size"])

    return run


def next_round(frontier: DataFrame, uri: str, walk: int) -> DataFrame:
    """(path, size) of what the folders of `frontier` hold, dealt out evenly over the tasks."""
    dealt = frontier.repartition(shuffle_tasks(frontier))
    return dealt.mapInPandas(_walk(uri, walk), "path string, size long")


def list_files(spark: SparkSession, root: str, walk: int = WALK) -> DataFrame:
    """(path, size) of every file under `root`, empty ones included.

    The tree is walked in rounds. A round's folders are dealt out over all tasks; each lists its
    own and goes on below them until it has listed `walk` folders, and what it did not come to is
    the next round's. So a small tree takes one round, and a large one spreads over all tasks as
    soon as it branches, wherever that is. Rounds are written in between; the driver learns whether
    folders are left, nothing else.
    """
    uri, rounds = file_uri(root), []
    frontier = spark.range(1).select(F.lit("").alias("path"), F.lit(FOLDER).cast("long").alias("size"))
    while True:
        seen = cut_lineage(next_round(frontier, uri, walk))
        rounds.append(seen.where(F.col("size") != FOLDER))
        frontier = seen.where(F.col("size") == FOLDER)
        if frontier.isEmpty():
            return reduce(DataFrame.unionByName, rounds)


def artifact_index(listed: DataFrame) -> DataFrame:
    """(path, id, kind, file, size) of the listed files (path, size); further columns stay."""
    rest = [c for c in listed.columns if c != "path"]
    return listed.select("path", F.inline(F.array(artifact_parts(F.col("path")))), *rest)


def scan_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Inventory of a harvested tree. Only names and lengths are read, never content."""
    return artifact_index(list_files(spark, root))


def scan_judged(spark: SparkSession, root: str) -> DataFrame:
    """Inventory of a tree whose files were looked into: `valid` says if the content is of the kind."""
    return judge_artifacts(read_heads(scan_artifacts(spark, root), root)).drop("head")


def index_official(listed: DataFrame) -> DataFrame:
    """(kind, key) of official full texts: PMC id or PDF digest out of the path."""
    path = F.col("path")
    pmc = F.regexp_extract(path, r"pmc_json/([^/]*)\.xml\.json$", 1)
    pdf = F.regexp_extract(path, r"pdf_json/([^/]*)\.json$", 1)
    kind = F.when(pmc != "", F.lit("pmc")).when(pdf != "", F.lit("pdf"))
    return (
        listed.select(kind.alias("kind"), F.when(pmc != "", pmc).otherwise(pdf).alias("key"))
        .where(F.col("kind").isNotNull()).distinct()
    )


def scan_official(spark: SparkSession, root: str) -> DataFrame:
    """The official full texts under `root`."""
    return index_official(list_files(spark, root))


def scan_archives(spark: SparkSession, root: str) -> DataFrame:
    """(id, path, size) of each `.tar.gz` file under `root`; content is read where it is used."""
    file = F.substring_index("path", "/", -1)
    return list_files(spark, root).where(F.col("path").endswith(".tar.gz")).select(
        F.regexp_replace(file, r"\.tar\.gz$", "").alias("id"), "path", "size"
    )


def _read(found: DataFrame, root: str, column: str, limit: Callable) -> DataFrame:
    """`found` plus the bytes of each file, or the first so many as `limit(row)` says."""
    uri, names, most = file_uri(root), found.columns, HELD

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = files.store_of(uri)
        for batch in batches:
            held, size, first = [], 0, 0
            for at, row in enumerate(batch.itertuples(index=False)):
                held.append(files.read_bytes(store, row.path, limit(row)))
                size += len(held[-1] or b"")
                if size > most or at + 1 == len(batch):
                    part = batch.iloc[first:at + 1].copy()
                    part[column] = held
                    yield part[[*names, column]]
                    held, size, first = [], 0, at + 1

    schema = StructType([*found.schema.fields, StructField(column, BinaryType())])
    return found.mapInPandas(read, schema)


def read_content(found: DataFrame, root: str) -> DataFrame:
    """`found` plus `content`, read by the tasks; joins belong before this. A file that is gone has none."""
    return _read(found, root, "content", lambda row: None)


def read_heads(found: DataFrame, root: str, size: int = 512) -> DataFrame:
    """`found` (path, kind, ...) plus `head`: what tells the kind of content.

    That is the first `size` bytes, and the whole of a file that should be JSON. The reading is
    dealt out over all tasks, as a listing may lie in a few.
    """
    whole = [kind for kind, content in CONTENT_KINDS.items() if content == "json"]
    dealt = found.repartition(shuffle_tasks(found))
    return _read(dealt, root, "head", lambda row: None if row.kind in whole else size)
