"""Incremental runs as streams of release files and of entry versions."""

import csv
import io
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from paperloom import files
from paperloom.functions import present
from paperloom.operators.dedup import last_wins
from paperloom.operators.reports import flag_classes, waterfall_of
from paperloom.plans.ingest import Snapshots, ingest_release
from paperloom.schemas import ID_MAP
from paperloom.sinks.state import write_state
from paperloom.sources.releases import as_pattern, read_release, shape_release
from paperloom.sources.state import is_taken, read_all_commits, read_errors, read_state
from paperloom.values import RELEASE_COLUMNS


# Rows of a frame that a task gives at once.
PAGE = 5_000
# States that the entries of the running waterfall are dealt over; a checkpoint holds for one number of them.
STATE_BUCKETS = 1 << 14
# Columns of the stream of files.
FILE = "path string, modificationTime timestamp, length long, content binary"


def release_files(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of (path, length) of the CSV files that come to rest in `folder`; no content is read.

    `files_per_batch=1` makes a batch of each file, for folders where several releases wait.
    """
    reader = (
        spark.readStream.format("binaryFile").schema(FILE)
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path", "length")


def release_rows(found: DataFrame) -> DataFrame:
    """Release rows, with their `path`, of the files (path, ...): each is read once, by its own header.

    The task that gets a file goes through it row by row and takes columns by name, so files of both
    generations of headers, or with their columns in another order, may come in one batch.
    """
    names = RELEASE_COLUMNS

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(1 << 31)
        for batch in batches:
            for path in batch["path"]:
                store, name = files.store_of(files.file_uri(path))
                with store.open_input_stream(name) as stream:
                    rows = csv.DictReader(io.TextIOWrapper(stream, encoding="utf-8-sig", newline=""))
                    while page := list(islice(rows, PAGE)):
                        yield pd.DataFrame([[path, *map(row.get, names)] for row in page], columns=["path", *names])

    schema = ", ".join(f"`{c}` string" for c in ("path", *names))
    return shape_release(found.select("path").mapInPandas(read, schema), "path")


def stream_releases(
    found: DataFrame, root: str, snapshots: Snapshots, checkpoint: str, multi_line: bool = True
) -> StreamingQuery:
    """Ingest every batch of the stream `release_files` into the state under `root`.

    Rows of one batch are ordered by file path, and each file is read by its own header. The number of
    the batch is committed with the state version it made, so a batch that is replayed after a
    failure is not taken twice, even if the state was compacted since. Rows that cannot be taken
    go into the ledger and are tried again with the next batch.
    """
    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark, seen = f"{checkpoint}#{number}", len(read_all_commits(spark, root))
        if is_taken(spark, root, mark):
            return
        paths = sorted(as_pattern(r["path"]) for r in batch.select("path").collect())
        if not paths:
            return
        entries, id_map = read_state(spark, root)
        rows = read_release(spark, *paths, multi_line=multi_line)
        done = ingest_release(entries, id_map, rows, snapshots, errors=read_errors(spark, root, last=True))
        write_state(spark, root, done.changed, done.keys, mark, errors=done.errors, read_at=seen)

    return (
        found.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_first_seen(stream: DataFrame, event_time: str | None = None, lateness: str = "1 day") -> DataFrame:
    """One row per uid over the whole stream; the state is kept for ever.

    With an event time the state is bounded to `lateness`, and only repeats within it go.
    """
    keyed = stream.withColumn("cord_uid", F.coalesce(present(F.col("cord_uid")), F.lit("")))
    if event_time is None:
        return keyed.dropDuplicates(["cord_uid"])
    return keyed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(["cord_uid"])


def stream_entries(updates: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Put every batch of entry versions (..., version) into the state under `root`, the last of each id."""
    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark = f"{checkpoint}#{number}"
        if not is_taken(spark, root, mark):
            latest = last_wins(batch, ["id"], "version").drop("version")
            write_state(spark, root, latest, spark.createDataFrame([], ID_MAP), mark)

    return (
        updates.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def flag_changes(updates: DataFrame) -> DataFrame:
    """Stream of signed differences (oa_url, pdf, tei, n) of the counts per combination of flags.

    The state store keeps the flags and the version of each entry, the entries of a bucket in one state,
    as a call for every single entry costs far more than the entry. An entry that a batch changes is
    looked up in its bucket: it leaves its old combination and joins its new one. A version that is
    not newer than the one kept changes nothing; null is older than any.
    """
    names = ["oa_url", "pdf", "tei"]

    def change(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = dict(zip(state.get[0], zip(*state.get[1:]))) if state.exists else {}
        before, counts = {}, Counter()
        for frame in frames:
            columns = (frame[c].tolist() for c in ("id", *names, "version"))
            for entry, *flags, version in zip(*columns):
                old = kept.get(entry)
                if old is None or version > old[3]:
                    before.setdefault(entry, old)
                    kept[entry] = (*flags, version)
        for entry, old in before.items():
            counts[kept[entry][:3]] += 1
            if old is not None:
                counts[old[:3]] -= 1
        if before:
            state.update((list(kept), *map(list, zip(*kept.values()))))
        rows = [(*flags, n) for flags, n in counts.items() if n]
        if rows:
            yield pd.DataFrame(rows, columns=[*names, "n"])

    kind = updates.schema["id"].dataType.simpleString()
    bucket = F.pmod(F.xxhash64("id"), F.lit(STATE_BUCKETS)).alias("bucket")
    version = F.coalesce(F.col("version").cast("long"), F.lit(-1 << 63))
    return flag_classes(updates, "version").select(bucket, "id", *names, version.alias("version")).groupBy("bucket").applyInPandasWithState(
        change, "oa_url boolean, pdf boolean, tei boolean, n long",
        f"id array<{kind}>, oa_url array<boolean>, pdf array<boolean>, tei array<boolean>, version array<long>",
        "update", GroupStateTimeout.NoTimeout)


def stream_waterfall(updates: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Waterfall counts after each batch of entry versions (..., version), written to `out/counts/batch=N`.

    A batch costs what it changes: its signed differences are summed up, a row per combination of
    flags, and added to the counts that the batch before left under `out/classes`. Entries are
    never counted again. A batch that is replayed writes the same counts again. For a state that
    exists already, let its entries be the first batch.
    """
    def take(batch: DataFrame, number: int) -> None:
        spark, names = batch.sparkSession, ["oa_url", "pdf", "tei"]
        counts = batch.groupBy(*names).agg(F.sum("n").alias("n"))
        if number:
            counts = counts.unionByName(spark.read.parquet(f"{out}/classes/at={number - 1}"))
        written = f"{out}/classes/at={number}"
        counts.groupBy(*names).agg(F.sum("n").alias("n")).coalesce(1).write.mode("overwrite").parquet(written)
        waterfall_of(spark.read.parquet(written)).write.mode("overwrite").parquet(f"{out}/counts/batch={number}")

    return (
        flag_changes(updates).writeStream.outputMode("update").foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
