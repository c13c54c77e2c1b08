"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A data file is a run of records: length of the payload (8 bytes), masked checksum of these
8 bytes (4 bytes), payload, masked checksum of the payload (4 bytes). All numbers are little
endian. A payload is one byte that says whether there is a document id, one with the width of a token
id (2 bytes where the whole vocabulary fits, else 4), the document id (8 bytes), and the token ids. The index file has, for each record, its offset and its whole
length (8 bytes each). Checksums are CRC-32, rotated right by 15 bits, plus a constant, so that
the checksum of data that holds checksums stays sound.
"""

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.tokens import encoded, kept_encoder, largest_id

MASK_DELTA = 0xA282EAD8
# Length, checksum, index entry, and what stands before the ids of a payload.
HEAD, CHECK, ENTRY, DOC, DOC_SIZE = "<Q", "<I", "<QQ", "<?Bq", 10
# Bytes that a reader gathers before it hands them on.
CHUNK = 8 << 20


def masked(data: bytes) -> bytes:
    crc = zlib.crc32(data)
    return struct.pack(CHECK, ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF)


def frame(payload: bytes) -> bytes:
    head = struct.pack(HEAD, len(payload))
    return head + masked(head) + payload + masked(payload)


def unframe(stream) -> bytes | None:
    """The next payload, None at the end; an error where bytes are missing or were changed."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or head[8:] != masked(head[:8]):
        raise ValueError("a record's length is damaged")
    size = struct.unpack(HEAD, head[:8])[0]
    body = stream.read(size + 4)
    if len(body) < size + 4 or body[size:] != masked(body[:size]):
        raise ValueError("a record's payload is damaged")
    return body[:size]


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of every text, each with `end_id` behind it, in ascending `doc_id` order.

    Rows are dealt by range of (doc_id, hash of the text), so rows that share an id spread too;
    null ids come first, repeated rows are all written. A null or empty text is the end id alone.
    An empty table gives a manifest without files. Columns other than doc_id and text are ignored.
    Each task writes files under a name of its own; `manifest` lists those of the tasks that
    counted, so retries and lost executors leave at most files that nobody reads.
    """
    width = 2 if max(end_id, largest_id(tokenizer)) < 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        n_records = n_tokens = offset = 0
        with store.open_output_stream(posixpath.join(base, f"{name}.records")) as data, \
                store.open_output_stream(posixpath.join(base, f"{name}.index")) as index:
            for doc_id, ids in encoded(batches, tokenizer, end_id, kept_encoder(tokenizer)):
                stored = np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()
                record = frame(struct.pack(DOC, doc_id is not None, width, doc_id or 0) + stored)
                data.write(record)
                index.write(struct.pack(ENTRY, offset, len(record)))
                offset += len(record)
                n_records += 1
                n_tokens += len(ids) // 4
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "name": [name], "width": [width], "n_records": [n_records], "n_tokens": [n_tokens]})

    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    written = dealt.mapInArrow(write, "part long, name string, width long, n_records long, n_tokens long")
    written.where("n_records > 0").write.parquet(posixpath.join(path, "manifest"))


def read_records(spark: SparkSession, path: str, shuffle_seed: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record; `start` counts the ids before it.

    With a seed, each file is read through its index in an order that the seed and the file's
    name decide. Damaged records raise an error, and so does a file that has not the records and
    tokens that the manifest says.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        for batch in batches:
            for file in batch.to_pylist():
                data = posixpath.join(base, f"{file['name']}.records")
                if shuffle_seed is None:
                    with store.open_input_stream(data) as stream:
                        yield from tables(in_order(stream, file))
                else:
                    with store.open_input_stream(posixpath.join(base, f"{file['name']}.index")) as stream:
                        index = np.frombuffer(stream.read(), dtype="<u8").reshape(-1, 2)
                    with store.open_input_file(data) as stream:
                        yield from tables(by_index(stream, index, file))

    def whole(file: dict, n_records: int, n_tokens: int) -> None:
        if (n_records, n_tokens) != (file["n_records"], file["n_tokens"]):
            raise ValueError(f"{file['name']} has {n_records} records and {n_tokens} tokens, "
                             f"not {file['n_records']} and {file['n_tokens']}")

    def in_order(stream, file: dict) -> Iterator[tuple]:
        start, n_records = file["start"], 0
        while (payload := unframe(stream)) is not None:
            n = (len(payload) - DOC_SIZE) // payload[1]
            yield start, n, payload
            start += n
            n_records += 1
        whole(file, n_records, start - file["start"])

    def by_index(stream, index: np.ndarray, file: dict) -> Iterator[tuple]:
        # Beside the frame of 16 bytes, a record is its id and the tokens.
        n = (index[:, 1].astype("i8") - 16 - DOC_SIZE) // file["width"]
        whole(file, len(n), int(n.sum()))
        starts = file["start"] + np.cumsum(n) - n
        seed = zlib.crc32(f"{shuffle_seed}/{file['part']}".encode())
        for at in np.random.default_rng(seed).permutation(len(index)).tolist():
            stream.seek(int(index[at, 0]))
            yield int(starts[at]), int(n[at]), unframe(stream)

    def tables(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for start, n, payload in found:
            has_id, width, doc_id = struct.unpack_from(DOC, payload)
            ids = np.frombuffer(payload, f"<u{width}", offset=DOC_SIZE).astype("<u4").tobytes()
            rows.append((doc_id if has_id else None, start, n, ids))
            size += len(ids)
            if size >= CHUNK or len(rows) >= 10_000:
                yield table(rows)
                rows, size = [], 0
        if rows:
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])

    schema = "part long, name string, width long, n_records long, n_tokens long"
    manifest = spark.read.schema(schema).parquet(posixpath.join(path, "manifest"))
    # One row per file: as many as the tasks that wrote.
    files = max(1, manifest.count())
    before = F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    listed = manifest.withColumn("start", F.coalesce(before, F.lit(0))).repartition(files)
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
