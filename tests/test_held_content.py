"""Whole files pass through tasks a few at a time."""

import gzip

import pyarrow as pa

from paperloom.operators import archives


def test_results_are_handed_on_before_the_batch_is_through():
    taken = []

    def one(content):
        taken.append(content)
        return content, content * 2

    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    batch = pa.RecordBatch.from_arrays([pa.array([b"x" * 100_000] * 200)], names=["content"])
    out = archives.gathered((one(*row) for row in archives.rows_of(iter([batch]))), schema)
    first = next(out)
    assert first.num_rows == len(taken) < 20
    assert first.num_rows + sum(b.num_rows for b in out) == len(taken) == 200


def test_batches_of_short_rows_and_of_none():
    schema = pa.schema([("a", pa.binary())])
    sizes = [b.num_rows for b in archives.gathered(((None,) for _ in range(archives.HELD_ROWS + 1)), schema)]
    assert sizes == [archives.HELD_ROWS, 1]
    assert list(archives.gathered(iter(()), schema)) == []


def test_large_payloads_keep_their_rows(spark):
    texts = [bytes([65 + n % 20]) * 700_000 for n in range(30)]
    rows = [(n, gzip.compress(t) if n % 3 else None if n % 2 else b"\x1f\x8b bad", "d%d.nxml" % n) for n, t in enumerate(texts)]
    payloads = spark.createDataFrame(rows, "id long, payload binary, file string").coalesce(1)
    found = {r["id"]: (r["payload"], r["usable"]) for r in archives.decompress(payloads).collect()}
    assert found == {n: (texts[n], True) if n % 3 else (None, False) for n in range(30)}
    plain = spark.createDataFrame([(r[2], texts[r[0]]) for r in rows], "file string, content binary").coalesce(1)

    def lower(file: str, content: bytes) -> bytes:
        if file == "d7.nxml":
            raise ValueError("no luck")
        return content.lower()

    done = {r["file"]: (r["content"], r["error"]) for r in archives.convert(plain, lower).collect()}
    assert done == {f"d{n}.nxml.xml": (None, "ValueError: no luck") if n == 7 else (t.lower(), None) for n, t in enumerate(texts)}
