"""Benchmark decontamination: windows of test words in a broadcast hash set, verified, then cut out of the texts.

A word is a run of ASCII letters, digits and anything beyond ASCII; A to Z count as a to z. A window
is 10 consecutive words of a test item, or the whole item if it has fewer.
"""

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import as_rows, pieces, stored

WINDOW = 10
# Test words that travel to the tasks at once. Larger test sets take a turn over the texts per part.
PART_WORDS, PIECE_WORDS = 1 << 20, 1 << 12
# Words of texts that are looked at together.
GROUP_WORDS = 1 << 18
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return WORDS.findall(text.lower())


def cut_items(window: int) -> Callable:
    """(item, text) to pieces (item, words) that overlap such that each window lies in one of them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*[c.to_pylist() for c in batch.columns]):
                words = words_of(text or b"")
                starts = range(0, max(1, len(words) - window + 1), PIECE_WORDS) if words else ()
                found = [words[s:s + PIECE_WORDS + window - 1] for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.string()), pa.array(found, pa.list_(pa.binary()))], names=["item", "words"])

    return run


def word_codes(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 64, n, dtype=np.uint64, endpoint=False) | np.uint64(1)


def window_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit number per window of `size` consecutive codes."""
    n, out = len(codes) - size + 1, np.zeros(max(0, len(codes) - size + 1), np.uint64)
    for k in range(size if n > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + n]
    return out ^ (out >> np.uint64(29))


@dataclass(frozen=True)
class Windows:
    """All windows of one size: sorted codes, the words of each, and its items from `starts` on in `items`."""

    size: int
    codes: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    items: np.ndarray


@dataclass(frozen=True)
class HashSet:
    """Words of a part of the test set by number (0: any other), their codes, item names, windows by size."""

    numbers: dict[bytes, int]
    codes: np.ndarray
    names: list[str | None]
    windows: list[Windows]


def hash_set(found: list[tuple[str | None, list[bytes]]], window: int) -> HashSet:
    """The windows of the given (item, words); no two windows share a code."""
    numbers = {w: i for i, w in enumerate(sorted({w for _, words in found for w in words}), 1)}
    names = sorted({item for item, _ in found if item is not None}) + [None]
    place = {name: i for i, name in enumerate(names)}
    by_size: dict[int, tuple[list, list]] = {}
    for item, words in found:
        size = min(window, len(words))
        rows = np.lib.stride_tricks.sliding_window_view(np.array([numbers[w] for w in words], np.int32), size)
        all_rows, items = by_size.setdefault(size, ([], []))
        all_rows.append(rows)
        items.append(np.full(len(rows), place[item]))
    distinct = {}
    for size, (rows, items) in by_size.items():
        unique, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate(items)], 1), axis=0)
        distinct[size] = unique, np.searchsorted(pairs[:, 0], np.arange(len(unique) + 1)), pairs[:, 1]
    seed = 0
    while True:
        codes = word_codes(len(numbers) + 1, seed)
        windows = []
        for size, (unique, starts, items) in distinct.items():
            own = np.concatenate([window_codes(codes[row], size) for row in unique])
            order = np.argsort(own)
            bounds = np.stack([starts[:-1][order], starts[1:][order]], 1)
            windows.append(Windows(size, own[order], unique[order], bounds, items))
        if all(len(np.unique(w.codes)) == len(w.codes) for w in windows):
            return HashSet(numbers, codes, names, windows)
        seed += 1


def hits(tests: HashSet, numbers: np.ndarray) -> Iterator[tuple[Windows, np.ndarray, np.ndarray]]:
    """(windows, places, which): where windows occur in a row of word numbers; 0 never matches."""
    known = np.concatenate([[0], np.cumsum(numbers == 0)])
    codes = tests.codes[numbers]
    for w in tests.windows:
        if len(numbers) < w.size:
            continue
        whole = np.flatnonzero(known[w.size:] == known[:-w.size])
        own = window_codes(codes, w.size)[whole]
        which = np.minimum(np.searchsorted(w.codes, own), len(w.codes) - 1)
        same = w.codes[which] == own
        places, which = whole[same], which[same]
        sure = (numbers[places[:, None] + np.arange(w.size)] == w.words[which]).all(1)
        if sure.any():
            yield w, places[sure], which[sure]


def in_slices(tests: HashSet, numbers: np.ndarray) -> Iterator[tuple[Windows, np.ndarray, np.ndarray]]:
    """As `hits`, in slices that overlap by the longest window less one word."""
    over = max((w.size for w in tests.windows), default=1) - 1
    for start in range(0, len(numbers), GROUP_WORDS):
        for w, places, which in hits(tests, numbers[start:start + GROUP_WORDS + over]):
            own = places < GROUP_WORDS  # the others are the next slice's
            yield w, places[own] + start, which[own]


def numbers_of(text: bytes, known: dict[bytes, int]) -> np.ndarray:
    """Word numbers of a whole text; very long ones are split piece by piece."""
    parts = [np.fromiter(map(known.get, found, repeat(0)), np.int32, len(found))
             for found in map(words_of, pieces(text))]
    return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts])


def scan_group(tests: HashSet, texts: list[np.ndarray], spans: list, items: list) -> None:
    """Adds what occurs in the texts to their spans [start, end) of words and to their items."""
    # A zero between texts keeps windows inside one.
    ends = np.cumsum([len(t) + 1 for t in texts])
    joined = np.zeros(ends[-1], np.int32)
    for t, end in zip(texts, ends):
        joined[end - len(t) - 1:end - 1] = t
    change = np.zeros(len(joined) + 1, np.int32)
    touched = set()
    for w, places, which in in_slices(tests, joined):
        np.add.at(change, places, 1)
        np.add.at(change, places + w.size, -1)
        home = np.searchsorted(ends, places, "right")
        for i, k in np.unique(np.stack([home, which], 1), axis=0).tolist():
            touched.add(i)
            items[i].update(tests.names[j] for j in w.items[slice(*w.starts[k])])
    for i in touched:
        first = ends[i] - len(texts[i]) - 1
        for start, end in spans[i]:
            change[first + start] += 1
            change[first + end] -= 1
    if touched:
        covered = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]])
        turns = np.diff(covered)
        starts, stops = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        for i in touched:
            first, last = ends[i] - len(texts[i]) - 1, ends[i]
            own = slice(np.searchsorted(starts, first), np.searchsorted(starts, last))
            spans[i] = list(zip((starts[own] - first).tolist(), (stops[own] - first).tolist()))


def scan_rows(tests: HashSet) -> Callable:
    """(row, text, spans, items, n_words) with the hits of this part of the test set added."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(s["start"], s["end"]) for s in row] for row in batch.column("spans").to_pylist()]
            items = [set(row) for row in batch.column("items").to_pylist()]
            counts, group, first, held = [], [], 0, 0

            def close() -> None:
                part = spans[first:len(counts)]
                scan_group(tests, group, part, items[first:len(counts)])
                spans[first:len(counts)] = part

            for text in batch.column("text"):
                numbers = numbers_of(text.as_py() or b"", tests.numbers)
                counts.append(len(numbers))
                group.append(numbers)
                held += len(numbers)
                if held > GROUP_WORDS:
                    close()
                    group, first, held = [], len(counts), 0
            if group:
                close()
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"),
                 pa.array([[{"start": a, "end": b} for a, b in row] for row in spans], pa.list_(span)),
                 pa.array([sorted(row - {None}) for row in items], pa.list_(pa.string())),
                 pa.array(counts, pa.int64())], names=["row", "text", "spans", "items", "n_words"])

    return run


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item: str = "item_id",
    window: int = WINDOW, part_words: int = PART_WORDS,
) -> DataFrame:
    """(row, text, spans, items, n_words): where whole texts hold windows of the test items.

    `spans` are the runs [start, end) of word places that lie in any occurrence, in order and apart;
    `items` the ids, as strings, of the items with an occurring window. A null or blank text has no
    words; an item without words has no window; an item without id marks words, but is not named.
    Repeated rows are judged each; rows of one item id are one item. `row` is the unchanged row.

    Test words travel with the job, `part_words` at once and one piece of an item more at most. A larger
    test set is split by pieces into parts, with one turn over the texts for each, written in between.
    """
    tests = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("text"))
    cut = stored(tests.mapInArrow(cut_items(window), "item string, words array<binary>"), "tests")
    total = cut.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(1, -(-total // part_words))
    rows = as_rows(docs)
    found = rows.select(
        "row", F.col("row")[text].cast("binary").alias("text"),
        F.expr("cast(array() as array<struct<start: long, end: long>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"), F.lit(0).cast("long").alias("n_words"))
    schema = found.schema
    for part in range(parts):
        chosen = cut.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part)
        windows = hash_set([(r["item"], [bytes(w) for w in r["words"]]) for r in chosen.collect()], window)
        found = found.mapInArrow(scan_rows(windows), schema)
        if part + 1 < parts:
            found = stored(found, "scanned")
    return found


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def cut_words(text: bytes, spans: list[dict]) -> bytes:
    """The text less its spans of words, from the first byte of a span's first word to the last of its last."""
    left, at, k = [], 0, 0
    begin = 0
    for place, word in enumerate(WORDS.finditer(text.lower())):
        if k == len(spans):
            break
        if place == spans[k]["start"]:
            begin = word.start()
        if place == spans[k]["end"] - 1:
            left.append(text[at:begin])
            at, k = word.end(), k + 1
    return b"".join([*left, text[at:]])


def cut_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        texts = [cut_words(t, s) if t is not None and s else t
                 for t, s in zip(columns["text"].to_pylist(), columns["spans"].to_pylist())]
        columns["text"] = pa.array(texts, pa.binary())
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def remove_spans(scanned: DataFrame) -> DataFrame:
    """(row, text, ...): every document, its text less the words in spans and what stands between these."""
    cleaned = scanned.mapInArrow(cut_rows, scanned.schema)
    return cleaned.withColumn("text", F.col("text").cast("string"))


def remove_documents(scanned: DataFrame) -> DataFrame:
    """The rows of documents without any hit, as given."""
    return scanned.where(F.size("spans") == 0).select("row.*")
