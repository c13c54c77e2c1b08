"""Spelling variants: generated edits probe Bloom filters by length, an exact join removes what is not a word.

Words are runs of A-Z, a-z and U+00C0 to U+00FF, so a letter is one byte in Latin-1, and words of one
length are the rows of a byte matrix. A word's hash is a sum over its places, so the hash of an edit
follows from the word's by an addition, without the edit being spelt out.
"""

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import pieces, stored

MIN_LETTERS, MIN_COUNT, RATIO, TYPOS = 7, 2, 10, 31
# Distinct words that a task counts before it hands them on.
HELD_WORDS = 1 << 18
# Blocks of 512 bits, at most MAX_BLOCKS (64 MB) in all filters together; words beyond that make the
# filters let through more, which the exact join removes. Lengths from LONG on share one filter.
BLOCK_WORDS, LANES, MAX_BLOCKS, LONG = 32, 8, 1 << 20, 256
# Edits that are probed at once.
PROBES = 1 << 20
SALTS = np.random.default_rng(13).integers(0, 1 << 32, LANES, dtype=np.uint64) | np.uint64(1)


def counted_runs(text: bytes, letters: re.Pattern) -> Counter:
    runs = Counter()
    for piece in pieces(text):
        runs.update(letters.findall(piece.lower()))
    return runs


def count_rows(min_letters: int, typos: int) -> Callable:
    """(id, text) to (word, n), several rows a word."""
    letters = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % min_letters)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()

        def flush() -> pa.RecordBatch:
            words = [w.decode() for w in found]
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])
            found.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run_, n in counted_runs(text or b"", letters).items():
                    code = zlib.crc32(run_, start)
                    if code % typos == 0:
                        word = run_.decode()
                        at = code % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_letters:
                            continue
                        run_ = word.encode()
                    found[run_] += n
                if len(found) > HELD_WORDS:
                    yield flush()
        yield flush()

    return run


def vocabulary(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT, typos: int = TYPOS,
) -> DataFrame:
    """(word, n): all words of whole texts with so many letters and so many occurrences.

    One run in about `typos`, by the checksum of document id and run, loses a letter first. A null text
    has no words, a null id is written as nothing; repeated rows count each time. Counts are summed up
    in each task before the shuffle, so a word on every page is a row a task.
    """
    given = docs.select(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`").cast("binary"))
    counts = given.mapInArrow(count_rows(min_letters, typos), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers, one for one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def place_codes(places: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """A random number per place and letter."""
    return mixed((places.astype(np.uint64) * np.uint64(256) + letters + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in `words`, letters as rows) of words of one length, so many that a matrix stays small."""
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes):
        rows, step = np.flatnonzero(sizes == size), max(1, (1 << 20) // int(size))
        for start in range(0, len(rows), step):
            some = rows[start:start + step]
            letters = np.frombuffer("".join(words[i] for i in some).encode("latin-1"), np.uint8)
            yield some, letters.reshape(len(some), size)


@dataclass(frozen=True)
class Filters:
    """Blocked Bloom filters: words of length s have `blocks[s]` blocks from `first[s]` on."""

    first: np.ndarray
    blocks: np.ndarray
    bits: np.ndarray

    def places(self, codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Block and scrambled code of words of one length; needs a filter for it."""
        scrambled, s = mixed(codes + np.uint64(size)), min(size, LONG)
        block = (scrambled >> np.uint64(32)) * np.uint64(self.blocks[s]) >> np.uint64(32)
        return block.astype(np.int64) + self.first[s], scrambled

    def has(self, size: int) -> bool:
        return size > 0 and self.blocks[min(size, LONG)] > 0

    def positive(self, codes: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the codes whose bits are all set; most others drop out at the first lane."""
        block, scrambled = self.places(codes, size)
        left = np.arange(len(codes))
        for lane in range(LANES):
            bit = lane_bits(scrambled, lane)
            hit = (self.bits[block, lane] >> bit & np.uint64(1)).astype(bool)
            left, block, scrambled = left[hit], block[hit], scrambled[hit]
        return left


def lane_bits(scrambled: np.ndarray, lane: int) -> np.ndarray:
    return ((scrambled & np.uint64(0xFFFFFFFF)) * SALTS[lane] & np.uint64(0xFFFFFFFF)) >> np.uint64(26)


def codes_of(letters: np.ndarray) -> np.ndarray:
    return place_codes(np.arange(letters.shape[1]), letters).sum(1, dtype=np.uint64)


def filter_rows(filters: Filters) -> Callable:
    """(word) to (block, l0, ...): the bits that words set."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for _, letters in by_length(words):
                block, scrambled = filters.places(codes_of(letters), letters.shape[1])
                lanes = [(np.uint64(1) << lane_bits(scrambled, lane)).view(np.int64) for lane in range(LANES)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), *map(pa.array, lanes)], names=["block", *[f"l{i}" for i in range(LANES)]])

    return run


def build_filters(words: DataFrame, max_blocks: int = MAX_BLOCKS) -> Filters:
    """Filters over `words` (word): at most `max_blocks` blocks, and one for each length besides.

    Tasks set bits, Spark joins them by block; the driver gets the blocks, never words.
    """
    size = F.least(F.char_length("word"), F.lit(LONG)).alias("size")
    per_size = dict(words.groupBy(size).agg(F.count("*")).collect())
    share = min(1.0, max_blocks * BLOCK_WORDS / max(1, sum(per_size.values())))
    blocks = np.zeros(LONG + 1, np.int64)
    for s, n in per_size.items():
        blocks[s] = max(1, int(n * share) // BLOCK_WORDS)
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    empty = Filters(first, blocks, np.zeros((0, LANES), np.uint64))
    lanes = [f"l{i}" for i in range(LANES)]
    set_bits = words.select("word").mapInArrow(filter_rows(empty), "block long, " + ", ".join(f"{c} long" for c in lanes))
    filled = set_bits.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in lanes]).toArrow()
    bits = np.zeros((int(blocks.sum()), LANES), np.uint64)
    if filled.num_rows:
        bits[filled["block"].to_numpy()] = np.stack([filled[c].to_numpy().view(np.uint64) for c in lanes], 1)
    return Filters(first, blocks, bits)


def deletions(letters: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place) of probable words one letter shorter; of equal letters in a row only the first goes."""
    m, size = letters.shape
    if size < 2 or not filters.has(size - 1):
        return
    places = np.arange(size)
    kept = place_codes(places, letters)
    moved = place_codes(places[1:] - 1, letters[:, 1:])
    before = np.cumsum(kept, 1, dtype=np.uint64) - kept
    behind = np.zeros_like(kept)
    behind[:, :-1] = np.cumsum(moved[:, ::-1], 1, dtype=np.uint64)[:, ::-1]
    own = np.ones((m, size), bool)
    own[:, 1:] = letters[:, 1:] != letters[:, :-1]
    rows, at = np.nonzero(own)
    left = filters.positive((before + behind)[rows, at], size - 1)
    yield rows[left], at[left]


def replacements(letters: np.ndarray, filters: Filters, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, letter) of probable words with one letter replaced by a greater one."""
    m, size = letters.shape
    if not filters.has(size):
        return
    codes = codes_of(letters)
    many = max(1, PROBES // (size * len(alphabet)))
    for row in range(0, m, many):
        for place in range(0, size, max(1, PROBES // len(alphabet))):
            some = letters[row:row + many, place:place + max(1, PROBES // len(alphabet))]
            places = np.arange(place, place + some.shape[1])
            table = place_codes(places[:, None], alphabet[None, :])
            rows, at, which = np.nonzero(alphabet > some[:, :, None])
            probes = (codes[row:row + many, None] - place_codes(places, some))[rows, at] + table[at, which]
            left = filters.positive(probes, size)
            yield rows[left] + row, at[left] + place, alphabet[which[left]]


def probe_rows(filters: Filters, alphabet: np.ndarray) -> Callable:
    """(word, n) to (word, n, other): edits that the filters let through."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for rows, letters in by_length(words):
                found = [(r, at, "") for some in deletions(letters, filters) for r, at in zip(*map(np.ndarray.tolist, some))]
                found += [(r, at, chr(c)) for some in replacements(letters, filters, alphabet)
                          for r, at, c in zip(*map(np.ndarray.tolist, some))]
                if found:
                    from_rows = rows[[r for r, _, _ in found]]
                    own = [words[i] for i in from_rows]
                    others = [w[:at] + new + w[at + 1:] for w, (_, at, new) in zip(own, found)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), pa.array(counts[from_rows]), pa.array(others)], names=["word", "n", "other"])

    return run


def near_pairs(words: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(word, n, other, other_n): all pairs of `words` (word, n) one edit apart, each pair once.

    An insertion is a deletion in the other word, and of two words that differ in one letter the one
    with the smaller letter finds the other, so nothing is probed twice. `words` should be stored.
    """
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabet = np.array(sorted(ord(r[0]) for r in letters.where("letter != ''").collect()), np.uint8)
    filters = build_filters(words, max_blocks)
    probable = words.mapInArrow(probe_rows(filters, alphabet), "word string, n long, other string")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return probable.join(others, "other").select("word", "n", "other", "other_n")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain that each row (word, form) starts.

    Steps double, and a form is `ratio` times as frequent as its word, so rounds are few. One count a
    round goes to the driver.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.drop("moved")


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT, ratio: int = RATIO, typos: int = TYPOS, max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    `n_near` counts the words one edit away. `form` is the most frequent of them, the first in code-point
    order among equals, if it is `ratio` times as frequent as the word; else null. `root` is reached by
    following forms. Texts without words and empty tables give no rows.
    """
    words = stored(vocabulary(docs, doc_id, text, min_letters, min_count, typos), "vocabulary")
    ways = F.array(
        F.struct("word", F.col("n").alias("n"), "other", F.col("other_n").alias("m")),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = near_pairs(words, max_blocks).select(F.inline(ways)).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    judged = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "judged")
    roots = last_forms(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
