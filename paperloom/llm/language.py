"""Language identification by rank-order n-gram profiles and the out-of-place distance."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# N-grams of 1 to MAX_N characters, and how many a profile ranks.
MAX_N, RANKED = 3, 300
UNKNOWN = "und"
# Characters counted at a time, and distinct n-grams of a language that a task holds before it hands them on.
CHARS, HELD = 500_000, 500_000
CODES = 0x110000


def letter_codes() -> np.ndarray:
    """For each code point its lower-case letter's code point; 0 for all that is no letter."""
    table = np.zeros(CODES, np.int32)
    for code in range(CODES):
        if (c := chr(code)).isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def letters_of(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, one after another, 0 for each other character, and where each text ends.

    Each text has a 0 before and behind it, so n-grams do not reach from one text into the next.
    """
    raw = "\x00" + "\x00".join(t or "" for t in texts) + "\x00"
    codes = table[np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return codes, np.cumsum([len(t or "") + 1 for t in texts])


def ngrams(codes: np.ndarray, starts: int = CHARS) -> np.ndarray:
    """All 1- to 3-grams from the first `starts` places of a run of letters on, as numbers of 63 bits, each with
    at least one letter and none that crosses a word's border further than one place."""
    one = codes[:starts]
    two = (codes[:-1] << 21 | codes[1:])[:starts]
    two = two[((codes[:-1] > 0) | (codes[1:] > 0))[:starts]]
    three = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[:starts]
    return np.concatenate((one[one > 0], two, three[(codes[1:-1] > 0)[:starts]]))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a run of letters and their counts, CHARS places at a time, so that a very long text costs
    memory for its distinct n-grams."""
    grams = counts = np.zeros(0, np.int64)
    for at in range(0, len(codes), CHARS):
        some = codes[at:at + CHARS + 2].astype(np.int64)
        grams, counts = added(grams, counts, *np.unique(ngrams(some), return_counts=True))
    return grams, counts


def added(grams: np.ndarray, counts: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two tables of counted n-grams as one."""
    if not len(grams):
        return more, n
    both, at = np.unique(np.concatenate((grams, more)), return_inverse=True)
    return both, np.bincount(at, np.concatenate((counts, n)), len(both)).astype(np.int64)


def ranked(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, most frequent first, smaller numbers first among equal ones."""
    if len(grams) > RANKED:
        least = np.partition(counts, len(counts) - RANKED)[len(counts) - RANKED]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:RANKED]]


def chunks(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """Rows of a batch, in lists of about CHARS characters."""
    rows, size = [], 0
    for at in range(0, batch.num_rows, 200):
        for row in zip(*[c.to_pylist() for c in batch.slice(at, 200).columns]):
            rows.append(row)
            size += len(row[1] or "")
            if size >= CHARS:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def learn(labelled: DataFrame) -> dict[str, list[int]]:
    """The RANKED most frequent n-grams of each language over all rows (lang, text), in order.

    Each task counts what it reads and hands on sums per language and n-gram; Spark adds these up
    and cuts each language's ranking. The driver gets RANKED numbers per language.
    """
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = letter_codes(), {}
        for batch in batches:
            for rows in chunks(batch):
                for lang in {r[0] for r in rows}:
                    new = counted(letters_of([t for l, t in rows if l == lang], table)[0])
                    grams, _ = held[lang] = added(*held.get(lang, (new[0][:0], new[1][:0])), *new)
                    if len(grams) > HELD:
                        yield from handed(lang, *held.pop(lang))
        for lang, sums in held.items():
            yield from handed(lang, *sums)

    def handed(lang: str, grams: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(grams):
            names = pa.DictionaryArray.from_arrays(np.zeros(len(grams), np.int32), [lang]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(grams), pa.array(sums)], names=["lang", "gram", "n"])

    sums = labelled.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    totals = sums.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = totals.withColumn("rank", rank).where(F.col("rank") <= RANKED)
    profiles: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "rank").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def predict(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """`docs` (tag, text) as (tag, lang_pred, score).

    The distance to a language is the sum, over the document's ranked n-grams, of how far their
    ranks are apart, RANKED where the language does not rank them. The score is one minus the least
    distance over the greatest possible. Of languages equally near, the first by name is taken.
    """
    langs = sorted(profiles)
    known = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
    ranks = np.full((len(known) + 1, len(langs)), -1, np.int64)
    for at, lang in enumerate(langs):
        ranks[np.searchsorted(known, profiles[lang]), at] = np.arange(len(profiles[lang]))

    def nearest(codes: np.ndarray) -> tuple[str, float]:
        grams = ranked(*counted(codes))
        if not len(grams) or not langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(known, grams)
        at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != grams)] = len(known)
        places = ranks[at]
        apart = np.where(places < 0, RANKED, np.abs(places - np.arange(len(grams))[:, None])).sum(0)
        best = int(np.argmin(apart))
        return langs[best], float(1 - apart[best] / (RANKED * len(grams)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_codes()
        for batch in batches:
            for rows in chunks(batch):
                codes, ends = letters_of([t for _, t in rows], table)
                found = [nearest(codes[start:end + 1]) if codes[start:end + 1].any() else (UNKNOWN, 0.0)
                         for start, end in zip([0, *ends[:-1].tolist()], ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], batch.schema.field(0).type), pa.array([f[0] for f in found]),
                     pa.array([f[1] for f in found])], names=["tag", "lang_pred", "score"])

    kind = docs.schema["tag"].dataType.simpleString()
    return docs.select("tag", "text").mapInArrow(run, f"tag {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of `docs` (doc_id, text, lang).

    Profiles come from all texts with a language that are not held out; a prediction sees the text
    alone. `und` with score 0 where the text is null or has no letter, or nothing was learnt. A null
    id is not held out. Repeated rows count each time and are predicted alike. An empty table gives no
    rows; other columns are ignored.
    """
    rows = docs.select(F.struct("doc_id", held_out(F.col("doc_id")).alias("held_out")).alias("tag"), "text", "lang")
    labelled = rows.where("not tag.held_out and lang is not null and text is not null")
    return predict(rows, learn(labelled)).select("tag.*", "lang_pred", "score")
