"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification."""

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm import bloom
from paperloom.llm.bloom import may_hold
from paperloom.llm.components import components
from paperloom.llm.shared import as_rows, stored

# Signature coordinates are BANDS x ROWS. A pair of similarity 0.8 shares no band in one case of 300,000.
BANDS, ROWS = 24, 4
# Members that one leader row is compared with, and members of a bucket in one block of a tile.
BESIDE, BLOCK = 64, 512
# Rounds of stars with drawn members before what is left is compared in tiles.
TURNS = 1
# Texts shingled at a time, by characters.
TEXT_BYTES = 250_000
# Bytes whose sums are held at a time.
HASHED = 1 << 18
# Fixed odd numbers of the hash functions.
BASE, MIX_A, MIX_B, STEP = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93
PERM_A, PERM_B = 0x85EBCA6B, 0xC2B2AE35


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(MIX_A)
    h = (h ^ h >> np.uint64(27)) * np.uint64(MIX_B)
    return h ^ h >> np.uint64(31)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word in the bytes `raw`, and a 64-bit hash of it, from prefix sums of a polynomial.

    Sums are taken HASHED bytes at a time, so a very long text costs memory for its words, not for its bytes.
    """
    blank = (raw == 0x20) | (raw >= 0x09) & (raw <= 0x0D)
    edge = np.diff(np.concatenate(([1], blank, [1])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, back = (powers(base, min(HASHED, len(raw))) for base in (BASE, pow(BASE, -1, 1 << 64)))
    to_start, to_end, moved = (np.empty(len(starts), np.uint64) for _ in range(3))
    before = 0
    for at in range(0, len(raw), HASHED):
        part = raw[at:at + HASHED]
        shift, unshift = (np.uint64(pow(BASE, p, 1 << 64)) for p in (at, -at))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)], dtype=np.uint64, out=sums[1:])
        sums = sums * shift + np.uint64(before)
        own = slice(*np.searchsorted(starts, (at, at + len(part))))
        to_start[own], moved[own] = sums[starts[own] - at], back[starts[own] - at] * unshift
        own = slice(*np.searchsorted(ends, (at, at + len(part)), "right"))
        to_end[own] = sums[ends[own] - at]
        before = int(sums[-1])
    # Moved back to power 0, equal words have equal sums wherever they stand.
    return starts, mixed((to_end - to_start) * moved)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size < TEXT_BYTES):
            size += len(texts[end] or "")
            end += 1
        yield from _shingle_sets([(t or "").encode().lower() for t in texts[at:end]], width)
        at = end


def _shingle_sets(raws: list[bytes], width: int) -> Iterator[np.ndarray]:
    raw = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    starts, words = word_hashes(raw)
    bounds = np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in raws]))
    rolled = words.copy()
    for k in range(1, width):
        n = max(0, len(words) - k)
        rolled[:n] = mixed(rolled[:n] * np.uint64(STEP) + words[k:])
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= width:
            yield np.unique(rolled[first:last - width + 1])
        elif last > first:
            h = words[first:first + 1]
            for k in range(first + 1, last):
                h = mixed(h * np.uint64(STEP) + words[k:k + 1])
            yield h
        else:
            yield words[:0]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Circulant MinHash of non-empty sets: one permutation places a shingle on a circle of 2^32
    positions, another one, shifted by k positions, gives coordinate k."""
    place = (np.concatenate(sets) * np.uint64(MIX_B) >> np.uint64(32)).astype(np.uint32)
    offsets = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        h = place + np.uint32(k)
        h ^= h >> np.uint32(16)
        h *= np.uint32(PERM_A)
        h ^= h >> np.uint32(13)
        h *= np.uint32(PERM_B)
        h ^= h >> np.uint32(16)
        out[:, k] = np.minimum.reduceat(h, offsets)
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    rows = signatures(sets).astype(np.uint64).reshape(len(sets), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
    for k in range(ROWS):
        key = mixed(key * np.uint64(STEP) + rows[:, :, k])
    return key.view(np.int64)


def set_key(hashes: np.ndarray) -> bytes | None:
    """128 bits that tell sets apart; None for an empty one."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def sketches(width: int) -> Callable:
    """(key, text) to (key, n_shingles, node, bands)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = list(shingle_sets(part.column(1).to_pylist(), width))
                full = [s for s in sets if len(s)]
                bands = iter(band_keys(full).tolist() if full else [])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ], names=["key", "n_shingles", "node", "bands"])

    return run


def hashed_sets(width: int, wanted: np.ndarray) -> Callable:
    """(row_hash, text) to (node, hashes) of texts with words whose hash the filter `wanted` lets through."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = may_hold(wanted, batch.column(0).to_numpy(zero_copy_only=False))
            texts = batch.column(1).filter(pa.array(mask))
            for at in range(0, len(texts), 256):
                sets = [s for s in shingle_sets(texts.slice(at, 256).to_pylist(), width) if len(s)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "hashes"])

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 |a and b| >= percent |a or b|, for sorted distinct hashes."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int(np.count_nonzero(large[at] == small))
    return 100 * common >= percent * (len(a) + len(b) - common)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from batch.slice(at, 256).to_pylist()


def link_batches(links: Iterable[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    found = list(links)
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])


def star_links(percent: int) -> Callable:
    """Links of each leader with the members that follow it in the sorted partition."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = hashes = None
        links = []
        for row in rows_of(batches):
            if row["role"] == 0:
                leader, hashes = row["node"], np.frombuffer(row["hashes"], np.uint64)
            elif similar(hashes, np.frombuffer(row["hashes"], np.uint64), percent):
                links.append((leader, row["node"]))
        yield from link_batches(links)

    return run


def tile_links(percent: int) -> Callable:
    """Links within each tile of a bucket, few enough that they join what is similar.

    A tile holds some members outside the bucket's main component, and some of all members. Pairs
    of different components are compared, each in the first band that both share, and none that
    the tile's links join already.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows_of(batches), lambda r: (r["band"], r["part"], r["block"])):
            yield from link_batches(tile(list(group)))

    def tile(rows: list[dict]) -> Iterator[tuple[bytes, bytes]]:
        sets = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        sizes, bands = np.array([len(s) for s in sets]), np.array([r["bands"] for r in rows])
        asked = np.array([r["role"] != 0 for r in rows])
        # Two members outside the main component meet twice; once is enough.
        minor, names = np.array([r["minor"] for r in rows]), np.array([r["node"] for r in rows], object)
        at, part = bands[0].tolist().index(rows[0]["band"]), np.unique([r["root"] for r in rows], return_inverse=True)[1]
        for i in np.flatnonzero(~asked).tolist():
            meets = asked & (bands[:, at] == bands[i, at]) & ~(bands[:, :at] == bands[i, :at]).any(axis=1)
            meets &= ~(minor & (names < names[i]))
            meets &= 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
            for j in np.flatnonzero(meets & (part != part[i])).tolist():
                if part[i] != part[j] and similar(sets[i], sets[j], percent):
                    yield rows[i]["node"], rows[j]["node"]
                    part[part == part[j]] = part[i]

    return run


def buckets_of(classes: DataFrame) -> DataFrame:
    """(band, node, size) of members of buckets with two classes at least, with the bucket's leader, its size, and
    the number of members."""
    members = classes.select("node", "size", F.explode("bands").alias("band"))
    leaders = members.groupBy("band").agg(F.min(F.struct("node", "size")).alias("first"), F.count("*").alias("members"))
    leaders = leaders.where("members > 1").select(
        "band", F.col("first.node").alias("leader"), F.col("first.size").alias("leader_size"), "members")
    return stored(members.join(stored(leaders, "leaders"), "band"), "buckets")


def alike(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def verified_stars(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among pairs (leader, node), checked on full sets.

    A leader stands before at most about BESIDE members at a time, whose sets pass one after another, so
    a leader of a third of all documents is spread over many tasks.
    """
    pairs = stored(pairs.distinct(), "pairs")
    counts = stored(pairs.groupBy("leader").agg(F.ceil(F.count("*") / BESIDE).alias("parts")), "parts")
    dealt = pairs.join(counts, "leader").select(
        "leader", "node", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    heads = counts.select("leader", F.col("leader").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    rows = heads.withColumn("role", F.lit(0)).unionByName(dealt.withColumn("role", F.lit(1)))
    order = ["leader", "part", "role"]
    ready = rows.join(sets.select("node", "hashes"), "node").repartition("leader", "part").sortWithinPartitions(*order)
    return ready.select("role", "node", "hashes").mapInArrow(star_links(percent), "a binary, b binary")


def divided(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (band, node, root, main, minor), other than the leader, of buckets that still hold several
    components, with sizes (n, n_minor); `minor` are those outside the main, the largest, component."""
    rest = stored(buckets.where("node != leader").join(roots, "node", "left").select(
        "band", "node", "size", F.coalesce("root", "node").alias("root")), "rest")
    parts = rest.groupBy("band", "root").agg(F.count("*").alias("n"))
    several = parts.groupBy("band").agg(
        F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("roots"))
    several = stored(several.where("roots > 1").select(
        "band", F.col("main.root").alias("main"), "n", (F.col("n") - F.col("main.n")).alias("n_minor")), "several")
    return stored(rest.join(several, "band").withColumn("minor", F.col("root") != F.col("main")), "divided")


def star_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of a drawn member of the main component with the others, and of a drawn other one with all.

    The draw is a hash of member and turn, so buckets that share their members draw the same ones.
    """
    drawn = members.groupBy("band", "minor").agg(F.min(F.struct(
        F.xxhash64(F.lit(turn), "node").alias("draw"), "node", "root", "size")).alias("drawn"))
    drawn = stored(drawn.select("band", F.col("minor").alias("of_minor"), "drawn.node", "drawn.root", "drawn.size"), "drawn")
    drawn = drawn.select(
        "band", "of_minor", F.col("node").alias("leader"), F.col("root").alias("leader_root"), F.col("size").alias("leader_size"))
    met = members.join(drawn, "band").where("root != leader_root and (minor or of_minor)")
    return met.where(alike("size", "leader_size", percent)).select("leader", "node")


def verified_tiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between `members` of buckets that hold several components.

    What is left to compare are the members outside a bucket's main component, with all members. Both
    are cut into blocks, and a block of the ones with a block of the others is a tile of bounded
    size. Within a tile, links are as few as a tree. So no bucket is capped and no task gets a
    whole bucket.
    """
    members = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).withColumn("parts", F.ceil(F.col("n_minor") / BLOCK))

    def numbers(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("node"), n)

    columns = ["band", "node", "root", "minor"]
    asking = members.where("minor").select(
        *columns, F.lit(0).alias("role"), own("parts").alias("part"), F.explode(numbers("blocks")).alias("block"))
    asked = members.select(
        *columns, F.lit(1).alias("role"), own("blocks").alias("block"), F.explode(numbers("parts")).alias("part"))
    order = ["band", "part", "block"]
    full = asking.unionByName(asked).join(sets, "node")
    return full.repartition(*order).sortWithinPartitions(*order, "role", "node").mapInArrow(
        tile_links(percent), "a binary, b binary")


def near_duplicates(docs: DataFrame, key: str, text: str, width: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, node, root) per row: `node` names its shingle set, `root` its component.

    Words are runs without blanks, A-Z in lower case; a text's set has each of its `width`-word
    shingles once, or its whole sequence if shorter. Texts with equal sets are one class. Classes
    that share a band are candidates. Each bucket's first class is verified against the others, then a few drawn ones are against
    those of other components; where a bucket is still not one component, its members outside the main component are verified
    against all others, in blocks. So every candidate pair is linked or verified, and links are as few as joins need.

    Null or empty texts, and those of blanks alone, have an empty set, no node and no root.
    Null keys and repeated rows are rows like others. An empty table gives no rows. Columns
    other than the two are ignored. Shingles are told apart by 64-bit hashes, sets by 128-bit hashes.
    """
    named = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    named = named.select("key", F.xxhash64("key", "text").alias("row_hash"), "text")
    kind = named.schema["key"].dataType.simpleString()
    sketched = stored(
        named.select(F.struct("key", "row_hash").alias("key"), "text").mapInArrow(
            sketches(width), f"key struct<key:{kind},row_hash:bigint>, n_shingles long, node binary, bands array<bigint>"),
        "sketches")
    classes = stored(sketched.where("node is not null").groupBy("node").agg(
        F.min("key.row_hash").alias("row_hash"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands")), "classes")
    buckets = buckets_of(classes)
    # Texts stay where they are: a filter of bounded size names one row of each class to shingle again.
    wanted = stored(buckets.select("node").distinct().join(classes, "node"), "wanted")
    sets = named.select("row_hash", "text").mapInArrow(
        hashed_sets(width, bloom.build(wanted.select("row_hash"))), "node binary, hashes binary")
    sets = stored(sets.dropDuplicates(["node"]).join(wanted.select("node", "bands"), "node"), "sets")

    def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
        links = stored(links, "links")
        old = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        return roots if links.isEmpty() else stored(components(old.unionByName(links)), "components")

    led = buckets.where("node != leader").where(alike("size", "leader_size", percent))
    stars = verified_stars(led.select("leader", "node"), sets, percent)
    roots = stored(components(stored(stars, "links")), "components")
    for turn in range(TURNS):
        members = divided(buckets, roots)
        if members.isEmpty():
            break
        roots = merged(roots, verified_stars(star_pairs(members, turn, percent), sets, percent))
    else:
        roots = merged(roots, verified_tiles(divided(buckets, roots), sets, percent))
    rows = sketched.select("key.key", "n_shingles", "node")
    return rows.join(roots, "node", "left").select(
        "key", "n_shingles", "node", F.coalesce("root", "node").alias("root"))


def with_first(found: DataFrame) -> DataFrame:
    """Rows of `near_duplicates` with `component_id`, the smallest key of the component.

    A row with an empty set is its own component. Null keys do not count unless there is no other.
    """
    found = stored(found, "found")
    smallest = stored(found.where("root is not null").groupBy("root").agg(F.min("key").alias("first")), "first")
    joined = found.join(smallest, "root", "left")
    return joined.withColumn("component_id", F.when(F.col("root").isNull(), F.col("key")).otherwise(F.col("first"))).drop("first")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of `docs`, unchanged, less all but one of each group of near-duplicates.

    The one that stays has the smallest id (nulls last); of equal ones, the first read. Rows with empty
    texts all stay. Rows travel as one struct, so no column name can clash.
    """
    numbered = stored(as_rows(docs).withColumn("number", F.monotonically_increasing_id()), "numbered")
    texts = numbered.select("number", F.col("row")[text].alias("text"))
    found = near_duplicates(texts, "number", "text", width, percent).where("root is not null")
    ids = stored(numbered.select("number", F.col("row")[doc_id].alias("id")), "ids")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("key").alias("number"))
    best = stored(found.join(ids, found["key"] == ids["number"]).groupBy("root").agg(F.min(order).alias("best")), "best")
    dropped = found.join(best, "root").where(F.col("best.number") != F.col("key")).select(F.col("key").alias("number"))
    return numbered.join(stored(dropped, "dropped"), "number", "left_anti").select("row.*")
