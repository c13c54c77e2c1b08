"""Balanced label propagation: equal texts move to one shard, under quotas that keep sizes even."""

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.shared import running_before, stored

SHARDS, ROUNDS = 24, 24
# Links of more than this part of a shard move into what room the others leave.
LARGE = 8


def narrow_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, link, bucket), written once; `bucket` is the task that read the row."""
    text = F.coalesce("text", F.lit(""))
    return stored(docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("link"),
        F.spark_partition_id().alias("bucket"),
    ), "shard-rows")


def first_labels(rows: DataFrame, shards: int) -> DataFrame:
    """(link, size, shard, n) of linked documents: those of a link in one shard are one row."""
    at = F.pmod(F.xxhash64("doc_id", "bucket"), F.lit(shards)).cast("int")
    labels = rows.groupBy("link", "size", at.alias("shard")).agg(F.count("*").alias("n"))
    linked = F.sum("n").over(W.partitionBy("link")) > 1
    return stored(labels.withColumn("linked", linked).where("linked").drop("linked"), "labels")


def by_shard(rows: DataFrame, shard: str, amount: Column) -> dict[int, int]:
    """Sum of `amount` per shard; one entry per shard at most."""
    return {r[0]: r[1] for r in rows.groupBy(shard).agg(F.sum(amount)).collect()}


def per_shard(shard: Column, values: dict[int, float], shards: int) -> Column:
    listed = F.array(*[F.lit(float(values.get(s, 0.0))) for s in range(shards)])
    return F.element_at(listed, shard.cast("int") + 1)


def drawn(n: Column, share: Column, seed: int) -> Column:
    """n x share, rounded up or down by a hash of link and shard."""
    u = F.pmod(F.xxhash64(F.lit(seed), "link", "shard"), F.lit(1 << 53)) / float(1 << 53)
    return F.least(n, F.floor(n * share + u)).cast("long")


def propagate(labels: DataFrame, quota: float, shards: int, rounds: int) -> DataFrame:
    """Move documents to the shard where most neighbours are and there is room.

    Each round, the documents of a link wish to be in the shard with most of that link, among
    shards with room; those in a shard with more stay, and so do those in one with as many that has
    room and a smaller number. If more
    bytes wish into a shard than there is room, each row moves the share that fits, links of a
    LARGE-th of a shard or more after all others. It ends when nobody moves; `rounds` bounds it, as a link that fills several shards fills one a round.
    """
    for turn in range(rounds):
        load = by_shard(labels, "shard", F.col("n") * F.col("size"))
        room = {s: quota - load.get(s, 0) for s in range(shards)}
        is_open = F.col("shard").isin([s for s in room if room[s] > 0])
        weight = F.struct("n", is_open.alias("open"), (-F.col("shard")).alias("first"))
        link = W.partitionBy("link")
        wishes = labels.withColumn("best", F.max(F.when(is_open, weight)).over(link)).select(
            "link", "size", "shard", "n", (F.sum("n").over(link) * F.col("size") > quota / LARGE).alias("large"),
            F.when(weight < F.col("best"), -F.col("best.first")).cast("int").alias("to"))
        moving = wishes.where("to is not null")
        bytes_of = F.col("n") * F.col("size")
        small = by_shard(moving.where("not large"), "to", bytes_of)
        large = by_shard(moving.where("large"), "to", bytes_of)
        if not small and not large:
            break
        first = {s: max(0.0, min(1.0, room[s] / small[s])) for s in small}
        then = {s: max(0.0, min(1.0, (room[s] - small.get(s, 0)) / large[s])) for s in large}
        share = F.when(F.col("large"), per_shard(F.col("to"), then, shards)).otherwise(
            per_shard(F.col("to"), first, shards))
        moves = F.when(F.col("to").isNull(), F.lit(0)).otherwise(drawn(F.col("n"), share, turn))
        parts = F.array(
            F.struct(F.col("shard"), (F.col("n") - F.col("moves")).alias("n")),
            F.struct(F.coalesce("to", "shard").alias("shard"), F.col("moves").alias("n")))
        moved = wishes.withColumn("moves", moves).select("link", "size", F.inline(parts)).where("n > 0")
        labels = stored(moved.groupBy("link", "size", "shard").agg(F.sum("n").alias("n")), "labels")
    return labels


def within_quota(labels: DataFrame, quota: float, shards: int) -> DataFrame:
    """Labels less what is above the quota of a shard, taken from links that are cut as far as they reach."""
    cut = F.count("*").over(W.partitionBy("link")) > 1
    marked = labels.withColumn("cut", cut)
    weight = F.col("n") * F.col("size")
    load, of_cut = by_shard(labels, "shard", weight), by_shard(marked.where("cut"), "shard", weight)
    over = {s: max(0.0, b - quota) for s, b in load.items()}
    first = {s: min(1.0, over[s] / of_cut[s]) for s in of_cut}
    then = {s: max(0.0, over[s] - of_cut.get(s, 0)) / max(1, load[s] - of_cut.get(s, 0)) for s in over}
    share = F.when(F.col("cut"), per_shard(F.col("shard"), first, shards)).otherwise(per_shard(F.col("shard"), then, shards))
    return marked.withColumn("n", F.col("n") - drawn(F.col("n"), share, -1)).drop("cut")


def level(loads: list[float], free: float) -> float:
    """The load up to which shards are filled when `free` bytes are poured over them."""
    sums = accumulate(sorted(loads))
    return min((free + s) / k for k, s in enumerate(sums, 1))


def numbered(within: list[str]) -> Column:
    """0, 1, 2, ... within a key, as long as `before` counts the rows of earlier buckets."""
    order = W.partitionBy(*within, "bucket").orderBy("doc_id", "text_crc32", "size")
    return F.col("before") + F.row_number().over(order) - 1


def with_number(rows: DataFrame, within: list[str], name: str) -> DataFrame:
    """Number rows from 0 within a key; each task numbers one bucket's rows of a key."""
    totals = stored(rows.groupBy(*within, "bucket").agg(F.count("*").alias("in_bucket")), "totals")
    before = running_before(totals, "in_bucket", within).drop("in_bucket")
    return rows.join(before, [*within, "bucket"]).withColumn(name, numbered(within)).drop("before")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of `docs`.

    Documents with equal texts are linked. They are spread by hash and then move by label
    propagation; a link larger than a shard is cut over as few as hold it. Sizes are even by law
    `bytes`: what no link holds, or what an overfull shard must give back, is poured over the shards up to
    one level, in the order of the table, so shards differ by about one document.

    All copies of a link in one shard are one row with a count, so links with a third of the
    documents are a few rows. Counts by shard, `shards` numbers at most, are all the driver gets.
    A null text counts as empty. Null ids and repeated rows are documents like others; slots among
    equal rows are interchangeable. Columns other than doc_id and text are ignored. An empty table
    gives no rows.
    """
    rows = narrow_rows(docs)
    total = rows.agg(F.sum("size")).first()[0] or 0
    labels = propagate(first_labels(rows, shards), total / shards, shards, rounds)

    labels = stored(within_quota(labels, total / shards, shards), "labels")
    load = by_shard(labels, "shard", F.col("n") * F.col("size"))
    places = stored(labels.groupBy("link").agg(F.collect_list(F.struct("shard", "n")).alias("places")), "places")

    joined = rows.join(places, "link", "left")
    linked = with_number(stored(joined.where("places is not null"), "linked"), ["link"], "nth")
    # The place where the running count of the link's places passes the document's number.
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("int").alias("shard"))
    found = F.aggregate("places", start, lambda acc, p: F.struct(
        (acc["upto"] + p["n"]).alias("upto"),
        F.coalesce(acc["shard"], F.when(F.col("nth") < acc["upto"] + p["n"], p["shard"])).alias("shard")))["shard"]
    columns = ["doc_id", "size", "text_crc32", "bucket"]
    placed = stored(linked.select(*columns, found.alias("shard")), "placed")

    single = joined.where("places is null").select(*columns)
    free = stored(single.unionByName(placed.where("shard is null").select(*columns)), "free")
    bytes_free = total - sum(load.values())
    height = level([load.get(s, 0) for s in range(shards)], bytes_free)
    bounds = list(accumulate(max(0.0, height - load.get(s, 0)) for s in range(shards)))
    sums = stored(free.groupBy("bucket").agg(F.sum("size").alias("bytes")), "sums")
    order = W.partitionBy("bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(W.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("size").over(order) - F.col("size") / 2
    passed = sum(((F.col("middle") >= b).cast("int") for b in bounds[:-1]), F.lit(0))
    poured = free.join(running_before(sums, "bytes", []).drop("bytes"), "bucket").withColumn("middle", middle)
    whole = stored(placed.where("shard is not null").unionByName(
        poured.select(*columns, passed.alias("shard"))), "sharded")
    return with_number(whole, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
