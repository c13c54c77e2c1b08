"""Mixing sources to target weights by repetition rates and hash-seeded draws."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.shared import WORD, as_rows, running_before, stored

WEIGHTS, MAX_RATE, SEED = (5.0, 2.0, 1.0), 3, 20260
KEYS = ("_no_source", "_source")
# Values of a draw, and of a slice of them; there are 2^20 slices.
DRAWS, SLICE = 1 << 53, 1 << 33


def source_keys(source: Column) -> dict[str, Column]:
    """Two join keys that hold any source, null too, which sorts last."""
    return {"_no_source": source.isNull(), "_source": F.coalesce(source, F.lit(""))}


def targets(sizes: DataFrame, weights: tuple[float, ...], max_rate: int) -> DataFrame:
    """Per source: `target` and `rate`, from rows (_no_source, _source, source_size).

    Sources by code point, null last, take `weights` in turn. A target is weight x level, but at
    most `max_rate` x size, with one level for all, such that targets add up to the sum of sizes.
    Sorted by the level at which they reach their limit, the first so many sources are at theirs;
    the level follows from what the others share. One row per source passes one task.
    """
    nth = F.row_number().over(W.orderBy(*KEYS)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(nth, F.lit(len(weights))).cast("int") + 1)
    ranked = sizes.select("*", weight.alias("weight")).select(
        "*", (F.col("source_size") * max_rate).alias("limit"),
        (F.col("source_size") * max_rate / F.col("weight")).alias("full_at"))
    everything = W.orderBy("full_at", *KEYS).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    behind = W.orderBy("full_at", *KEYS).rowsBetween(W.currentRow, W.unboundedFollowing)
    before = W.orderBy("full_at", *KEYS).rowsBetween(W.unboundedPreceding, -1)
    # The level if the sources before this one were at their limit and no other.
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))) \
        / F.sum("weight").over(behind)
    tried = ranked.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("full_at"), F.col("level"))
    chosen = F.first(fits, ignorenulls=True).over(everything)
    target = F.coalesce(F.least(F.col("weight") * chosen, F.col("limit").cast("double")), F.col("limit").cast("double"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(max_rate)))).otherwise(0.0)
    return tried.select(*KEYS, "source_size", target.alias("target"), rate.alias("rate"))


def draw(*columns: Column) -> Column:
    """A number in [0, DRAWS) that a hash of the values decides."""
    return F.pmod(F.xxhash64(*columns), F.lit(DRAWS))


def limits(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source of `wanted`: `limit`, so that the documents (size, draw) drawn below it hold `extra` words.

    In the order of draws, words are summed up to the document that crosses `extra`; it is in if the
    sum comes nearer to `extra` with it. Documents of one draw go together. Sums run over slices of the
    draws, so a source with a third of the rows is no single task; the slice with the crossing alone
    is looked at by document.
    """
    sliced = sizes.where("size > 0").withColumn("bucket", F.floor(F.col("draw") / SLICE))
    totals = sliced.groupBy(*KEYS, "bucket").agg(F.sum("size").alias("size"))
    extras = wanted.select(*KEYS, "extra").where("extra > 0")
    crossing = stored(running_before(totals, "size", list(KEYS)).join(extras, list(KEYS)).where(
        "before < extra and extra <= before + size").select(*KEYS, "bucket", "before", "extra"), "crossing")
    near = sliced.join(crossing, [*KEYS, "bucket"]).groupBy(*KEYS, "draw", "before", "extra").agg(F.sum("size").alias("size"))
    summed = near.withColumn("upto", F.col("before") + F.sum("size").over(W.partitionBy(*KEYS).orderBy("draw")))
    ways = F.array(
        F.struct(F.abs(F.col("upto") - F.col("extra")).alias("off"), (F.col("draw") + 1).alias("limit")),
        F.struct(F.abs(F.col("upto") - F.col("size") - F.col("extra")).alias("off"), F.col("draw").alias("limit")))
    return summed.select(*KEYS, F.inline(ways)).groupBy(*KEYS).agg(F.min(F.struct("off", "limit"))["limit"].alias("limit"))


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED,
) -> DataFrame:
    """(row, size, source_size, target, copies): how often the mix takes each document.

    `size` is the number of words (null text: 0). A source's rate is target / size. A document is
    taken floor(rate) times, and once more if a draw from a hash of seed, id, source and text is below
    its source's limit. The limit is the fraction of the rate, moved to where the words of the documents
    drawn come nearest to that fraction of the source's words: a source strays from its target by
    less than one document. Reruns agree and repeated rows share their draw. Sources without words
    have rate 0. Nulls are values like others. `row` is the unchanged row, so no column name can clash.

    Texts are not shuffled: sizes and draws are written as a narrow table, from which sums per source
    follow map-side; what is joined to the rows is one row per source, of known size.
    """
    keys = source_keys(F.col("row")[source])
    sized = as_rows(docs).select(
        "row", *[c.alias(k) for k, c in keys.items()],
        F.coalesce(F.regexp_count(F.col("row")[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        draw(F.lit(seed), F.col("row")[doc_id], F.col("row")[source], F.col("row")[text]).alias("draw"))
    sizes = stored(sized.drop("row"), "sizes")
    wanted = targets(sizes.groupBy(*KEYS).agg(F.sum("size").alias("source_size")), weights, max_rate)
    whole = F.floor("rate")
    extra = (F.col("rate") - whole) * F.col("source_size")
    wanted = stored(wanted.withColumn("whole", whole).withColumn("extra", extra), "targets")
    settled = stored(wanted.join(limits(sizes, wanted), list(KEYS), "left").drop("extra", "rate"), "limits")
    copies = F.col("whole") + (F.col("draw") < F.coalesce("limit", F.lit(0))).cast("long")
    return sized.join(settled, list(KEYS), "left").select(
        "row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document's row as often as it is taken."""
    times = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    return mixed.select("row", F.explode(times)).select("row.*")
