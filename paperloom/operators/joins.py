"""Equi-joins that stay even when one key holds a large share of the rows."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys the frequency sketch tracks per shuffle task. A heavy key has at least a task's share of the rows,
# so there are no more heavy keys than tasks, and the sketch tells all of them apart.
TRACKED_PER_TASK = 16
# Tasks that merge the sketches of the map tasks before the last one does.
MERGE_LANES = 256
# A key with fewer rows than this is never worth splitting.
HEAVY_ROWS = 1_000_000
# Shards per shuffle task: as shards are hashed to tasks, several are needed to even out.
SHARDS_PER_TASK = 4


@dataclass(frozen=True)
class Load:
    """Rows of a frame; per key column the values that outweigh a task, and if blanks do."""

    rows: int
    heavy: dict[str, list]
    blank: dict[str, bool]


def shuffle_tasks(df: DataFrame) -> int:
    """Number of tasks a shuffle is spread over."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_load(df: DataFrame, *keys: str) -> Load:
    """Measure `df` in one pass over its key columns.

    Frequency sketches are merged in two steps, so that no task gets one from every map task,
    and give one bounded row. It is read here and not inside the join: both sides of a join
    must split the same keys, and a sketch may vary from run to run. The measure only decides
    how rows are spread; results do not depend on it.
    """
    tasks = shuffle_tasks(df)
    tracked = max(4096, TRACKED_PER_TASK * tasks)
    lane = F.pmod(F.spark_partition_id(), F.lit(MERGE_LANES))
    parts, whole = [F.count("*").alias("rows")], [F.sum("rows").alias("rows")]
    for at, key in enumerate(keys):
        parts += [
            F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias(f"sketch{at}"),
            F.count(key).alias(f"filled{at}"),
        ]
        merged = f"approx_top_k_combine(sketch{at}, {tracked})"
        whole += [
            F.expr(f"approx_top_k_estimate({merged}, {tasks})").alias(f"top{at}"),
            F.sum(f"filled{at}").alias(f"filled{at}"),
        ]
    merges = df.select(*keys, lane.alias("lane")).groupBy("lane").agg(*parts)
    found = merges.groupBy(F.lit("all")).agg(*whole).first()
    if found is None:
        return Load(0, {k: [] for k in keys}, {k: False for k in keys})
    share = max(HEAVY_ROWS, -(-found["rows"] // tasks))
    return Load(
        found["rows"],
        {k: [t["item"] for t in found[f"top{at}"] if t["item"] is not None and t["count"] >= share]
         for at, k in enumerate(keys)},
        {k: found["rows"] - found[f"filled{at}"] >= share for at, k in enumerate(keys)},
    )


def heavy_frame(spark: SparkSession, key: str, heavy: list) -> DataFrame:
    """The heavy keys, no more than shuffle tasks, as a frame to be broadcast."""
    return F.broadcast(spark.createDataFrame([(k,) for k in heavy], f"`{key}` string"))


def spread_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, row: str, load: Load | None = None
) -> DataFrame:
    """Join a `right` side that is unique on `on`, whatever the key counts on the left.

    Rows of a heavy key, and rows without a key where those are many, are dealt out over
    shards by the hash of their `row` column; the matching right rows, no more than there are
    tasks, are repeated per shard. Which keys are heavy comes to both sides as a small frame of
    known bound. The last column of `on`, a string, is the one watched; `load` is its measure
    where it was taken before.
    """
    key = on[-1]
    load = key_load(left, key) if load is None else load
    heavy, blank = load.heavy[key], load.blank[key] and how != "inner"
    if not heavy and not blank:
        return left.join(right, on, how)
    n = SHARDS_PER_TASK * shuffle_tasks(left)
    marks = heavy_frame(left.sparkSession, key, heavy).withColumn("_heavy", F.lit(True))
    first, is_heavy = F.lit(0), F.col("_heavy").isNotNull()
    dealt = F.pmod(F.xxhash64(row), F.lit(n)).cast("int")
    shard = F.when(is_heavy | F.col(key).isNull(), dealt).otherwise(first)
    copies = F.when(is_heavy, F.sequence(first, F.lit(n - 1))).otherwise(F.array(first))
    marked = left.join(marks, key, "left").withColumn("_shard", shard).select(*left.columns, "_shard")
    repeated = right.join(marks, key, "left").select(*right.columns, F.explode(copies).alias("_shard"))
    return marked.join(repeated, [*on, "_shard"], how).drop("_shard")


def probe_keys(rows: DataFrame, row: str, rungs: list[tuple[str, str, Column]]) -> DataFrame:
    """One row (row, at, rung, kind, key) per rung and row, where there is a key.

    `rungs` are (name, kind, key) in order of preference.
    """
    probes = F.array(*[
        F.struct(F.lit(at).alias("at"), F.lit(name).alias("rung"),
                 F.lit(kind).alias("kind"), key.alias("key"))
        for at, (name, kind, key) in enumerate(rungs)
    ])
    return rows.select(F.col(row).alias("row"), F.inline(probes)).where(F.col("key").isNotNull())


def first_hit(probes: DataFrame, index: DataFrame, load: Load | None = None) -> DataFrame:
    """Walk a ladder of keys: (row, rung, value) of the first rung that finds something.

    `index` has one `value` per (kind, key). All rungs go through one join, narrow and inner,
    and the first hit per row is a map-side combined minimum. Rows that find nothing are not
    in the result.
    """
    hits = spread_join(probes, index.select("kind", "key", "value"), ["kind", "key"], "inner", "row", load)
    best = hits.groupBy("row").agg(F.min(F.struct("at", "rung", "value")).alias("best"))
    return best.select("row", "best.rung", "best.value")
