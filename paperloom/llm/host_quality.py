"""Host-level quality rules: rule failures per host, shrunk by a beta prior, decide for its documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import WORD, as_rows, stored, words

SYMBOLS = "[#*$%&|<>]"
# Base rules: at least so many words, and at most this percentage of them in repeated windows.
MIN_WORDS, MAX_REPEATED = 50, 50
# A host whose odds of failing are more than MAX_ODDS times those of all hosts, with a probability of
# SURE, is rejected as a whole; Z is that probability's quantile of the normal distribution.
MAX_ODDS, SURE, Z = 4.0, 0.95, 1.645
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeats(windows: Column) -> Column:
    """(hash, place) of each window, sorted, for texts where any window occurs twice; else empty."""
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.array_sort(pairs)).otherwise(none)


def repeated_places(pairs: Column) -> Column:
    """Places, sorted, of windows that occur twice or more: equal ones stand side by side in `pairs`."""
    def occurs_again(x: Column, i: Column) -> Column:
        before, behind = F.get(pairs, i - 1)["h"], F.get(pairs, i + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == behind, F.lit(False))

    return F.array_sort(F.transform(F.filter(pairs, occurs_again), lambda x: x["i"]))


def covered(places: Column) -> Column:
    """Words under 3-word windows at `places`: each adds the distance to the one before, three at most."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(places, start, lambda acc, i: F.struct(
        i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")))["n"]


def measure(docs: DataFrame, text: Column, host: Column) -> DataFrame:
    """`docs` with `host`, the measures of each text and `base_failed`; `docs` must have none of these.

    Null or empty texts have no words and fail. Windows are told apart by a 64-bit hash of their
    words, within one text.
    """
    # A step whose columns the next one reads more than once is not merged into it by Spark, so
    # nothing is computed anew for each element of an array.
    split = docs.select("*", host.alias("host"), F.coalesce(text, F.lit("")).alias("_text")).select(
        "*", words(F.col("_text")).alias("_words"), F.split("_text", "\n", -1).alias("_lines"))
    window = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(3)]),
    )
    none = F.array().cast("array<bigint>")
    windows = split.select(
        "*", F.when(F.size("_words") >= 3, window).otherwise(none).alias("_windows"),
        F.filter("_lines", lambda line: line.rlike(WORD)).alias("_full"))
    counted = windows.select("*", repeats(F.col("_windows")).alias("_pairs")).select(
        "*", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        covered(repeated_places(F.col("_pairs"))).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    steps = ("_text", "_words", "_lines", "_windows", "_full", "_pairs")
    return counted.select(*[c for c in counted.columns if c not in steps], failed.alias("base_failed"))


def beta_prior(hosts: DataFrame) -> tuple[float, float | None]:
    """(mean, weight) of a beta prior of the hosts' failure rates; the weight counts like pages.

    Moments of the beta-binomial distribution, with hosts weighted by their pages: what rates vary
    beyond the noise that so many pages have anyhow is spread between hosts. No weight: there is
    none, and all hosts fail at the mean rate.
    """
    n, f = F.col("n_pages"), F.col("n_failed")
    k, pages, failed, squares, rates = hosts.agg(
        F.count("*"), F.sum(n), F.sum(f), F.sum(n.cast("double") * n), F.sum(f.cast("double") * f / n)).first()
    mean = failed / pages if pages else 0.0
    noise = mean * (1 - mean)
    room = noise * (pages - squares / pages - (k - 1)) if pages else 0.0
    if room <= 0:
        return mean, None
    share = (rates - pages * mean * mean - noise * (k - 1)) / room
    return mean, 1 / min(share, 0.999) - 1 if share > 0 else None


def host_verdicts(measured: DataFrame, max_odds: float = MAX_ODDS) -> DataFrame:
    """(host, n_pages, n_failed, host_rate, host_kept), one row per host; null is a host too.

    A host's rate is (failed + weight * mean) / (pages + weight), the mean of its beta posterior. A host
    is rejected if its odds of failing are above `max_odds` times those of the prior mean, with a
    probability of SURE: the posterior mean less Z deviations is held against that limit. So the
    limit follows the corpus, a host of few pages is not judged by chance, and where hosts do not
    differ by more than chance none is rejected.
    """
    hosts = stored(measured.groupBy("host").agg(
        F.count("*").alias("n_pages"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")), "hosts")
    # Two numbers go into the plan as constants.
    mean, weight = beta_prior(hosts)
    if weight is None:
        return hosts.withColumn("host_rate", F.lit(mean)).withColumn("host_kept", F.lit(True))
    limit = max_odds * mean / (1 - mean + max_odds * mean)
    total = F.col("n_pages") + F.lit(weight)
    rate = (F.col("n_failed") + F.lit(mean * weight)) / total
    surely = F.col("host_rate") - Z * F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (total + 1))
    return hosts.withColumn("host_rate", rate).withColumn("host_kept", surely <= limit)


def judge(measured: DataFrame, max_odds: float = MAX_ODDS) -> DataFrame:
    """Measured documents with their host's counts, rate and `kept`.

    Hosts are counted with map-side sums, so a host with a third of the pages is a few rows. Verdicts
    are written, one row per host, so Spark knows their size before it plans the join: it broadcasts
    them if they are few, and else splits skewed parts.
    """
    # Marked keys, as null is a host too.
    keys = {"_no_host": F.col("host").isNull(), "_host": F.coalesce("host", F.lit(""))}
    verdicts = stored(host_verdicts(measured, max_odds).withColumns(keys).drop("host"), "verdicts")
    joined = measured.withColumns(keys).join(verdicts, list(keys), "left").drop(*keys)
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Rows of `docs` that pass, unchanged, with all their columns.

    Repeated rows are judged alike; an empty table stays empty. No column name can clash, as the
    row travels as one struct.
    """
    # The rows are read twice, once for the hosts' counts and once for the verdict, and of the measures
    # only those that the base rules need are worked out: less than to write whole texts in between.
    measured = measure(as_rows(docs), F.col("row")[text], F.col("row")[host])
    # A filter would be pushed into the measures, whose steps Spark would then work out over and over.
    return judge(measured).select(F.explode(F.when(F.col("kept"), F.array("row"))).alias("row")).select("row.*")
