"""Which of several rows counts: first, last, first accepted, first successful."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.functions import doi_key, present
from paperloom.operators.joins import Load, key_load, spread_join
from paperloom.runtime import cut_lineage


def _ranked_first(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    # `row_number() = 1` is pruned to one row per key before the shuffle, so a frequent key
    # costs each map task one row.
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def first_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """First row per key. Rows without a key form one group."""
    return _ranked_first(df, keys, F.col(order).asc())


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last row per key: a later put replaces an earlier one."""
    return _ranked_first(df, keys, F.col(order).desc())


def first_location(locations: Column, test) -> Column:
    """First array element that satisfies `test`, else null."""
    return F.get(F.filter(locations, test), 0)


def release_claims(release: DataFrame) -> DataFrame:
    """(row_no, uid, doi): the two keys by which a release row is recognized."""
    return release.select(
        "row_no", present(F.col("cord_uid")).alias("uid"), doi_key(F.col("doi")).alias("doi")
    )


def _without(claims: DataFrame, uids: DataFrame, dois: DataFrame, load: Load) -> DataFrame:
    """Claims whose uid and DOI are both not among the given unique ones."""
    for keys, column in ((uids, "uid"), (dois, "doi")):
        claims = spread_join(claims, keys, [column], "left_anti", "row_no", load)
    return claims


def _unknown(claims: DataFrame, id_map: DataFrame) -> DataFrame:
    def known(kind: str, column: str) -> DataFrame:
        return id_map.where(F.col("kind") == kind).select(F.col("key").alias(column))

    load = key_load(claims, "uid", "doi")
    return _without(claims, known("id", "uid"), known("doi", "doi"), load)


def not_yet_seen(release: DataFrame, id_map: DataFrame) -> DataFrame:
    """Release rows whose uid and cleaned DOI are both unknown to the map."""
    fresh = _unknown(release_claims(release), id_map)
    return release.join(fresh.select("row_no"), "row_no", "left_semi")


def accept_first_come(release: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """Rows taken in file order: one is taken iff no earlier taken row, and no key of the
    map, shares its uid or DOI. Rejected rows claim nothing.

    Solved in rounds over (row_no, uid, doi), so the wide release rows are touched once at the
    end. A round decides the rows without an earlier open rival, all rows that a chain of single
    rivals leads to one, and the rows that share a key with a taken one. Chains are followed by
    doubling, so the jobs of a round are as many as the logarithm of its longest chain.
    """
    claims = release_claims(release)
    if id_map is not None:
        claims = _unknown(claims, id_map)
    claims = cut_lineage(claims)
    keyless = F.col("uid").isNull() & F.col("doi").isNull()
    accepted = [claims.where(keyless).select("row_no")]
    still = claims.where(~keyless)
    # Keys only get rarer, so the first measure serves all rounds.
    load = key_load(still, "uid", "doi")
    while not still.isEmpty():
        taken = cut_lineage(still.join(_decided_to_take(still), "row_no", "left_semi"))
        accepted.append(taken.select("row_no"))
        uids, dois = (taken.where(F.col(k).isNotNull()).select(k) for k in ("uid", "doi"))
        still = cut_lineage(_without(still, uids, dois, load))

    chosen = reduce(DataFrame.unionByName, accepted)
    return release.join(chosen, "row_no", "left_semi")


def _rivals(claims: DataFrame) -> DataFrame:
    """(row_no, to): claims with one earlier rival at most, `to`; the others are left out.

    A claim's rivals are earlier claims with its uid or DOI. Only the first two claims of a key can
    have one rival by it at most, and Spark cuts to them before the shuffle.
    """
    def first_two(key: str) -> DataFrame:
        in_order = W.partitionBy(key).orderBy("row_no")
        needs = (F.col("uid").isNotNull().cast("int") + F.col("doi").isNotNull().cast("int")).alias("needs")
        top = claims.where(F.col(key).isNotNull()).select("row_no", key, needs).withColumn(
            "nth", F.row_number().over(in_order)).where(F.col("nth") <= 2)
        return top.select("row_no", "needs", F.lag("row_no").over(in_order).alias("rival"))

    found = first_two("uid").unionByName(first_two("doi")).groupBy("row_no").agg(
        F.count("*").alias("n_keys"), F.max("needs").alias("needs"), F.min("rival").alias("to"), F.max("rival").alias("last"))
    one = F.col("to").isNull() | (F.col("to") == F.col("last"))
    return found.where((F.col("n_keys") == F.col("needs")) & one).select("row_no", "to")


def _decided_to_take(claims: DataFrame) -> DataFrame:
    """`row_no` of claims without rival, and of those an even number of single rivals away from one.

    Each step joins open claims with the claim they point to, which doubles the distance. A claim
    whose end has several rivals finds no partner and stays undecided. At most two claims point to
    one, and claims that have reached their end are set aside, so no end becomes a hot key.
    """
    start = cut_lineage(_rivals(claims).withColumn("rejected", F.col("to").isNotNull()))
    done, live = start.where("to is null"), start.where("to is not null")
    while not live.isEmpty():
        known = done.unionByName(live).select(
            F.col("row_no").alias("to"), F.col("to").alias("next"), F.col("rejected").alias("turn"))
        step = cut_lineage(live.join(known, "to").select(
            "row_no", F.col("next").alias("to"), (F.col("rejected") != F.col("turn")).alias("rejected")))
        done, live = done.unionByName(step.where("to is null")), step.where("to is not null")
    return done.where(~F.col("rejected")).select("row_no")


def select_members(members: DataFrame) -> DataFrame:
    """Per archive: the first PDF and the last NXML among regular files, by member number."""
    regular = F.col("is_file")
    pdf = regular & (F.col("name").endswith(".pdf") | F.col("name").endswith(".PDF"))
    nxml = regular & F.col("name").endswith(".nxml")
    return members.groupBy("archive_id").agg(
        F.min_by(F.when(pdf, F.col("name")), F.when(pdf, F.col("member_no"))).alias("pdf_name"),
        F.max_by(F.when(nxml, F.col("name")), F.when(nxml, F.col("member_no"))).alias("nxml_name"),
    ).withColumn("no_pdf", F.col("pdf_name").isNull())


def first_success(attempts: DataFrame) -> DataFrame:
    """Transport of the first attempt that worked; `failed` where none did."""
    ok = F.col("ok")
    return attempts.groupBy("id").agg(
        F.min_by(F.when(ok, F.col("transport")), F.when(ok, F.col("attempt_no"))).alias("transport"),
        F.count("*").alias("n_attempts"),
    ).select(
        "id", "transport",
        F.when(F.col("transport").isNull(), F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        "n_attempts",
    )
