import random

import pytest
from pyspark.sql import functions as F

from checks.compare import plan_text
from paperloom.operators import dedup

RELEASE = "row_no long, cord_uid string, doi string"


def in_order(rows, known=()):
    """The sequential rule, row by row."""
    seen, taken = set(known), []
    for row_no, uid, doi in sorted(rows):
        keys = {("id", uid)} if uid else set()
        keys |= {("doi", doi.lower())} if doi else set()
        if not keys & seen:
            seen |= keys
            taken.append(row_no)
    return taken


def accepted(spark, rows, known=None):
    id_map = None if known is None else spark.createDataFrame([(k, v, "z") for k, v in known], "kind string, key string, id string")
    done = dedup.accept_first_come(spark.createDataFrame(rows, RELEASE), id_map)
    return [r["row_no"] for r in done.select("row_no").orderBy("row_no").collect()]


@pytest.mark.parametrize("seed", range(4))
def test_accept_first_come_equals_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    pick = lambda kind, n: rng.choice([None, "", *[f"{kind}{i}" for i in range(n)]])
    rows = [(i, pick("u", 40), pick("D", 40)) for i in range(120)]
    known = {("id", "u1"), ("doi", "d2"), ("pmid", "u3")}
    assert accepted(spark, rows) == in_order(rows)
    assert accepted(spark, rows, known) == in_order(rows, {k for k in known if k[0] != "pmid"})


def test_accept_first_come_with_split_keys(spark, split_all):
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else f"u{rng.randrange(200)}", "10.1/HOT" if i % 3 == 1 else f"d{rng.randrange(200)}") for i in range(600)]
    assert accepted(spark, rows) == in_order(rows)


def test_chain_of_rejections(spark):
    rows = [(2 * i + j, f"u{i + (j == 0)}", f"d{i}") for i in range(6) for j in (0, 1)]
    assert accepted(spark, rows) == in_order(rows)


def chain(n):
    return [(i, f"u{(i + 1) // 2}", f"d{i // 2}") for i in range(n)]


def test_jobs_grow_with_the_logarithm_of_a_chain(spark):
    def jobs(n):
        group = f"chain of {n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert accepted(spark, chain(n)) == list(range(0, n, 2))
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    short, long = jobs(16), jobs(256)
    assert long - short <= 4 * 12


def test_chains_that_meet_in_rows_with_several_rivals(spark):
    rng = random.Random(3)
    rows = [(i, f"u{rng.randrange(i // 2 + 1)}", f"d{max(0, i // 2 - rng.randrange(3))}") for i in range(150)]
    assert accepted(spark, rows) == in_order(rows)


def test_rows_without_keys_are_taken_and_claim_nothing(spark):
    assert accepted(spark, [(1, "", ""), (2, None, None), (3, "", "10.1/a"), (4, "", "https://doi.org/10.1/A")]) == [1, 2, 3]


def test_empty_release(spark):
    assert accepted(spark, []) == []


def test_first_and_last(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 4, "p"), (None, 3, "q"), ("b", 5, "z")], "k string, n int, v string")
    assert sorted(r["v"] for r in dedup.first_by(rows, ["k"], "n").collect()) == ["q", "y", "z"]
    assert sorted(r["v"] for r in dedup.last_wins(rows, ["k"], "n").collect()) == ["p", "x", "z"]


def test_first_by_is_cut_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_text(dedup.first_by(rows, ["k"], "id"))
    shuffle = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[shuffle:] and "WindowGroupLimit" in plan[shuffle:]


def test_select_members(spark):
    rows = spark.createDataFrame([
        ("a", 3, "p2.pdf", True), ("a", 2, "p1.PDF", True), ("a", 1, "dir.pdf", False), ("a", 5, "n2.nxml", True), ("a", 4, "n1.nxml", True),
        ("b", 1, "x.nxml", True), ("c", 1, "x.txt", True),
    ], "archive_id string, member_no int, name string, is_file boolean")
    got = {r["archive_id"]: tuple(r)[1:] for r in dedup.select_members(rows).collect()}
    assert got == {"a": ("p1.PDF", "n2.nxml", False), "b": (None, "x.nxml", True), "c": (None, None, True)}


def test_first_success(spark):
    rows = spark.createDataFrame([("a", 1, "s", False), ("a", 3, "w", True), ("a", 2, "p", True), ("b", 1, "s", False)],
                                 "id string, attempt_no int, transport string, ok boolean")
    got = {r["id"]: tuple(r)[1:] for r in dedup.first_success(rows).collect()}
    assert got == {"a": ("p", "success", 3), "b": (None, "failed", 1)}
