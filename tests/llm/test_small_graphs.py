"""Small graphs stay in few tasks, however many partitions a shuffle has; tiles equal brute force."""

import glob

import numpy as np
import pytest

from paperloom.llm import minhash
from paperloom.llm.components import LINKS_PER_TASK, components
from paperloom.llm.shared import SCRATCH
from tests.llm import brute

pytestmark = pytest.mark.usefixtures("shared")


def test_tables_of_a_small_graph_have_few_files(spark):
    links = [*[(i, i + 1) for i in range(60)], *[(500, i) for i in range(501, 560)], (7, 7)]
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old, before = [spark.conf.get(n) for n in names], len(SCRATCH)
    try:
        for name, value in zip(names, ("64", "false")):
            spark.conf.set(name, value)
        found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    finally:
        for name, value in zip(names, old):
            spark.conf.set(name, value)
    roots = brute.groups(600, links)
    assert found == {n: roots[n] for a, b in links if a != b for n in (a, b)}
    assert len(links) < LINKS_PER_TASK and len(SCRATCH) > before
    assert all(len(glob.glob(f"{path}/part-*")) == 1 for path in SCRATCH[before:])


def test_a_tile_joins_what_is_similar():
    rng = np.random.default_rng(5)
    rows = []
    for n in range(60):
        hashes = np.unique(np.concatenate([np.arange(n % 6 * 100, n % 6 * 100 + 40), rng.integers(10_000, 99_999, n % 9)])).astype(np.uint64)
        row = {"band": 11, "part": 0, "block": 0, "node": b"n%02d" % n, "root": b"n%02d" % (n % 6 if n > 40 else n),
               "minor": n % 4 != 0, "hashes": hashes.tobytes(), "bands": [1000 * n + 5, 11, 7]}
        rows += [row | {"role": role} for role in (0, 1) if role or row["minor"]]
    batch = minhash.pa.RecordBatch.from_pylist(rows)
    links = [pair for out in minhash.tile_links(85)([batch]) for pair in zip(*out.to_pydict().values())]
    sets = {r["node"]: np.frombuffer(r["hashes"], np.uint64) for r in rows}
    asking = [r["node"] for r in rows if r["role"] == 0]
    number = {node: at for at, node in enumerate(sets)}
    same = [(number[r["node"]], number[r["root"]]) for r in rows]
    wanted = [(number[a], number[b]) for a in asking for b in sets if a != b and minhash.similar(sets[a], sets[b], 85)]
    assert all(minhash.similar(sets[a], sets[b], 85) for a, b in links)
    groups = [brute.groups(60, same + more) for more in (wanted, [(number[a], number[b]) for a, b in links])]
    assert [groups[0][i] for i in range(60)] == [groups[1][i] for i in range(60)] and links
