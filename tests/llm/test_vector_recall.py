"""Links between near vectors whose differences are not spread evenly over all dimensions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import vectors

pytestmark = pytest.mark.usefixtures("shared")


def falling(rng, n, dim):
    """A few directions hold most of the spread, as in real embeddings."""
    return rng.normal(size=(n, dim)) / np.arange(1, dim + 1)


def low_rank(rng, n, dim):
    return rng.normal(size=(n, 4)) @ rng.normal(size=(4, dim))


def links_per_row(x, cosine=0.93):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    return ((unit @ unit.T >= cosine).sum(1) - 1).tolist()


def found_per_row(spark, rows):
    df = spark.createDataFrame([(i, x, label) for i, (x, label) in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    found = vectors.near_vectors(df.repartition(4)).select("vec_id", F.col("n_links")).collect()
    return [n for _, n in sorted(map(tuple, found))]


@pytest.mark.parametrize("kind,dim", [(falling, 384), (low_rank, 256)])
@pytest.mark.parametrize("shelf", [256, 1024])
def test_every_link_is_found(spark, monkeypatch, kind, dim, shelf):
    monkeypatch.setattr(vectors, "SHELF", shelf)
    x = kind(np.random.default_rng(5), 1500, dim)
    want = links_per_row(x)
    assert sum(want) > 1000
    assert found_per_row(spark, [(r.tolist(), 0) for r in x]) == want


def test_long_vectors_hide_no_links_of_short_ones(spark):
    rng = np.random.default_rng(6)
    short, long = falling(rng, 900, 16), rng.normal(size=(20, 512))
    want = links_per_row(short) + links_per_row(long)
    assert found_per_row(spark, [(r.tolist(), 0) for r in (*short, *long)]) == want


def test_huge_and_tiny_vectors_link_like_others(spark):
    """Squares of these components are beyond the range of doubles; their directions are not."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(12, 24))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * 0.05, base * 3])
    scale = 10.0 ** rng.choice([200, -200, 307, -300, 0], len(x))
    want = links_per_row(x)
    assert sum(want) > 30
    assert found_per_row(spark, [((r * s / 10).tolist(), 0) for r, s in zip(x, scale)]) == want
