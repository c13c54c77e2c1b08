"""A vector is sent to the lists that it probes, not to all of its label."""

import numpy as np
import pytest

from paperloom.llm import vectors
from tests.llm.test_vector_recall import found_per_row, links_per_row

pytestmark = pytest.mark.usefixtures("shared")


def topics(n, dim=128):
    """Groups of a hundred around directions of their own, in one label."""
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(n // 100, dim))
    return centers[np.arange(n) % len(centers)] + rng.normal(size=(n, dim)) * rng.choice([0.1, 0.2, 0.4], (n, 1))


@pytest.fixture
def sent(monkeypatch):
    """The numbers of rows that calls have sent to tiles."""
    counts, plain = [], vectors.tiles_of

    def counted(*args):
        tiles = plain(*args)
        counts.append(tiles.count())
        return tiles

    monkeypatch.setattr(vectors, "SHELF", 64)
    monkeypatch.setattr(vectors, "tiles_of", counted)
    return counts


def test_rows_sent_grow_in_proportion(spark, sent):
    for n in (1000, 5000):
        x = topics(n)
        want = links_per_row(x)
        assert sum(want) > n
        assert found_per_row(spark, [(r.tolist(), 0) for r in x]) == want
    assert sent[1] < 6.5 * sent[0]


def test_one_list_with_a_third_of_all(spark, sent):
    """Very near vectors fill one list, which is asked in blocks and shelves."""
    rng = np.random.default_rng(10)
    x = np.concatenate([topics(600, 32), np.ones(32) + rng.normal(size=(400, 32)) * 0.2])
    assert found_per_row(spark, [(r.tolist(), 0) for r in x]) == links_per_row(x)
