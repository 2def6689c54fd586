"""Distances and sums of the fits: the quick way gives the numbers of the plain one."""

import time

import numpy as np
import pytest
from shelfline.functions import kmeans


def plain(x, centres):
    return np.stack([((x - c).astype(float) ** 2).sum(axis=1) for c in centres], axis=1)


@pytest.mark.parametrize("most", [1, 1 << 22, 1 << 24, 1 << 27, 1 << 40])
def test_same_distances_and_sums(most):
    r = np.random.default_rng(most)
    x, centres = r.integers(-most, most + 1, (500, 7)), r.integers(-most, most + 1, (8, 7))
    assert np.array_equal(kmeans._squared(x, centres), plain(x, centres))
    own = plain(x, centres).argmin(axis=1)
    total = np.zeros((8, 7), np.int64)
    np.add.at(total, own, x)
    assert np.array_equal(kmeans._added(x, own, 8), total) and kmeans._added(x, own, 8).dtype == np.int64


def test_a_step_is_mostly_a_matrix_product():
    r = np.random.default_rng(1)
    x, centres = r.integers(-(1 << 22), 1 << 22, (200_000, 7)), r.integers(-(1 << 22), 1 << 22, (8, 7))

    def seconds(step):
        began = time.perf_counter()
        step()
        return time.perf_counter() - began

    def before():
        own = plain(x, centres).argmin(axis=1)
        np.add.at(np.zeros((8, 7), np.int64), own, x)

    def now():
        kmeans._added(x, kmeans._squared(x, centres).argmin(axis=1), 8)

    assert min(seconds(now) for _ in range(3)) * 1.2 < min(seconds(before) for _ in range(3))
