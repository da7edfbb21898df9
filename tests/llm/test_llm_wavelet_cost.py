"""A wavelet matrix is built by moving values by places, which costs well less than by masks."""

import time

import numpy as np

from tidemark.llm.token_files import WaveletMatrix


def by_masks(ids):
    planes = []
    for bit in reversed(range(16)):
        ones = (ids & np.uint16(1 << bit)) != 0
        planes.append(np.packbits(ones))
        ids = np.concatenate([ids[~ones], ids[ones]])
    return planes


def least(run):
    def once():
        start = time.process_time()
        run()
        return time.process_time() - start

    return min(once() for _ in range(5))


def test_building_costs_less_than_by_masks():
    ids = np.random.default_rng(1).integers(0, 49_000, 1 << 19).astype(np.uint16)
    built = WaveletMatrix.build(ids)
    assert all(np.array_equal(a, b) for a, b in zip(built.planes, by_masks(ids), strict=True))
    assert np.array_equal(built.all(), ids)
    assert least(lambda: WaveletMatrix.build(ids)) < 0.75 * least(lambda: by_masks(ids))
