"""Linked sets meet although empty segments give no signatures."""

import numpy as np
import pytest

from millrace.llm import jaccard


@pytest.mark.parametrize("part", [80, 90])
def test_filled_segments_meet(part):
    t, rng = jaccard.Threshold(part, 100), np.random.default_rng(7)
    tops = jaccard.bands(1500)
    for size in (20, 33, 60, 111, 200, 400, 1000):
        for _ in range(30):
            d = t.differ(size)  # the other has d elements more or less, or as many with half of each
            extra = int(rng.integers(0, d + 1))
            fewer = min(t.distance(2 * size) // 2, d - extra)
            pool = np.unique(rng.integers(0, 2**63, size + extra, dtype=np.uint64))
            a = np.sort(rng.permutation(pool)[:size])
            b = np.sort(np.concatenate([a[fewer:], np.setdiff1d(pool, a)]))
            both = len(np.intersect1d(a, b))
            if not t.links(both, len(a), len(b)):
                continue
            band = int(np.searchsorted(tops, max(len(a), len(b))))
            h, below = t.distance(2 * tops[band]), tops[band - 1]
            m = jaccard.plain_segments(h, (below + 1) * t.part // t.whole, tops[band], t)
            if not m:
                continue
            sigs = []
            for x in (a, b):
                need = np.array([min(h, t.differ(len(x))) + 1])
                sigs.append(set(jaccard.signatures(x, np.array([0, len(x)]), band, m, 0, need)[0]))
            assert sigs[0] & sigs[1]
    assert all(jaccard.plain_segments(t.distance(2 * x), (y + 1) * part // 100, x, t) for y, x in zip(tops[8:], tops[9:]))
