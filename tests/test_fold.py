"""The vectorized fold equals the row-at-a-time reference fold (no Spark needed)."""

import random

import numpy as np
import pytest

from brute import SessionFold
from cadence.streaming.fold import fold_arrays

NAMES = ["a", "b"]


def events(seed, n):
    rnd = random.Random(seed)
    ts = sorted(rnd.choice([rnd.randrange(200_000), rnd.randrange(0, 200_000, 20_000)]) for _ in range(n))
    return [(t, i, int(rnd.random() < 0.7), rnd.random() < 0.3, rnd.random() < 0.15) for i, t in enumerate(ts)]


@pytest.mark.parametrize("seed", range(40))
@pytest.mark.parametrize("touching", [True, False])
def test_vectorized_fold_matches_reference(seed, touching):
    rnd = random.Random(1000 + seed)
    evs = events(seed, rnd.randrange(1, 80))
    ref, vec = SessionFold(20_000, 2, touching), None
    s_ref = s_vec = None
    out_ref, out_vec = [], []
    i = 0
    while i < len(evs):  # feed in random chunks, carrying the open session
        j = i + rnd.randrange(1, 12)
        chunk = evs[i:j]
        s_ref, o = ref.fold(s_ref, chunk, NAMES)
        out_ref += o
        arr = np.array([e[:3] for e in chunk], dtype=np.int64)
        s_vec, o = fold_arrays(
            s_vec, arr[:, 0], arr[:, 2], [np.array([e[3] for e in chunk]), np.array([e[4] for e in chunk])],
            NAMES, 20_000, touching,
        )
        out_vec += o.tuples()
        assert s_vec == s_ref
        i = j
    assert sorted(out_vec) == sorted(out_ref)
