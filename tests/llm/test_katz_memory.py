"""Memory of the language model's map steps: arrays for a few million tokens are not copied several times over."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from reelhouse.llm import katz

PLAN = katz.Plan(32, np.array([katz.START]), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, 2), np.uint64))


def batches(extra):
    r = np.random.default_rng(1)
    for _ in range(10):
        words = r.integers(0, 200_000, (500, 400)).astype(str)
        yield pa.RecordBatch.from_pydict({"text": [" ".join(x) for x in words], **extra(500)})


def peak(step, extra):
    given = list(batches(extra))
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in step(SimpleNamespace(value=PLAN))(iter(given)))
        return n, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_map_steps_stay_small():
    n, words = peak(katz.count_words, lambda k: {"train": [True] * k})
    m, tokens = peak(katz.send_tokens, lambda k: {"rk": list(range(k)), "train": [True] * k})
    assert n and m == 2 * PLAN.n_buckets
    assert words < 36 and tokens < 100, (words, tokens)  # before: 47 and 121 MB
