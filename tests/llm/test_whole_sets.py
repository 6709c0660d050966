"""Regions whose sets meet by all of their shingles: the links of a brute force, and work in proportion to the sets."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from reelhouse.llm import setjoin


def regions_of(r):
    """(region, id, set) of near copies, equal sizes and unlike sets of common shingles, by region, size and id."""
    rows = []
    for region in (-7, 3, 4, 1 << 40):
        common = [r.randrange(-(1 << 62), 1 << 62) for _ in range(30)]
        for _ in range(r.randint(1, 12)):
            base = [r.randrange(-(1 << 62), 1 << 62) for _ in range(r.randint(3, 25))] + r.sample(common, r.randint(0, 6))
            for _ in range(r.randint(1, 9)):
                other = [x if r.random() < 0.93 else r.choice(common) for x in base]
                rows.append((region, r.randrange(-(1 << 62), 1 << 62), frozenset(other)))
        for _ in range(40):
            rows.append((region, r.randrange(-(1 << 62), 1 << 62), frozenset(r.sample(common, r.randint(3, 8)))))
    for i in range(0, len(rows), 7):  # other regions hold the same shingles
        rows.append((99, rows[i][1] ^ 1, rows[i][2]))
    return sorted(rows, key=lambda x: (x[0], len(x[2]), x[1]))


def grouped(rows, links):
    """Ids of a component, for each id."""
    group = {i: {i} for _, i, _ in rows}
    for a, b in links:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for i in group[b]:
                group[i] = group[a]
    return {i: min(g) for i, g in group.items()}


def brute(rows, percent):
    return [(a[1], b[1]) for k, a in enumerate(rows) for b in rows[k + 1:]
            if a[0] == b[0] and 100 * len(a[2] & b[2]) >= percent * len(a[2] | b[2])]


def batches(rows, size):
    for at in range(0, len(rows), size):
        own = rows[at:at + size]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in own], pa.int64()), pa.array([x[1] for x in own], pa.int64()),
                                          pa.array([list(x[2]) for x in own], pa.list_(pa.int64()))], names=["comp", "id", "arr"])


def links(rows, size, percent=80):
    got = [x for b in setjoin.resolve_whole_sets(percent)(batches(rows, size)) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert len(got) == len(set(grouped(rows, []))) - len(set(grouped(rows, got).values()))  # no link is one too many
    return got


@pytest.mark.parametrize("seed,at_once,size,percent", [(1, 1 << 20, 1000, 80), (2, 40, 7, 80), (3, 300, 50, 50), (4, 1, 1, 95)])
def test_components_are_those_of_a_brute_force(monkeypatch, seed, at_once, size, percent):
    monkeypatch.setattr(setjoin, "TASK_SHINGLES", at_once)
    monkeypatch.setattr(setjoin, "QUERIES", max(at_once, 10))
    rows = regions_of(random.Random(seed))
    want = grouped(rows, brute(rows, percent))
    twice = [x for row in rows for x in [row] * (1 + row[1] % 2)]  # a set may come from several tasks
    assert grouped(rows, links(twice, size, percent)) == want
    assert len(set(want.values())) < len(rows)


def test_no_batches_and_empty_ones():
    assert links([], 5) == []
    none = pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64()))], names=["comp", "id", "arr"])
    assert list(setjoin.resolve_whole_sets(80)(iter([none]))) == []


def test_large_regions_are_cut_by_their_rarest_shingles(docs, monkeypatch):
    rows = [x for x in regions_of(random.Random(8)) if x[0] in (-7, 3)]
    spark = docs([]).sparkSession
    sets = spark.createDataFrame([(i, len(x), list(x)) for _, i, x in rows], "id long, n long, arr array<long>").repartition(3)
    cells = spark.createDataFrame([(c, i, len(x)) for c, i, x in rows], "cell long, id long, n long")
    cut_up = []
    inner = setjoin.prefix_cells
    monkeypatch.setattr(setjoin, "prefix_cells", lambda *a: cut_up.append(1) or inner(*a))
    monkeypatch.setattr(setjoin, "REGION_SHINGLES", 40)  # some of the cut ones are large still
    got = setjoin.resolve(cells, sets.union(sets), 80, meeting=setjoin.WHOLE_SETS).collect()
    assert cut_up and grouped(rows, [(x.a, x.b) for x in got]) == grouped(rows, brute(rows, 80))


def test_work_of_a_large_region_follows_its_sets():
    r = np.random.default_rng(5)
    n, common = 40_000, r.integers(-(1 << 62), 1 << 62, 60)
    rows = []
    for i in range(n):  # sets with own and common shingles; every tenth has a near copy
        own = [*r.integers(-(1 << 62), 1 << 62, 8).tolist(), *r.choice(common, 4, replace=False).tolist()]
        rows.append((1, 2 * i, own))
        if i % 10 == 0:
            rows.append((1, 2 * i + 1, own[1:]))
    rows.sort(key=lambda x: (x[0], len(x[2]), x[1]))
    given = list(batches(rows, 1000))
    began = time.process_time()
    got = [x for b in setjoin.resolve_whole_sets(80)(iter(given)) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert set(got) == {(2 * i, 2 * i + 1) for i in range(0, n, 10)}
    assert time.process_time() - began < 4  # every set against a counter of all sets: over 10 s


def test_a_large_group_of_near_copies_is_compared_once():
    r = random.Random(6)
    base = [r.randrange(-(1 << 62), 1 << 62) for _ in range(30)]
    rows = [(1, i, [x for k, x in enumerate(base) if k != i % 30] + [i]) for i in range(20_000)]
    given = list(batches(rows, 1000))
    began = time.process_time()
    assert sum(b.num_rows for b in setjoin.resolve_whole_sets(80)(iter(given))) == len(rows) - 1
    assert time.process_time() - began < 4
