"""Cells of sets and their exact resolution, shared by operators 1 and 6.

A cell is a group of sets that share a key (a prefix shingle or a MinHash band).
Tasks send cell keys as packed arrays by hash bucket; only cells with two or
more members become rows.  ``resolve`` then finds every link of Jaccard
similarity >= t inside the cells, up to connectivity.  Sets connected through
cells form regions.  A region of up to ``REGION_SETS`` sets (``REGION_SHINGLES``
shingles where sets meet by windows) is one task's work, each set sent once; a
larger one is split by its cells and resolved in
distributed rounds (``rounds``).  Sets that meet by all of their shingles
(``WHOLE_SETS``) have an index of their rarest ones in a task, and a larger region
is first cut into those of these shingles' cells.  The others work alike: the smallest sets are pivots,
in turn, and meet the sets that follow them in size order.  Sets whose distances
to the first pivot differ by more than 1 - t are no pair (triangle inequality of
the Jaccard distance), nor are sizes too far apart; what is connected already is
not compared.  In rounds the number of pivots doubles, so a cell ends after a
logarithmic number of rounds, and a group of near copies after the first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelhouse.llm.components import components
from reelhouse.llm.util import cut, trim
from reelhouse.llm.words import mix

FLUSH_UNITS = 16_384
LEAST_BUCKETS = 64
MANY = np.uint32(1 << 31)
FILTER_BITS = 1 << 26
REGION_SETS = 256
REGION_SHINGLES = 1 << 25  # of a region whose sets meet by their windows: 256 MB in its task
TASK_SHINGLES = 1 << 20  # regions that meet by whole sets are resolved together, this many shingles at once
QUERIES = 1 << 20  # shingles looked up at once
WHOLE_SETS = "whole sets"  # as ``meeting``: sets meet by all of their shingles
BROADCAST_ROWS = 1_000_000  # rows of a few numbers each


def node_ids(th: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Signed 64-bit identity of a text's unit."""
    return mix(th.astype(np.uint64) + (unit.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


#: (text hash, unit number, set identity, cell keys, owner of each key, skip the bucket) of a batch's units
UnitKeys = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]


def send_cells(keys_of: Callable[[pa.RecordBatch], UnitKeys], n_buckets: int, marks: bool):
    """Map side: packed cell keys by bucket.  Equal sets of a task send their keys once, marked if ``marks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[UnitKeys] = []
        n, hot = 0, np.zeros(0, np.int64)

        def flush():
            nonlocal held, n, hot
            base = np.cumsum([0] + [len(h[0]) for h in held[:-1]])
            th, unit, sid = (np.concatenate([h[i] for h in held]) for i in range(3))
            key = np.concatenate([h[3] for h in held])
            owner = np.concatenate([h[4] + b for h, b in zip(held, base)])
            known = np.concatenate([np.zeros(len(h[3]), bool) if h[5] is None else h[5] for h in held])
            held, n = [], 0
            _, first, inverse, count = np.unique(sid, return_index=True, return_inverse=True, return_counts=True)
            lead = np.zeros(len(sid), bool)
            lead[first] = True
            lead &= ~np.isin(sid, hot)
            many = (count > 1)[inverse]
            hot = np.unique(np.concatenate((hot, sid[many])))[:1_000_000]
            own = lead[owner]
            key, owner, known = key[own], owner[own], known[own]
            bucket = (mix(key) % np.uint64(n_buckets)).astype(np.int64)
            # a key known to be shared needs no meeting: it goes anywhere
            bucket[known] = (mix(key[known] + th[owner[known]].astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
            flags = np.where(many[owner] & marks | known, MANY, np.uint32(0)) | unit[owner].astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            key, owner, flags, bucket = key[order], owner[order], flags[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
            rows = [(b, key[i:j].tobytes(), th[owner[i:j]].tobytes(), flags[i:j].tobytes())
                    for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i]
            if rows:
                a, k, t, f = zip(*rows)
                for at in range(0, len(rows), 256):
                    s = slice(at, at + 256)
                    yield pa.RecordBatch.from_arrays([pa.array(a[s], pa.int32()), pa.array(k[s], pa.binary()), pa.array(t[s], pa.binary()),
                                                      pa.array(f[s], pa.binary())], names=["bucket", "keys", "ths", "units"])

        for b in batches:
            got = keys_of(b)
            if len(got[0]):
                held.append(got)
                n += len(got[0])
                if n >= FLUSH_UNITS:
                    yield from flush()
        if held:
            yield from flush()

    return run


def meet_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: (cell, node, th, tag) of keys with two members or a mark; the tag is the unit number."""
    keys, ths, units = [], [], []
    for b in batches:
        for k, t, u in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
            keys.append(np.frombuffer(k, np.uint64)), ths.append(np.frombuffer(t, np.int64)), units.append(np.frombuffer(u, np.uint32))
    if not keys:
        return
    key, th, unit = np.concatenate(keys), np.concatenate(ths), np.concatenate(units)
    del keys, ths, units
    order = np.lexsort((unit, th, key))
    key, th, unit = key[order], th[order], unit[order]
    same = key[1:] == key[:-1]
    again = same & (th[1:] == th[:-1]) & ((unit[1:] ^ unit[:-1]) & ~MANY == 0)  # one member sent by several tasks
    keep = np.concatenate(([True], ~again))
    marked = unit >= MANY
    marked[:-1] |= again
    key, th, unit, marked = key[keep], th[keep], unit[keep], marked[keep]
    same = key[1:] == key[:-1]
    shared = np.concatenate((same, [False])) | np.concatenate(([False], same)) | marked
    key, th, unit = key[shared].view(np.int64), th[shared], unit[shared] & ~MANY
    node = node_ids(th, unit)
    for at in range(0, len(key), 65_536):
        s = slice(at, at + 65_536)
        yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(node[s]), pa.array(th[s]), pa.array(unit[s].astype(np.int32))], names=["cell", "node", "th", "tag"])


def shared_cells(docs: DataFrame, keys_of: Callable[[pa.RecordBatch], UnitKeys], n_buckets: int, marks: bool = True) -> DataFrame:
    """(cell, node, th, tag) of the cells with two members, or (``marks``) one that stands for several units."""
    sent = docs.mapInArrow(send_cells(keys_of, n_buckets, marks), "bucket int, keys binary, ths binary, units binary")
    return sent.repartition(n_buckets, "bucket").mapInArrow(meet_cells, "cell long, node long, th long, tag int")


class KeyFilter:
    """Fixed-size Bloom filter over 64-bit keys; a full one lets more through, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(keys: np.ndarray, size: int) -> np.ndarray:
        h = mix(keys.astype(np.int64).view(np.uint64))
        low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)
        return np.stack([(low + np.uint64(i) * high) % np.uint64(size) for i in range(3)]).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        p = self.places(keys, 8 * len(self.bits))
        return ((self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1).all(axis=0)


def key_filter(keys: DataFrame) -> KeyFilter:
    """Filter over the column ``key``; tasks send 4 KB pieces, the driver holds at most FILTER_BITS bits."""
    n = keys.count()
    size = 1 << int(min(FILTER_BITS, max(1 << 15, 12 * n)) - 1).bit_length()
    piece = 4096

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for b in batches:
            bits[KeyFilter.places(b.column(0).to_numpy(), size).ravel()] = True
        packed = np.packbits(bits, bitorder="little").reshape(-1, piece)
        rows = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([packed[i].tobytes() for i in rows], pa.binary())],
                                         names=["piece", "bits"])

    def merge(key, pdf):
        total = np.zeros(piece, np.uint8)
        for x in pdf["bits"]:
            total |= np.frombuffer(x, np.uint8)
        pdf = pdf.iloc[:1].copy()
        pdf["bits"] = [total.tobytes()]
        return pdf

    sent = keys.select("key").mapInArrow(pieces, "piece int, bits binary")
    bits = np.zeros((size // 8 // piece, piece), np.uint8)
    for r in sent.groupBy("piece").applyInPandas(merge, "piece int, bits binary").collect():  # one job; at most FILTER_BITS bits
        bits[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return KeyFilter(bits.ravel())


def overlaps(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """(a, b, na, nb, i) of pairs: sizes and the number of common elements of ``arr`` in ``table`` (id, n, arr)."""
    heads = pairs.select("a").distinct()
    left = table.join(bounded(heads), F.col("id") == F.col("a")).select("a", F.col("n").alias("na"), F.col("arr").alias("xa"))
    right = table.join(bounded(pairs), F.col("id") == F.col("b")).select("a", "b", F.col("n").alias("nb"), F.col("arr").alias("xb"))
    return right.join(left, "a").select("a", "b", "na", "nb", F.size(F.array_intersect("xa", "xb")).cast("long").alias("i"))


def jaccard_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) with their distance d and whether they link; exact on whole sets."""
    union = F.col("na") + F.col("nb") - F.col("i")
    return overlaps(pairs, sets).select("a", "b", (1 - F.col("i") / union).alias("d"), (100 * F.col("i") >= percent * union).alias("link"))


def bounded(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its counted size allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def overlap(s: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of one sorted set with others."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(s, flat), len(s) - 1)
    begin = np.cumsum([0] + [len(x) for x in others[:-1]])
    return np.add.reduceat((s[at] == flat).astype(np.int64), begin)


def links_of_region(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect a region's sets (sorted by size), pivot by pivot."""
    size = np.array([len(s) for s in sets])
    group = np.arange(len(ids))
    first = np.full(len(ids), np.nan)  # distance to the first pivot
    eps, out = 1 - percent / 100 + 1e-9, []
    for p in range(len(ids) - 1):
        rest = np.arange(p + 1, len(ids))
        meet = rest[(group[rest] != group[p]) & (size[p] * 100 >= size[rest] * percent)]
        if p:
            meet = meet[~(np.abs(first[meet] - first[p]) > eps)]
        if not len(meet):
            continue
        both = overlap(sets[p], [sets[i] for i in meet])
        union = size[p] + size[meet] - both
        if not p:
            first[meet] = 1 - both / union
            first[0] = 0
        for i in meet[100 * both >= percent * union].tolist():
            if group[i] != group[p]:
                out.append((ids[p], ids[i]))
                group[group == group[i]] = group[p]
    return out


def links_by_windows(ids: list[int], sets: list[np.ndarray], percent: int, window_of: Callable[[np.ndarray], np.ndarray],
                     left_out: Callable[[np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """``links_of_region`` where a pair can only link if the sets' windows share enough elements.

    An inverted index over the windows gives each pivot the sets it meets and the
    number of elements their windows share; with what the windows leave out that
    bounds the pair's overlap, and only pairs within the bound compare whole sets.
    """
    size = np.array([len(s) for s in sets])
    windows = [window_of(s) for s in sets]
    own = np.cumsum([0] + [len(w) for w in windows])
    mine = np.concatenate(windows)
    del windows
    order = np.argsort(mine, kind="stable")
    flat, owner = mine[order], np.repeat(np.arange(len(sets), dtype=np.int32), np.diff(own))[order]
    del order
    begin = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    stop = np.append(begin[1:], len(flat))
    keys = flat[begin]
    group, groups, outside = np.arange(len(ids)), len(ids), left_out(size)
    first = np.full(len(ids), np.nan)  # distance to the first pivot, where it was measured
    eps, out = 1 - percent / 100 + 1e-9, []
    for p in range(len(ids) - 1):
        if groups == 1:
            break
        at = np.searchsorted(keys, mine[own[p]:own[p + 1]])
        shared = np.bincount(np.concatenate([owner[begin[i]:stop[i]] for i in at.tolist()]), minlength=len(ids))
        meet = p + 1 + np.flatnonzero(shared[p + 1:])
        meet = meet[(group[meet] != group[p]) & (size[p] * 100 >= size[meet] * percent)]
        least = -(-percent * (size[p] + size[meet]) // (100 + percent))
        meet = meet[shared[meet] + np.maximum(outside[p], outside[meet]) >= least]
        meet = meet[~(np.abs(first[meet] - first[p]) > eps)]
        if not len(meet):
            continue
        both = overlap(sets[p], [sets[i] for i in meet])
        union = size[p] + size[meet] - both
        if not p:
            first[meet] = 1 - both / union
            first[0] = 0
        for i in meet[100 * both >= percent * union].tolist():
            if group[i] != group[p]:
                out.append((ids[p], ids[i]))
                group[group == group[i]] = group[p]
                groups -= 1
    return out


def distinct_sets(region: np.ndarray, ids: np.ndarray, size: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same without a row's repeats after it: a set may come from several tasks."""
    keep = np.ones(len(ids), bool)
    keep[1:] = (region[1:] != region[:-1]) | (ids[1:] != ids[:-1])
    return (region, ids, size, flat) if keep.all() else (region[keep], ids[keep], size[keep], flat[np.repeat(keep, size)])


def unite(group: np.ndarray, members: dict[int, list[int]], x: np.ndarray, y: np.ndarray) -> None:
    """Joins the groups of linked sets, the smaller to the larger."""
    for i, j in zip(x.tolist(), y.tolist()):
        a, b = int(group[i]), int(group[j])
        if a == b:
            continue
        of_a, of_b = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(of_a) < len(of_b):
            a, of_a, of_b = b, of_b, of_a
        group[of_b] = a
        of_a += of_b
        members[a] = of_a


def groups_by_prefixes(region: np.ndarray, size: np.ndarray, flat: np.ndarray, percent: int) -> np.ndarray:
    """Number of the group of linked sets of each set, inside its region; whole sets in a row, by region and size.

    Two sets of similarity t share one of the |x| - ceil(t |x|) + 1 shingles of each
    that are the rarest in their region.  The sets with such a shingle are its list,
    in size order; in step d every member meets the d-th after it, so that memory
    stays in proportion to the input.  A member is done where sizes are too far apart
    or everything after it in the list is connected to it.
    """
    n = len(size)
    own = np.repeat(np.arange(n, dtype=np.int32), size)
    flat = flat ^ mix(region.view(np.uint64))[own]  # shingles of two regions differ
    order = np.argsort(flat)
    flat = flat[order]
    new = np.append(True, flat[1:] != flat[:-1])
    del flat
    count = np.diff(np.append(np.flatnonzero(new), len(new)))
    lone, kinds = int((count == 1).sum()), len(count)
    rank = np.empty(kinds, np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(kinds, dtype=np.int32)
    key = np.empty(len(own), np.int64)  # set and rank of every shingle, sorted
    key[order] = rank[np.cumsum(new) - 1]
    del order, new, count, rank
    key += own.astype(np.int64) * kinds
    key.sort()
    begin = np.cumsum(size) - size
    place = np.arange(len(key)) - begin[own]
    head = np.flatnonzero(place < (size - -(-percent * size // 100) + 1)[own])
    kind = key[head] - own[head].astype(np.int64) * kinds
    head, kind = head[kind >= lone], kind[kind >= lone]
    head = head[np.argsort(kind, kind="stable")]
    kind.sort()
    owner, after = own[head], size[own[head]] - place[head]  # from a list's shingle on
    del own, place, head

    def least_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Shingles that a pair that links has in common, at least."""
        return -(-percent * (size[x] + size[y]) // (100 + percent))

    def shared(x: np.ndarray, y: np.ndarray, some: np.ndarray) -> np.ndarray:
        """How many of the first ``some`` (the rarest) shingles of x are in y, for each pair."""
        ends = np.cumsum(some)
        ask = np.arange(ends[-1]) + np.repeat(begin[x] - ends + some, some)
        ask = key[ask] + np.repeat((y - x) * np.int64(kinds), some)
        found = key[np.minimum(np.searchsorted(key, ask), len(key) - 1)] == ask
        return np.add.reduceat(found.astype(np.int64), ends - some)

    def linked(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that link: a few shingles tell most others from them, whole sets the rest."""
        lost = size[x] - least_of(x, y)  # shingles of x that may be missing from y
        some = np.minimum(size[x], lost + 3)
        close = shared(x, y, some) >= some - lost
        x, y = x[close], y[close]
        if not len(x):
            return x, y
        both = shared(x, y, size[x])
        link = 100 * both >= percent * (size[x] + size[y] - both)
        return x[link], y[link]

    group, members = np.arange(n), {}
    at, d = np.arange(len(kind)), 1
    while len(at):
        at = at[:np.searchsorted(at, len(kind) - d)]
        x, y = owner[at].astype(np.int64), owner[at + d].astype(np.int64)
        on = (kind[at + d] == kind[at]) & (100 * size[x] >= percent * size[y])
        at, x, y = at[on], x[on], y[on]
        # a list of their first common shingle, if they link
        meet = (group[x] != group[y]) & (np.minimum(after[at], after[at + d]) >= least_of(x, y))
        pairs = np.unique(x[meet] * n + y[meet])
        x, y = pairs // n, pairs % n
        cuts = np.flatnonzero(np.diff(np.cumsum(size[x]) // QUERIES, prepend=-1, append=-1))
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            unite(group, members, *linked(x[i:j], y[i:j]))
        if d & d - 1 == 0:  # members that everything after them in their list is connected to
            of = group[owner]
            turn = np.append((of[1:] != of[:-1]) & (kind[1:] == kind[:-1]), False)
            turns = np.append(0, np.cumsum(turn))
            last = np.searchsorted(kind, kind[at], "right") - 1
            at = at[turns[last] > turns[at]]
        d += 1
    return group


def resolve_whole_sets(percent: int):
    """Links of the regions of a partition, sorted by region, size and id, whose sets meet by all of their shingles.

    A group of linked sets comes as a star: every set with the smallest id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def close(rows: int | None) -> pa.RecordBatch:
            """Resolves what is held up to a row (None: all), and holds the rest."""
            nonlocal held, n
            region, ids, size, flat = (np.concatenate(x) for x in zip(*held))
            end = int(size[:rows].sum())
            rest = region[rows:], ids[rows:], size[rows:], flat[end:].copy()
            held, n = ([], 0) if rows is None else ([rest], len(rest[3]))
            region, ids, size, flat = distinct_sets(region[:rows], ids[:rows], size[:rows], flat[:end])
            group = groups_by_prefixes(region, size, flat, percent)
            least = ids.copy()
            np.minimum.at(least, group, ids)
            least = least[group]
            return pa.RecordBatch.from_arrays([pa.array(least[least != ids]), pa.array(ids[least != ids])], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            size = b.column(2).value_lengths().to_numpy().astype(np.int64)
            held.append(distinct_sets(b.column(0).to_numpy(), b.column(1).to_numpy(), size, b.column(2).flatten().to_numpy().view(np.uint64)))
            n += len(held[-1][3])
            if n >= TASK_SHINGLES and held[0][0][0] != held[-1][0][-1]:
                last = held[-1][0]
                first = np.searchsorted(last, last[-1])
                if first or held[-2][0][-1] != last[-1]:
                    yield close(sum(len(h[0]) for h in held[:-1]) + int(first))
        if held:
            yield close(None)
        trim()

    return run


def resolve_regions(percent: int, meeting=None):
    """Links of the regions of a partition, sorted by region, size and id; ``meeting``: a broadcast (window_of, left_out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, sets, out = None, [], [], []

        def close():
            if len(ids) > 1 and meeting is not None:
                out.extend(links_by_windows(ids, sets, percent, *meeting()))
            elif len(ids) > 1:
                out.extend(links_of_region(ids, sets, percent))
            ids.clear(), sets.clear()

        for b in batches:
            regions, own, arrays = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
            for i, (region, set_id) in enumerate(zip(regions, own)):
                if region != at:
                    close()
                    at = region
                if not ids or ids[-1] != set_id:  # a set may come from several tasks
                    ids.append(set_id)
                    sets.append(np.sort(arrays[i].values.to_numpy().view(np.uint64)))
        close()
        trim()
        a, z = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["a", "b"])

    return run


def split_regions(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids of the small and of the large regions with their region (comp, id)."""
    hubs = cells.groupBy("cell").agg(F.min("id").alias("hub"))
    star = cells.join(hubs, "cell").filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    region = cut(components(star))
    if "n" in cells.columns:
        sizes = region.join(cells.groupBy("id").agg(F.min("n").alias("n")), "id").groupBy("comp").agg(F.sum("n").alias("m"))
        fits = F.col("m") <= REGION_SHINGLES
    else:
        sizes, fits = region.groupBy("comp").agg(F.count("*").alias("m")), F.col("m") <= REGION_SETS
    sizes = cut(sizes.withColumn("small", fits).select("comp", "small"))
    return (region.join(sizes.filter("small"), "comp").select("comp", "id"),
            region.join(sizes.filter("not small"), "comp").select("comp", "id"))


def links_in_tasks(small: DataFrame, sets: DataFrame, percent: int, meeting) -> DataFrame:
    """Links of the small regions, one task's work each."""
    dealt = sets.join(bounded(small), "id").repartition("comp").sortWithinPartitions("comp", "n", "id").select("comp", "id", "arr")
    task = resolve_whole_sets(percent) if meeting == WHOLE_SETS else resolve_regions(percent, meeting)
    return cut(dealt.mapInArrow(task, "a long, b long"))


def prefix_cells(sets: DataFrame, percent: int) -> DataFrame:
    """(cell, id, n) of sets (comp, id, n, arr) that share one of the shingles that are the rarest in their region, as in
    ``groups_by_prefixes``: sets that can link meet there, and few others."""
    held = sets.select("id", "n", F.explode("arr").alias("s"), "comp").select("id", "n", F.xxhash64("comp", "s").alias("cell"))
    common = held.groupBy("cell").agg(F.count("*").alias("m")).filter("m > 1")
    own = Window.partitionBy("id")  # a set's own shingles
    held = held.join(common, "cell").withColumns({"r": F.row_number().over(own.orderBy("m", "cell")), "common": F.count("*").over(own)})
    # a set's other shingles, n - common, are the rarest
    return held.filter(F.col("n") - F.col("common") + F.col("r") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("cell", "id", "n")


def resolve(cells: DataFrame, sets: DataFrame, percent: int = 80, outside: Callable[[Column], Column] | None = None,
            meeting=None) -> DataFrame:
    """All links (a, b) inside the cells, up to connectivity.

    ``cells``: (cell, id) or (cell, id, n); ``sets``: id, n, arr, rows of an id may
    repeat.  ``outside``: if a set's cells are all its elements of a window of one
    global order, the number of its elements outside the window, by its size;
    common cells then bound a pair's overlap before whole sets are compared.
    ``meeting`` gives tasks the same rule, as functions of a set's array and of
    sizes, or is WHOLE_SETS; then ``cells`` must hold n.
    """
    small, large = split_regions(cells)
    links = links_in_tasks(small, sets, percent, meeting)
    large = cut(large)
    if large.isEmpty():
        return links
    own = cut(sets.join(bounded(large.select("id")), "id").groupBy("id").agg(F.first("n").alias("n"), F.first("arr").alias("arr")))
    if meeting == WHOLE_SETS:
        cells = cut(prefix_cells(own.join(large, "id"), percent))
        small, large = split_regions(cells)
        links = links.union(links_in_tasks(small, own, percent, meeting))
        large = cut(large)
        if large.isEmpty():
            return links
    left = cells.join(bounded(large.select("id")), "id").select("cell", "id").join(bounded(own.select("id", "n")), "id")
    return links.union(rounds(left, own, percent, outside, meeting))


def rounds(cells: DataFrame, sets: DataFrame, percent: int, outside: Callable[[Column], Column] | None, meeting=None) -> DataFrame:
    """Links inside cells of large regions: (cell, id, n), and one row of ``sets`` for each id.

    With ``meeting``, what a round leaves is cut into regions again, and those
    that became small are resolved in tasks.
    """
    eps = 1 - percent / 100 + 1e-9
    spark = cells.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    windows = None
    if outside is not None:
        windows = cut(cells.groupBy("id", "n").agg(F.collect_set("cell").alias("arr")))  # a set's own window
    cells = cells.withColumns({"d0": F.lit(None).cast("double"), "comp": F.col("id")})
    k, first, seen = 1, True, None
    while True:
        # a cell's members in (n, id) order; the first k are this round's pivots
        if k == 1:
            piv = (cells.groupBy("cell").agg(F.min(F.struct("n", "id", "d0", "comp")).alias("p"), F.count("*").alias("m"))
                   .filter("m > 1").select("cell", "p"))
        else:
            order = Window.partitionBy("cell").orderBy("n", "id")
            piv = (cells.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
                   .select("cell", F.struct("n", "id", "d0", "comp").alias("p")))
        if piv.isEmpty():
            break
        met = (cells.join(piv, "cell")
               .filter("(n > p.n or n = p.n and id > p.id) and comp <> p.comp")
               .filter(F.col("p.n") * 100 >= F.col("n") * percent)
               .filter(F.col("d0").isNull() | F.col("p.d0").isNull() | (F.abs(F.col("d0") - F.col("p.d0")) <= eps)))
        pairs = met.select(F.col("p.id").alias("a"), F.col("id").alias("b")).distinct()
        if seen is not None:  # sets that share several cells meet once
            pairs = pairs.join(bounded(seen), ["a", "b"], "left_anti")
        pairs = cut(pairs)
        seen = pairs if seen is None else seen.union(pairs)
        if windows is not None:
            least = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent) - 1e-9)
            most = F.col("i") + F.greatest(outside(F.col("na")), outside(F.col("nb")))
            pairs = cut(overlaps(pairs, windows).filter(most >= least).select("a", "b"))
        found = cut(jaccard_pairs(pairs, sets, percent))
        links = links.union(found.filter("link").select("a", "b"))
        last = piv.groupBy("cell").agg(F.max(F.struct("p.n", "p.id")).alias("last"), F.min("p").alias("p"))
        rest = cells.join(last, "cell").filter("n > last.n or n = last.n and id > last.id")
        if first:  # every member's distance to its cell's first pivot, where it was measured
            rest = rest.withColumn("a", F.col("p.id")).withColumn("b", F.col("id"))
            rest = rest.join(found.select("a", "b", "d"), ["a", "b"], "left").withColumn("d0", F.col("d"))
        rest = rest.select("cell", "id", "n", "d0")
        comp = components(links)
        rest = (rest.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
                .select("cell", "id", "n", "d0", "comp"))
        many = rest.groupBy("cell").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("cell")
        cells = cut(rest.join(many, "cell"))
        if meeting is not None:
            small, large = split_regions(cells)
            links = cut(links.union(links_in_tasks(small, sets, percent, meeting)))
            cells = cut(cells.join(bounded(cut(large.select("id"))), "id"))
        if cells.isEmpty():
            break
        first, k = False, 2 if first else 2 * k
    return links
