"""Exact top-k inner-product search by norm-bucketed retrieval (operator 2).

Vectors are grouped by length: quantiles of the norm bound the buckets, and a
hash of the id spreads equal norms over neighbouring buckets.  Queries form
blocks of ``QUERY_BLOCK``; every (query block, bucket) meets in one task, the
queries first, then the bucket's vectors in blocks of ``BLOCK``, longest first.
Seeds (the longest vectors, a bounded number) give each query a lower bound of
its k-th best score.  In a block, the query's local cosine threshold is that
bound divided by the query's length and the block's largest length.  Above 1 the
block is skipped; from ``COORD_FROM`` on, the query's largest coordinates bound
the candidates' coordinates; below it candidates are cut by length.  Survivors
are verified by exact integer products.

Edge cases: a vector that is null or holds null or non-finite components takes
no part.  Vectors meet only vectors of their own dimension.  Rows with a
query's vec_id are the query itself.  Ties go to the smaller vec_id.  Fewer than
k candidates give all of them.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 4096
QUERY_BLOCK = 16384
BUCKET_ROWS = 8192
MAX_BOUNDS = 1024
SEEDS = 512
COORD_FROM = 0.6
FOCUS = 3
SLACK = 1e-9
EXACT = float(2 ** 53)


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, v (integer components as double), norm of the vectors that take part."""
    emb = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    v = F.transform(emb, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double"))
    return (vectors.filter(emb.isNotNull() & ~F.exists(emb, bad) & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))))


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond double's range by integers."""
    if not q.size or not v.size or np.abs(q).max() * np.abs(v).max() * q.shape[1] < EXACT:
        return q @ v.T
    big = q.astype(object) @ v.astype(object).T
    return big if big.size else big.astype(np.float64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by (score descending, id ascending)."""
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= least
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class QueryBlock:
    """Queries of one dimension with their running best candidates."""

    def __init__(self, ids, q, seeds, k: int):
        self.ids, self.q, self.k = np.asarray(ids, np.int64), q, k
        self.norm = np.sqrt((q * q).sum(axis=1))
        self.unit = q / np.maximum(self.norm, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1)[:, :FOCUS]
        self.found = [(np.zeros(0, np.int64), np.zeros(0)) for _ in self.ids]
        self.floor = np.full(len(self.ids), -np.inf)
        seed_ids, s = seeds.get(q.shape[1], (np.zeros(0, np.int64), np.zeros((0, q.shape[1]))))
        if len(seed_ids):
            scores = products(q, s).astype(np.float64)
            scores[self.ids[:, None] == seed_ids[None, :]] = -np.inf
            if len(seed_ids) >= k:
                self.floor = np.partition(scores, len(seed_ids) - k, axis=1)[:, len(seed_ids) - k]

    def meet(self, ids: np.ndarray, v: np.ndarray) -> None:
        """Compare with a block of vectors sorted by length, longest first."""
        norm = np.sqrt((v * v).sum(axis=1))
        longest = norm[0] if len(norm) else 0.0
        unit = v / np.maximum(norm, 1e-300)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            local = self.floor / (self.norm * longest)
        dense = np.flatnonzero(~(local >= 0.05))  # nothing to prune with: one matrix product
        for at in range(0, len(dense), 256):
            part = dense[at:at + 256]
            scores = products(self.q[part], v)
            for i, row in zip(part, scores):
                self.keep(i, ids, row)
        for i in np.flatnonzero(local >= 0.05):
            if local[i] > 1 + SLACK:
                continue
            # by length: only |v| >= floor / |q| can reach the floor
            n = int(np.searchsorted(-norm, -(self.floor[i] / self.norm[i]) * (1 - SLACK), side="right"))
            rows = np.arange(n)
            if local[i] >= COORD_FROM:  # by coordinates: bounds on the largest ones
                t = min(1.0, local[i])
                for f in self.focus[i]:
                    x = self.unit[i, f]
                    wide = np.sqrt(max(0.0, (1 - t * t) * (1 - x * x))) + 1e-7
                    y = unit[rows, f]
                    low = x * t - wide if x >= -t else -1 - wide
                    high = x * t + wide if x <= t else 1 + wide
                    rows = rows[(y >= low) & (y <= high)]
            if len(rows):
                self.keep(i, ids[rows], products(self.q[i:i + 1], v[rows])[0])

    def keep(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ok = (ids != self.ids[i]) & (scores >= self.floor[i])
        if not ok.any():
            return
        a, s = self.found[i]
        a, s = best(np.concatenate((a, ids[ok])), np.concatenate((s, scores[ok])), self.k)
        self.found[i] = (a, s)
        if len(a) == self.k:
            self.floor[i] = max(self.floor[i], float(s[-1]))


def meet_buckets(seeds: dict, k: int):
    """Task of one or more (query block, bucket) cells, sorted by cell, then queries, then length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"cell": None, "blocks": None, "q": {}, "v": {}}

        def block():
            if state["blocks"] is None:
                state["blocks"] = {d: QueryBlock(i, np.array(x, np.float64).reshape(len(x), d), seeds, k)
                                   for d, (i, x) in state["q"].items()}
            for d, (i, x) in state["v"].items():
                if d in state["blocks"]:
                    state["blocks"][d].meet(np.array(i, np.int64), np.array(x, np.float64).reshape(len(x), d))
            state["v"] = {}

        def close():
            block()
            out = [(int(b.ids[i]), int(a), int(s)) for b in state["blocks"].values()
                   for i, (ids, scores) in enumerate(b.found) for a, s in zip(ids, scores)]
            state.update(blocks=None, q={}, v={})
            if out:
                cols = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

        for b in batches:
            cells = zip(*(b.column(i).to_pylist() for i in range(5)))
            for qb, vb, is_vec, vec_id, v in cells:
                if (qb, vb) != state["cell"]:
                    if state["cell"] is not None:
                        yield from close()
                    state["cell"] = (qb, vb)
                ids, rows = state["v" if is_vec else "q"].setdefault(len(v), ([], []))
                ids.append(vec_id), rows.append(v)
                if is_vec and len(ids) >= BLOCK:
                    block()
        if state["cell"] is not None:
            yield from close()

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, bucket_rows: int = BUCKET_ROWS,
          query_block: int = QUERY_BLOCK, seeds: int = SEEDS) -> DataFrame:
    """The k best partners of every query row: query_id, rank, vec_id, score."""
    all_rows = quantised(vectors)
    n, n_q = all_rows.agg(F.count("*"), F.sum(F.when(is_query, 1).otherwise(0))).first()
    n_buckets = max(1, min(MAX_BOUNDS, -(-n // bucket_rows)))
    n_blocks = max(1, -(-(n_q or 0) // query_block))
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    key = F.col("norm") * (1 + 1e-9 * spread) + 1e-9 * spread
    bounds = [] if n_buckets == 1 else sorted(set(
        all_rows.select(F.percentile_approx(key, [i / n_buckets for i in range(1, n_buckets)], 100 * n_buckets)).first()[0] or []))
    # beyond MAX_BOUNDS buckets, hash parts keep each cell's rows bounded
    parts = max(1, -(-n // (n_buckets * bucket_rows)))
    bucket = F.lit(0)
    if bounds:
        bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < key))
    bucket = bucket * F.lit(parts) + F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int")
    top = all_rows.orderBy(F.desc("norm"), "vec_id").limit(seeds).collect()
    by_dim: dict[int, tuple] = {}
    for r in {x["vec_id"]: x for x in top}.values():
        ids, rows = by_dim.setdefault(len(r["v"]), ([], []))
        ids.append(r["vec_id"]), rows.append(r["v"])
    sent = {d: (np.array(i, np.int64), np.array(x, np.float64).reshape(len(x), d)) for d, (i, x) in by_dim.items()}
    n_cells = n_buckets * parts
    vec = all_rows.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("qb"), bucket.alias("vb"),
                          F.lit(True).alias("is_vec"), "vec_id", "v", "norm")
    q = all_rows.filter(is_query).select(
        F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(n_blocks)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(n_cells - 1))).alias("vb"), F.lit(False).alias("is_vec"), "vec_id", "v", "norm")
    cells = (q.union(vec).repartition(max(1, n_cells * n_blocks), "qb", "vb")
             .sortWithinPartitions("qb", "vb", "is_vec", F.desc("norm"), "vec_id"))
    found = cells.select("qb", "vb", "is_vec", "vec_id", "v").mapInArrow(
        meet_buckets(sent, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
