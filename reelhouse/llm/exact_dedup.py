"""Exact dedup with Patricia-trie owners (operator 4).

Texts are routed by (byte length, 64-bit content hash).  Every map task first
merges its own copies in one compressed radix trie, so a group of copies of any
size sends one row per task; a trie that outgrows its byte budget spills its
heaviest subtree to the shuffle.  After the shuffle each (length, hash)
partition is inserted into a trie of its own: hash collisions end in different
terminal nodes because the full byte strings are compared.  A terminal node
stores the smallest and the largest id and the number of rows.

Edge cases: a null text counts as empty.  Null ids never own a group that has
another id; a group of null ids only has a null owner and all of its rows stay.
Rows repeated with the owner's id all stay (they are the same row).  Copies of
long texts are compared whole.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelhouse.llm.util import ascii_lower

SUBTREE_BUDGET = 48 * 1024 * 1024


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.value, self.children = label, value, {}


def common_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by halving."""
    lo, hi = 0, min(len(a), len(b) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def merged(x, y):
    """Two terminal values (smallest id, largest id, rows) as one; ids may be null."""
    lo = [v for v in (x[0], y[0]) if v is not None]
    hi = [v for v in (x[1], y[1]) if v is not None]
    return (min(lo, default=None), max(hi, default=None), x[2] + y[2])


class PatriciaTrie:
    """Compressed radix trie over byte strings; terminals hold (smallest, largest, rows)."""

    def __init__(self, budget: int = SUBTREE_BUDGET):
        self.root, self.budget = Node(b""), budget
        self.total, self.sizes = 0, {}  # stored bytes: all, and by subtree of the root

    def insert(self, key: bytes, value: tuple) -> None:
        node, i, n = self.root, 0, len(key)
        while i < n:
            child = node.children.get(key[i])
            if child is None:
                node.children[key[i]] = Node(key[i:], value)
                self._grow(key, n - i + 200)
                return
            if key.startswith(child.label, i):
                node, i = child, i + len(child.label)
                continue
            k = common_prefix(child.label, key, i)
            upper = Node(child.label[:k])
            node.children[key[i]] = upper
            child.label = child.label[k:]
            upper.children[child.label[0]] = child
            node, i = upper, i + k
            self._grow(key, 200)
        node.value = value if node.value is None else merged(node.value, value)

    def _grow(self, key: bytes, n: int) -> None:
        self.total += n
        self.sizes[key[0]] = self.sizes.get(key[0], 0) + n

    def spill(self) -> Iterator[tuple]:
        """Drain the heaviest subtrees until the budget holds."""
        while self.total > self.budget and self.sizes:
            first = max(self.sizes, key=self.sizes.get)
            self.total -= self.sizes.pop(first)
            yield from walk(self.root.children.pop(first), b"")

    def drain(self) -> Iterator[tuple]:
        yield from walk(self.root, b"")
        self.root, self.total, self.sizes = Node(b""), 0, {}


def walk(node: Node, prefix: bytes) -> Iterator[tuple]:
    """(byte string, value) of every terminal node, without recursion."""
    stack = [(node, prefix)]
    while stack:
        x, p = stack.pop()
        key = p + x.label
        if x.value is not None:
            yield key, x.value
        stack.extend((c, key) for c in x.children.values())


PARTIAL = "norm binary, lo long, hi long, n long"
OWNERS = "text_sha256 string, lo long, hi long, group_size long"


def combine(budget: int):
    """Map side: one row per distinct text of a task (or of a spilled subtree)."""

    def rows(found) -> Iterator[pa.RecordBatch]:
        keys, values, size = [], [], 0
        for k, v in found:
            keys.append(k), values.append(v)
            size += len(k)
            if size > 4 << 20:
                yield batch(keys, values)
                keys, values, size = [], [], 0
        if keys:
            yield batch(keys, values)

    def batch(keys, values):
        lo, hi, n = zip(*values)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(n, pa.int64())],
            names=["norm", "lo", "hi", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(budget)
        for b in batches:
            for key, d in zip(b.column(0), b.column(1).to_pylist()):
                trie.insert(key.as_py(), (d, d, 1))
            if trie.total > budget:
                yield from rows(trie.spill())
        yield from rows(trie.drain())

    return run


def owners_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: rows sorted by (length, hash); one trie per such partition."""
    out, trie, at = [], PatriciaTrie(), None

    def close():
        out.extend((hashlib.sha256(k).hexdigest(), *v) for k, v in trie.drain())

    def flush():
        a, lo, hi, n = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.string()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(n, pa.int64())],
            names=["text_sha256", "lo", "hi", "group_size"])

    for b in batches:
        cols = [b.column(b.schema.get_field_index(x)).to_pylist() for x in ("len", "hash", "lo", "hi", "n")]
        for key, ln, h, lo, hi, n in zip(b.column(b.schema.get_field_index("norm")), *cols):
            if at != (ln, h):
                close()
                at = (ln, h)
            trie.insert(key.as_py(), (lo, hi, n))
        if out:
            yield flush()
    close()
    if out:
        yield flush()


def text_owners(docs: DataFrame, budget: int = SUBTREE_BUDGET) -> DataFrame:
    """One row per distinct normalised text: sha256, smallest and largest id, rows."""
    norm = ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary").alias("norm")
    partial = docs.select(norm, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(combine(budget), PARTIAL)
    routed = (partial.withColumns({"len": F.octet_length("norm"), "hash": F.xxhash64("norm")})
              .repartition("len", "hash").sortWithinPartitions("len", "hash"))
    return routed.mapInArrow(owners_of_sorted, OWNERS)


def exact_dedup(docs: DataFrame, keep: str = "smallest", budget: int = SUBTREE_BUDGET) -> DataFrame:
    """Every row's doc_id with its owner: keep_id, group_size, kept, text_sha256.

    ``keep``: the ``smallest`` or the ``largest`` id of equal texts stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    owner = text_owners(docs, budget).select(
        "text_sha256", F.col("lo" if keep == "smallest" else "hi").alias("keep_id"), "group_size")
    rows = docs.select("doc_id", F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256)
                       .alias("text_sha256"))
    return rows.join(owner, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """``docs`` without the rows whose text another row owns (all columns kept)."""
    owner = text_owners(docs).select(F.col("text_sha256").alias("__sha"),
                                     F.col("lo" if keep == "smallest" else "hi").alias("__keep"))
    sha = F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256)
    return (docs.withColumn("__sha", sha).join(owner, "__sha")
            .filter(F.col("doc_id").eqNullSafe(F.col("__keep"))).select(*docs.columns))
