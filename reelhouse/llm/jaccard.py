"""N-gram Jaccard join (operator 6): a metric-space join over Voronoi-like regions.

Sets of word shingles live in the Jaccard metric, d = 1 - J.  Level 1: every
shingle is a pivot set {g}.  Only sets that hold g are nearer to it than 1, so a
set's regions are the pivots of its own shingles, in one global order.  Two sets
of distance 1 - t share one of the first |x| - ceil(t |x|) + 1 shingles of each
in that order; a set is replicated to these regions and no others, which is the
window that keeps the join exact.  With ``l`` shingles more in every window, a
pair shares ``l`` regions, so a set that meets others in fewer regions than its
smallest possible partner's ``l`` is out (``margin``).  (Document pivots cannot make this first cut:
unrelated texts are at distance 1 from every document.)  Level 2 and deeper: a
region's smallest sets become its pivots, distances to them are measured, pairs
are cut by the triangle inequality and by size, and regions recurse until all
of their members are compared or connected (``setjoin.resolve``).

The order puts shingles that are frequent in a bounded sample of documents last.
It only steers where sets meet; any order gives the same result.

Edge cases: null and blank texts have the empty set and link with nothing; fewer
words than a shingle give one shingle of the whole sequence; equal sets link;
repeated rows are members of the same set; rows of one id may have different texts,
each belongs to its own text's component; null ids are ignored as component names
unless a component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.llm.components import components
from reelhouse.llm.setjoin import LEAST_BUCKETS, key_filter, resolve, shared_cells
from reelhouse.llm.util import cut
from reelhouse.llm.words import mix, set_hash, shingle_sets, word_hashes

ORDER_SAMPLE = 4000  # documents whose shingles are counted for the order
COMMON_SHARE = 0.002  # of the sample's documents; at most 1 / share times the mean set size are common
PERCENT = 80
ROWS_PER_BUCKET = 12_000


def text_rows(docs: DataFrame) -> DataFrame:
    """Text and its hash; null counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(text.alias("text"), F.xxhash64(text).alias("th"))


def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text hash, n_shingles and identity of every text's set (null without shingles)."""
    for b in batches:
        sets = shingle_sets(*word_hashes(b.column(1)))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())], names=["doc_id", "th", "n", "sid"])


def shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = shingle_sets(*word_hashes(b.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["s"])


def common_shingles(rows: DataFrame, n_docs: int) -> np.ndarray:
    """Sorted shingles of many documents of a bounded sample, rarest order last."""
    every = max(1, n_docs // ORDER_SAMPLE)
    sample = rows.filter(F.pmod(F.xxhash64("th"), F.lit(every)) == 0) if every > 1 else rows
    least = max(8, int(COMMON_SHARE * min(n_docs, ORDER_SAMPLE)))
    texts = sample.dropDuplicates(["th"]).select("text")
    got = texts.mapInArrow(shingle_rows, "s long").groupBy("s").count().filter(F.col("count") >= least).select("s")
    return np.sort(np.array([r[0] for r in got.toLocalIterator()], np.int64).view(np.uint64))


def margin(n: int) -> int:
    """Shingles that a set of size n adds to its window, and that its pairs of this size share at least."""
    return 1 + n // 20


def window(s: np.ndarray, common: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of a set in the global order, and which of them are common."""
    n = len(s)
    take = min(n, n - -(-percent * n // 100) + margin(n))
    late = np.zeros(n, bool)
    if len(common):
        late = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
    rank = mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(1)
    rank[late] |= np.uint64(1 << 63)
    pick = np.argpartition(rank, take - 1)[:take] if take < n else np.arange(n)
    return s[pick], late[pick]


def region_keys(sent, percent: int):
    """Regions of every set; its tag is its size."""

    def keys_of(b: pa.RecordBatch):
        common = sent.value
        sets = [s for s in shingle_sets(*word_hashes(b.column(0))) if len(s)]
        got = [window(s, common, percent) for s in sets]
        sid = np.array([set_hash(s) for s in sets], np.int64)
        size = np.array([len(s) for s in sets], np.int64)
        none = np.zeros(0, np.uint64)
        return (sid, size, sid, np.concatenate([k for k, _ in got] or [none]),
                np.repeat(np.arange(len(sets)), [len(k) for k, _ in got]), np.concatenate([c for _, c in got] or [none]).astype(bool))

    return keys_of


def whole_sets(wanted):
    """(id, n, arr) of the texts whose key the filter lets through, each key once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, done = wanted.value, set()
        for b in batches:
            key = b.column(1).to_numpy()
            pick = [i for i in np.flatnonzero(f.has(key)).tolist() if key[i] not in done]
            done.update(key[pick].tolist())
            if not pick:
                continue
            sets = [s for s in shingle_sets(*word_hashes(b.column(0).take(pa.array(pick)))) if len(s)]
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array([set_hash(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                                  pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "n", "arr"])

    return run


def meeting(cells: DataFrame, percent: int) -> DataFrame:
    """(cell, id) of sets that meet others in as many cells as the margin of their smallest possible partner."""
    cells = cells.select("cell", F.col("th").alias("id"), F.col("tag").alias("n"))
    least = 1 + F.floor(F.ceil(F.col("n") * percent / 100) / 20)
    enough = cells.groupBy("id", "n").agg(F.count("*").alias("k")).filter(F.col("k") >= least).select("id")
    return cut(cells.join(enough, "id").select("cell", "id", "n"))


def outside(n: Column, percent: int) -> Column:
    """Elements of a set of size n that its window leaves out."""
    return F.greatest(F.ceil(n * percent / 100) - 1 - F.floor(n / 20), F.lit(0))


def meeting_rule(common, percent: int):
    """What tasks need to meet sets by their windows: a set's window, and elements outside of it by size."""

    def left_out(n: np.ndarray) -> np.ndarray:
        return np.maximum(-(-percent * n // 100) - 1 - n // 20, 0)

    return lambda: (lambda s: window(s, common.value, percent)[0], left_out)


def text_key() -> Column:
    """Identity of a row's id and text: rows of one id may differ in their texts."""
    return F.xxhash64("doc_id", "th")


def grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, th (text hash), n (shingles) and comp (identity of the component, null without shingles) of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))
    members = cut(ids.mapInArrow(sized, "doc_id long, th long, n long, sid long"))
    rows = text_rows(docs)
    n_docs = members.count()
    common = spark.sparkContext.broadcast(common_shingles(rows, n_docs))
    buckets = max(LEAST_BUCKETS, n_docs // ROWS_PER_BUCKET)
    cells = meeting(shared_cells(rows, region_keys(common, percent), buckets, marks=False), percent)
    # one row speaks for all copies of a set
    known = members.filter("sid is not null").groupBy(F.col("sid").alias("id")).agg(F.min(text_key()).alias("key"))
    met = cut(known.join(cells.select("id").distinct(), "id").select("key"))
    wanted = spark.sparkContext.broadcast(key_filter(met))
    sets = ids.select("text", text_key().alias("key")).mapInArrow(whole_sets(wanted), "id long, n long, arr array<long>")
    links = resolve(cells, sets, percent, lambda n: outside(n, percent), meeting_rule(common, percent))
    comp = components(links).withColumnRenamed("id", "sid")
    return members.join(comp, "sid", "left").select("doc_id", "th", "n", F.coalesce("comp", "sid").alias("comp"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; links are 100 * |x & y| >= percent * |x | y|."""
    rows = cut(grouped(docs, percent))
    least = rows.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return (rows.join(least, "comp", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (null ids last), then of the smallest text hash.

    Rows are told apart by id and text; rows equal in both stay or go together.
    """
    rows = cut(grouped(docs, percent).filter("comp is not null"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th")
    first = rows.groupBy("comp").agg(F.min(place).alias("first"))
    gone = rows.join(first, "comp").filter(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))))
    gone = gone.select(F.col("doc_id").alias("__gone_id"), F.col("th").alias("__gone_text")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(gone["__gone_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["__gone_text"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)
