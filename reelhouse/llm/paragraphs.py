"""Substring dedup by paragraph MinHash banding (operator 1).

Paragraphs are content-defined: a word position is a boundary where the hash of
three words is the minimum of the ``RADIUS`` positions on either side.  A
passage that repeats inside other text, whatever the lines around it, therefore
has the same inner paragraphs everywhere.  Each paragraph's five-word shingles
give MinHash bands (``tune_bands`` picks them for the recall asked for at the
similarity asked for); paragraphs that collide in a band meet, exact Jaccard
similarity of their shingle sets is verified, and connected components say
which copies go: the smallest (doc_id, paragraph) of a component stays.

A repeated paragraph whose neighbour in the text does not repeat is extended into
that neighbour, word by word, as far as some other document's copy goes on alike;
the row's span is the extended one.  ``cut_start`` and ``cut_end`` bound what goes:
the paragraph, unless it is the one that stays, and of the extension the words that
a document with a smaller id holds as well, so that one copy of every word stays.

Edge cases: null texts have no paragraphs; paragraphs of fewer than ``RADIUS``
+ 1 words (short texts and the ends of texts) are only reached by extension; runs of neighbouring
repeated paragraphs that have fewer than ``run_words`` words with their extensions (stock lines) are not
reported; nor are copies inside one document only; a null doc_id sorts before all others; rows
repeated under one id count as one document; an empty table gives an empty
result.  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelhouse.llm.components import components
from reelhouse.llm.jaccard import text_rows
from reelhouse.llm.setjoin import LEAST_BUCKETS, WHOLE_SETS, key_filter, node_ids, resolve, shared_cells
from reelhouse.llm.util import cut, drop_tables
from reelhouse.llm.words import SHINGLE, mix, shingles, word_hashes, word_spans

RADIUS = 6
PERCENT = 80
RECALL = 0.995
MARGIN = RADIUS + 2  # a boundary depends on this many words after it, at most
RUN_WORDS = 20  # neighbouring repeated paragraphs count from this many words on, extensions included
TEXTS_PER_BUCKET = 4000
SEEDS = [np.uint64(pow(0xD1342543DE82EF95, k, 1 << 64)) for k in range(1, 129)]


def tune_bands(similarity: float, recall: float, least_rows: int = 2) -> tuple[int, int]:
    """(bands, rows) with the fewest bands whose collision chance at ``similarity`` reaches ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** least_rows)), least_rows


def paragraphs(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number within the text, first word (in the batch) and length of every paragraph that takes part."""
    n = len(words)
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    padded = np.full(n + (len(counts) + 1) * RADIUS, np.iinfo(np.uint64).max)  # RADIUS places around each text
    gram = np.zeros(n, np.uint64)
    for k in range(3):
        gram[:n - k or None] += words[k:] * SEEDS[k]
    gram = mix(gram) >> np.uint64(1)
    place = np.arange(n) + (owner + 1) * RADIUS
    inside = np.arange(n) + 2 < (begin + counts)[owner]
    padded[place[inside]] = gram[inside]
    least = padded  # of the RADIUS places from each on
    for d in range(1, RADIUS):
        least = np.minimum(least[:-1], padded[d:])
    own = padded[RADIUS:-RADIUS]
    edge = ((own < least[:len(own)]) & (own <= least[RADIUS + 1:]))[place - RADIUS]
    edge[begin[counts > 0]] = True
    first = np.flatnonzero(edge)
    text = owner[first]
    length = np.diff(np.append(first, n))
    number = np.arange(len(first)) - np.searchsorted(text, text)
    keep = length > RADIUS
    return text[keep], number[keep], first[keep], length[keep]


def shingle_slices(words: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all paragraphs in a row, and where each paragraph's begin."""
    sizes = length - SHINGLE + 1
    begin = np.cumsum(sizes) - sizes
    at = np.repeat(first - begin, sizes) + np.arange(int(sizes.sum()))
    return shingles(words)[at], begin


def sequence_ids(s: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Signed 64-bit identity of each paragraph's word sequence."""
    sizes = np.diff(np.append(begin, len(s)))
    place = (np.arange(len(s)) - np.repeat(begin, sizes)).astype(np.uint64)
    total = np.add.reduceat(mix(s) * (place * np.uint64(2) + np.uint64(1)), begin)
    return mix(total + sizes.astype(np.uint64)).view(np.int64)


def bands_of(s: np.ndarray, begin: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraph, band) keys from the MinHash values of the paragraphs' shingles."""
    out = np.empty((len(begin), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(begin), b + 1, np.uint64)
        for r in range(rows):
            h = (s ^ SEEDS[2 * (b * rows + r)]) * SEEDS[2 * (b * rows + r) + 1]
            h ^= h >> np.uint64(32)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(h * np.uint64(0xBF58476D1CE4E5B9), begin))
        out[:, b] = key
    return out


def band_keys(bands: int, rows: int):
    """Band keys of a batch's paragraphs; a cell's member is a word sequence, wherever it stands."""

    def keys_of(b: pa.RecordBatch):
        words, counts = word_hashes(b.column(0))
        none = np.zeros(0, np.int64)
        text, number, first, length = paragraphs(words, counts) if len(words) else (none,) * 4
        if not len(text):
            return none, none, none, none.astype(np.uint64), none, None
        s, begin = shingle_slices(words, first, length)
        keys = bands_of(s, begin, bands, rows)
        ids = sequence_ids(s, begin)
        return ids, np.zeros(len(ids), np.int64), ids, keys.ravel(), np.repeat(np.arange(len(ids)), bands), None

    return keys_of


def distinct_in(s: np.ndarray, begin: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Number of distinct shingles of each ``new`` paragraph, and the shingles (null: of the others)."""
    sizes = np.diff(np.append(begin, len(s)))
    owner = np.repeat(np.arange(len(begin)), sizes)
    mine = new[owner]
    s, owner = s[mine], owner[mine]
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    n = np.bincount(owner[first], minlength=len(begin))
    offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
    return n, pa.ListArray.from_arrays(pa.array(offsets), pa.array(s[first].view(np.int64)), mask=pa.array(~new))


SPANS = "doc_id long, th long, para long, start long, end long, first long, n_words long, id long, n long, arr array<long>"


def batch_of(columns: list, schema: str) -> pa.RecordBatch:
    """Rows of ``schema``'s columns: long, or arrays as they come."""
    cols = [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(cols, names=[x.split(" ")[0] for x in schema.split(", ")])


def spans_of(wanted):
    """Code-point spans and word numbers of the paragraphs whose sequence the filter lets through.

    ``arr``, its distinct shingles, and their number ``n`` come once for each sequence of a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, done = wanted.value, set()
        for b in batches:
            words, counts = word_hashes(b.column(1))
            if not len(words):
                continue
            text, number, first, length = paragraphs(words, counts)
            if not len(text):
                continue
            s, at = shingle_slices(words, first, length)
            ids = sequence_ids(s, at)
            pick = f.has(ids)
            if not pick.any():
                continue
            new = np.zeros(len(ids), bool)
            new[np.unique(ids, return_index=True)[1]] = True
            new &= pick
            new[new] = [i not in done for i in ids[new].tolist()]
            done.update(ids[new].tolist())
            n, arr = distinct_in(s, at, new)
            pick = np.flatnonzero(pick)
            n, arr, text, number, first, length, ids = pa.array(n, mask=~new).take(pa.array(pick)), arr.take(pa.array(pick)), *(
                x[pick] for x in (text, number, first, length, ids))
            start, end = word_spans(b.column(1))
            begin = (np.cumsum(counts) - counts)[text]
            yield batch_of([b.column(0).take(pa.array(text)), b.column(2).take(pa.array(text)), number, start[first],
                            end[first + length - 1], first - begin, length, ids, n, arr], SPANS)

    return run


def side_keys(node: np.ndarray, side: int) -> np.ndarray:
    """Signed 64-bit identity of one side (0 left, 1 right) of a paragraph."""
    return mix(node.view(np.uint64) * np.uint64(2) + np.uint64(side)).view(np.int64)


def contexts(words: np.ndarray, at: np.ndarray, sizes: np.ndarray, step: int) -> np.ndarray:
    """Hash of the first 1, 2 ... ``sizes`` words from ``at`` on in the direction ``step``, for all in a row."""
    begin = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint64)
    h = np.zeros(len(at), np.uint64)
    live = np.arange(len(at))
    for k in range(int(sizes.max(initial=0))):
        live = live[sizes[live] > k]
        h[live] = mix(h[live] * np.uint64(0x9E3779B97F4A7C15) + words[at[live] + step * k])
        out[begin[live] + k] = h[live]
    return out


#: where the extension by 1, 2 ... words begins (left) or ends (right), and the hash of its words
CONTEXTS = "key long, places array<long>, chain array<long>"


def contexts_of(wanted):
    """Contexts of the paragraph sides that the filter lets through.

    A context goes to the end of the neighbouring paragraph and ``MARGIN`` words
    on: a longer common extension would hold a whole common paragraph.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = wanted.value
        for b in batches:
            words, counts = word_hashes(b.column(0))
            if not len(words):
                continue
            text, number, first, length = paragraphs(words, counts)
            if not len(text):
                continue
            node = node_ids(b.column(1).to_numpy()[text], number)
            begin = (np.cumsum(counts) - counts)[text]
            stop, end = begin + counts[text], first + length
            next_to = (text[1:] == text[:-1]) & (number[1:] == number[:-1] + 1)
            low, high = begin.copy(), stop.copy()
            low[1:][next_to] = np.maximum(begin[1:], first[:-1] - MARGIN)[next_to]
            high[:-1][next_to] = np.minimum(stop[:-1], end[1:] + MARGIN)[next_to]
            spans = None
            for side, (at, sizes, step) in enumerate(((first - 1, first - low, -1), (end, high - end, 1))):
                key = side_keys(node, side)
                pick = np.flatnonzero(f.has(key) & (sizes > 0))
                if not len(pick):
                    continue
                at, sizes = at[pick], sizes[pick]
                spans = spans or word_spans(b.column(0))
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                word = np.repeat(at - step * offsets[:-1], sizes) + step * np.arange(offsets[-1])
                offsets = offsets.astype(np.int32)
                yield batch_of([key[pick], pa.ListArray.from_arrays(offsets, spans[side][word]),
                                pa.ListArray.from_arrays(offsets, contexts(words, at, sizes, step).view(np.int64))], CONTEXTS)

    return run


def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first columns th, para, side as the side's key, and the others as they are."""
    for b in batches:
        th, para, side = (b.column(i).to_numpy() for i in range(3))
        node = node_ids(th, para)
        key = np.where(side == 1, side_keys(node, 1), side_keys(node, 0))
        yield pa.RecordBatch.from_arrays([pa.array(key), *b.columns[3:]], names=["key", *b.schema.names[3:]])


def extensions(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """How far the runs of repeated paragraphs reach into the text around them, by text and run.

    ``left``, ``right``: words and place (d, place) of the longest extension that
    another document shares; ``left_lo``, ``right_lo``: of the longest that a
    smaller id than the smallest holder (``lo0``, ``lo1``) of the text shares.

    ``spans``: th, run, para, doc, comp, to_left, to_right (the neighbouring
    paragraphs, if they repeat).  A run's first paragraph is open to the left, its last one to the right.  An open side meets
    the other open sides of its component, and of the closed ones two for each
    neighbour (of the smallest and the largest document): closed sides with one
    neighbour go on alike.
    """
    spark = rows.sparkSession
    sides = spans.select("comp", "doc", "th", "run", "para", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("to_left").alias("near")),
        F.struct(F.lit(1).alias("side"), F.col("to_right").alias("near")))).alias("s")).select(
            "comp", "doc", "th", "run", "para", "s.side", "s.near")
    open_ = sides.filter("near is null").groupBy("comp", "side", "th", "run", "para").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    met = open_.select("comp", "side").distinct()
    unit = F.struct("doc", "th", "run", "para")
    closed = (sides.filter("near is not null").groupBy("comp", "side", "near").agg(F.min(unit).alias("x"), F.max(unit).alias("y"))
              .join(met, ["comp", "side"], "left_semi")
              .select("comp", "side", F.explode(F.array("x", "y")).alias("u"))
              .groupBy("comp", "side", "u.th", "u.run", "u.para").agg(F.min("u.doc").alias("lo"), F.max("u.doc").alias("hi")))
    units = open_.withColumn("open", F.lit(True)).unionByName(closed.withColumn("open", F.lit(False)))
    units = units.select("th", "para", "side", F.col("th").alias("text"), "run", "side", "comp", "lo", "hi", "open")
    units = cut(units.mapInArrow(with_keys, "key long, text long, run long, side int, comp long, lo long, hi long, open boolean"))
    wanted = spark.sparkContext.broadcast(key_filter(units.select("key").distinct()))
    found = rows.mapInArrow(contexts_of(wanted), CONTEXTS).dropDuplicates(["key"])  # equal texts have equal contexts
    steps = cut(units.join(found, "key").select(
        "text", "run", "side", "comp", "lo", "hi", "open", F.posexplode(F.arrays_zip("places", "chain")).alias("d", "x")).select(
            "text", "run", "side", "lo", "hi", "open", (F.col("d") + 1).alias("d"), F.col("x.places").alias("place"),
            F.xxhash64("comp", "side", "d", "x.chain").alias("step")))
    shared = (steps.groupBy("step").agg(F.min("lo").alias("least"), F.max("hi").alias("most"), F.bool_or("open").alias("met"))
              .filter("least <> most and met").select("step", "least"))
    at = F.struct("d", "place")
    met = steps.filter("open").join(shared, "step")
    pick = [F.max(F.when(F.col("side") == side, x)).alias(name) for side, name, x in (
        (0, "left", at), (1, "right", at), (0, "left_lo", F.when(F.col("least") < F.col("lo"), at)),
        (1, "right_lo", F.when(F.col("least") < F.col("lo"), at)), (0, "lo0", F.col("lo")), (1, "lo1", F.col("lo")))]
    return met.groupBy(F.col("text").alias("th"), "run").agg(*pick)


def repeated_paragraphs(docs: DataFrame, percent: int = PERCENT, recall: float = RECALL,
                        run_words: int = RUN_WORDS) -> DataFrame:
    """Every paragraph that repeats in another document.

    doc_id, para (its number), start, end and n_words (of the extended match),
    component_id (smallest doc_id that holds it), n_copies, removed (all but the
    component's first), cut_start, cut_end (what goes, if it is removed).
    """
    spark = docs.sparkSession
    bands, rows_of_band = tune_bands(percent / 100, recall)
    rows = text_rows(docs)
    buckets = max(LEAST_BUCKETS, docs.count() // TEXTS_PER_BUCKET)
    cells = cut(shared_cells(rows, band_keys(bands, rows_of_band), buckets))
    ids = cut(cells.select(F.col("th").alias("id")).distinct())
    repeated = spark.sparkContext.broadcast(key_filter(ids.select(F.col("id").alias("key"))))
    text = F.coalesce(F.col("text"), F.lit(""))
    found = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))
                .mapInArrow(spans_of(repeated), SPANS))
    sets = found.filter("arr is not null").select("id", "n", "arr")
    members = cut(cells.select("cell", F.col("th").alias("id")).join(sets.select("id", "n").distinct(), "id"))
    links = resolve(members, sets, percent, meeting=WHOLE_SETS)
    comp = ids.join(components(links), "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))
    comp = cut(comp)
    drop_tables(cells, members)
    doc = F.coalesce("doc_id", F.lit(-(1 << 63)))
    spans = found.drop("n", "arr").withColumn("doc", doc)
    by_id = spans.groupBy("id").agg(F.min(F.struct("doc", "th", "para")).alias("stays"), F.count("*").alias("n_copies"),
                                    F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    groups = (by_id.join(comp, "id").groupBy("comp").agg(F.min("stays").alias("stays"), F.sum("n_copies").alias("n_copies"),
                                                         F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo <> hi"))
    known = cut(comp.join(groups, "comp").select("id", "comp", "stays", "n_copies"))
    by_text = Window.partitionBy("th", "doc")  # a document's own paragraphs
    order = by_text.orderBy("para")
    near = {name: F.min("id").over(order.rangeBetween(k, k)) for name, k in (("to_left", -1), ("to_right", 1))}
    in_run = Window.partitionBy("th", "doc", "__run")
    spans = cut(spans.join(known, "id").withColumns(near).withColumn("__run", F.col("para") - F.dense_rank().over(order))
                .withColumns({"run": F.min("para").over(in_run),
                              "words": F.max(F.col("first") + F.col("n_words")).over(in_run) - F.min("first").over(in_run)})
                .drop("__run", "id", "first"))
    drop_tables(found, known)
    reach = cut(extensions(rows, spans))
    out = spans.join(reach, ["th", "run"], "left")
    words = F.col("words") + sum(F.coalesce(F.col(f"{x}.d"), F.lit(0)) for x in ("left", "right"))
    removed = ~F.struct("doc", "th", "para").eqNullSafe(F.col("stays"))

    def end_of(own: str, side: str, lo: str, closed: str) -> tuple[Column, Column]:
        """Where a row's match ends, and where what goes of it ends."""
        gone = F.when(F.col("doc") > F.col(lo), F.col(f"{side}.place")).otherwise(F.col(f"{side}_lo.place"))
        far, gone = (F.when(F.col(closed).isNull(), x) for x in (F.col(f"{side}.place"), gone))
        return F.coalesce(far, own), F.when(removed, F.coalesce(gone, own))

    start, cut_start = end_of("start", "left", "lo0", "to_left")
    end, cut_end = end_of("end", "right", "lo1", "to_right")
    more = sum(F.when(F.col(closed).isNull(), F.coalesce(F.col(f"{side}.d"), F.lit(0))).otherwise(0)
               for side, closed in (("left", "to_left"), ("right", "to_right")))
    smallest = F.when(F.col("stays.doc") != -(1 << 63), F.col("stays.doc"))
    return out.filter(words >= run_words).select(
        "doc_id", "para", start.alias("start"), end.alias("end"), (F.col("n_words") + more).alias("n_words"),
        smallest.alias("component_id"), "n_copies", removed.alias("removed"), cut_start.alias("cut_start"), cut_end.alias("cut_end"))


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` (unique ids) without the removed spans."""
    cuts = (spans.filter("removed").groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct(F.col("cut_start").alias("start"), F.col("cut_end").alias("end")))).alias("__cuts"))
            .withColumnRenamed("doc_id", "__id"))  # a document's own spans: bounded by its text

    def upto(acc, c):
        piece = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(c["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.concat(acc["out"], piece).alias("out"), F.greatest(c["end"], acc["at"]).alias("at"))

    kept = F.aggregate("__cuts", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), upto,
                       lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))))
    joined = docs.join(cuts, docs["doc_id"] == cuts["__id"], "left")
    return joined.withColumn("text", F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)
