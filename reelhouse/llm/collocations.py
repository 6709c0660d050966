"""Phrase collocation mining (operator 11): direct-address tiles of ranked ids.

Words of a language are counted and ranked by frequency.  A task then turns its
texts into ids and counts pairs of neighbours: the ranks of the most frequent
``HEAD`` words split the pair plane into tiles of ``SIDE`` x ``SIDE`` cells.  A
tile with many pairs is counted by ``numpy.bincount`` over its cells, directly
addressed; pairs of sparse tiles, and pairs of a word beyond the head, are
counted as sorted coordinates (COO).  Spark adds up the tasks' counts by cell, so
a pair however frequent costs one row for each block of texts.  Frequent pairs
are ranked again by frequency and become the left ids of the next plane (phrase,
next word), and so on up to ``longest`` words.  ``HEAD`` bounds what is broadcast
(two numbers for each id); it decides how a pair is counted, never whether.

Only words and phrases of ``least`` occurrences can be part of a phrase of
``least`` occurrences, so others are left out early, by a filter of fixed size
that may let some through; counts of what it lets through are exact.  Words are
held as 63-bit hashes of language and word (two of V words collide with a chance
of V**2 / 2**64); texts come back by joins.  Scores are computed in 38-digit
decimals.

Edge cases: a null or empty text has no words; a null language is ``und``; a
word is a maximal run without space and tab inside a piece between the characters
``.,;:!?`` and line ends, and may be of any length; a phrase never crosses pieces
or documents; repeated rows count each; ties in score are ordered by count, then
by the bytes of the phrase; a table without rows, or without frequent phrases,
gives an empty report; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.llm.setjoin import key_filter
from reelhouse.llm.util import cut, trim
from reelhouse.llm.words import hashes_of, mix
from reelhouse.operators.windows import top_k_per_group, top_n

LEAST, LONGEST, TOP = 10, 3, 2000
COVER = 50  # percent of a phrase's occurrences inside one longer phrase that make it a part of that
BLOCK_BYTES = 2 << 20
SEND_ROWS = 1 << 16  # of one Arrow batch
HEAD = 1 << 16  # ids with a rank
SIDE = 256  # ids along a tile's side
DENSE = 16  # a tile is counted directly from one pair for so many cells
GROUPS = 64  # first level of the report's ranking

#: Bytes: 0 of a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
STEP = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64((1 << 63) - 1)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Texts and languages of consecutive batches, some BLOCK_BYTES of them at a time."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(0).nbytes
        if size >= BLOCK_BYTES:
            yield joined(held)
            held, size = [], 0
    if held:
        yield joined(held)


def joined(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    text, lang = (pa.concat_arrays([b.column(i).cast(pa.large_string()) for b in held]) for i in (0, 1))
    return text, lang


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts in order, each one's text, and whether the next word follows it in the same piece."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    kind = KIND[data]
    inside = kind == 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    filled = ends[:-1] < ends[1:]
    begin, last = ends[:-1][filled], ends[1:][filled] - 1
    start[begin] |= inside[begin]
    stop[last] |= inside[last]
    at = np.flatnonzero(start)
    offsets = np.concatenate(([0], np.cumsum(np.flatnonzero(stop) + 1 - at)))
    words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    owner = np.searchsorted(ends, at, "right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), at)
    follows = np.zeros(len(at), bool)
    follows[:-1] = (owner[1:] == owner[:-1]) & (piece[1:] == piece[:-1])
    return words, owner, follows


def coded(texts: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Number of each word among the block's distinct (language, word), whether the next one follows,
    the distinct ones' hashes and, as columns, their languages and words."""
    words, owner, follows = split_words(texts)
    enc = words.dictionary_encode()
    code = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tongue = pc.fill_null(langs, "und").dictionary_encode()
    lang = tongue.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner]
    key, number = np.unique(lang * max(1, len(enc.dictionary)) + code, return_inverse=True)
    which, word = np.divmod(key, max(1, len(enc.dictionary)))
    if not len(key):
        return number, follows, np.zeros(0, np.int64), [tongue.dictionary.slice(0, 0), enc.dictionary.slice(0, 0)]
    sig = combine(mix(hashes_of(tongue.dictionary))[which], hashes_of(enc.dictionary)[word])
    return number, follows, sig, [tongue.dictionary.take(pa.array(which)), enc.dictionary.take(pa.array(word))]


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """63-bit identity of a phrase from that of all words but the last and of the last one."""
    return (mix(left.astype(np.uint64) * STEP + mix(right.astype(np.uint64))) & LOW).view(np.int64)


def sent(columns: list, names: list[str]) -> Iterator[pa.RecordBatch]:
    """A block's rows in small batches."""
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    for at in range(0, len(whole), SEND_ROWS):
        yield whole.slice(at, SEND_ROWS)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts, langs in blocks(batches):
        number, _, sig, columns = coded(texts, langs)
        count = np.bincount(number, minlength=len(sig))
        yield from sent([c.cast(pa.string()) for c in columns] + [pa.array(sig), pa.array(count, pa.int64())], ["lang", "word", "sig", "c"])
    trim()


class Head:
    """Ranks of the most frequent ids: rank 0 is the most frequent."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.order = np.argsort(ids)
        self.sorted = ids[self.order]

    def rank(self, ids: np.ndarray) -> np.ndarray:
        """Rank of each id, or -1."""
        if not len(self.ids):
            return np.full(len(ids), -1)
        at = np.minimum(np.searchsorted(self.sorted, ids), len(self.ids) - 1)
        return np.where(self.sorted[at] == ids, self.order[at], -1)


def coo(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    return np.unique(key, return_counts=True)


def tile_counts(a: np.ndarray, b: np.ndarray, side: int = SIDE, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ranks (a, b) and their counts: tiles with many pairs by direct address, the rest as sorted COO."""
    width = int(b.max(initial=0)) // side + 1
    tile = (a // side) * width + b // side
    order = np.argsort(tile, kind="stable")
    a, b, tile = a[order], b[order], tile[order]
    cuts = np.append(np.flatnonzero(np.diff(tile, prepend=-1)), len(tile))
    full = np.diff(cuts) * dense >= side * side
    out = []
    for i in np.flatnonzero(full).tolist():
        s = slice(cuts[i], cuts[i + 1])
        grid = np.bincount((a[s] % side) * side + b[s] % side, minlength=side * side)
        cell = np.flatnonzero(grid)
        out.append((a[s.start] // side * side + cell // side, b[s.start] // side * side + cell % side, grid[cell]))
    rest = np.repeat(~full, np.diff(cuts))
    key, count = coo(a[rest] << 32 | b[rest])
    out.append((key >> 32, key & 0xFFFFFFFF, count))
    return tuple(np.concatenate(x) for x in zip(*out))


def pair_counts(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, of_left: Head,
                of_right: Head) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ids (ranks ``a`` and ``b``, or -1) and their counts."""
    ranked = (a >= 0) & (b >= 0)
    a, b, count = tile_counts(a[ranked], b[ranked])
    left, right = left[~ranked], right[~ranked]
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.ones(len(left), bool)
    first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    begin = np.flatnonzero(first)
    far = np.diff(np.append(begin, len(left)))
    return np.append(of_left.ids[a], left[begin]), np.append(of_right.ids[b], right[begin]), np.append(count, far)


def count_phrases(k: int, known: list, heads: list):
    """(left, right, c) of phrases of k words: ``known`` filters and ``heads`` rank phrases of 1 to k - 1 words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, ranks = [x.value for x in known], [x.value for x in heads]
        for texts, langs in blocks(batches):
            number, follows, sig, _ = coded(texts, langs)
            if not len(number):
                continue
            word, ok = sig[number], filters[0].has(sig)[number]
            left = word
            for n in range(1, k):  # phrases of n words from each position on, as long as both parts are frequent
                room = len(word) - n
                span = follows[n - 1:n - 1 + room] & ok[:room] & ok[1:room + 1]
                right = word[n:]
                if n < k - 1:
                    sig_n = combine(left[:room], right)
                    ok = span
                    ok[span] = filters[n].has(sig_n[span])
                    left = sig_n
            left, right, rank = left[:room][span], right[span], ranks[0].rank(sig)[number]
            of_left = rank[:room][span] if k == 2 else ranks[-1].rank(left)
            found = pair_counts(left, right, of_left, rank[k - 1:][span], ranks[-1], ranks[0])
            yield from sent([pa.array(x) for x in found], ["left", "right", "c"])
        trim()

    return run


def with_sig(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sig = combine(b.column(0).to_numpy(), b.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(sig), *b.columns], names=["sig", "left", "right", "f"])


def ranked_head(units: DataFrame) -> Head:
    """The HEAD most frequent ids, a bounded list."""
    got = top_n(units.select("sig", "f"), [F.col("f").desc(), F.col("sig")], HEAD).select("sig").collect()
    return Head(np.array([r[0] for r in got], np.int64))


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, dict[int, DataFrame]]:
    """(lang, n) and, by number of words, the frequent phrases: sig, words (hashes), lang, phrase, f."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    vocabulary = cut(rows.mapInArrow(count_words, "lang string, word string, sig long, c long")
                     .groupBy("lang", "word", "sig").agg(F.sum("c").alias("f")))
    totals = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    words = vocabulary.filter(F.col("f") >= least)
    levels = {1: cut(words.select("sig", F.array("sig").alias("words"), "lang", F.col("word").alias("phrase"), "f"))}
    known, heads = [], []
    for k in range(2, longest + 1):
        units = levels[k - 1]
        known.append(sc.broadcast(key_filter(units.select(F.col("sig").alias("key")))))
        heads.append(sc.broadcast(ranked_head(units)))
        counted = (rows.mapInArrow(count_phrases(k, known, heads), "left long, right long, c long")
                   .groupBy("left", "right").agg(F.sum("c").alias("f")).filter(F.col("f") >= least)
                   .mapInArrow(with_sig, "sig long, left long, right long, f long"))
        head = units.select(F.col("sig").alias("left"), F.col("words").alias("w"), "lang", F.col("phrase").alias("p"))
        tail = levels[1].select(F.col("sig").alias("right"), F.col("phrase").alias("q"))
        levels[k] = cut(counted.join(head, "left").join(tail, "right").select(
            "sig", F.concat("w", F.array("right")).alias("words"), "lang", F.concat_ws(" ", "p", "q").alias("phrase"), "f"))
    return totals, levels


def scored(levels: dict[int, DataFrame], k: int) -> DataFrame:
    """Phrases of k words with a, l, r and score of the cut that scores lowest."""
    out = levels[k]
    for j in range(1, k):
        first = levels[j].select(F.col("words").alias(f"w{j}"), F.col("f").alias(f"l{j}"))
        rest = levels[k - j].select(F.col("words").alias(f"v{j}"), F.col("f").alias(f"r{j}"))
        out = (out.withColumn(f"w{j}", F.slice("words", 1, j)).withColumn(f"v{j}", F.slice("words", j + 1, k - j))
               .join(first, f"w{j}").join(rest, f"v{j}").drop(f"w{j}", f"v{j}"))
    cuts = [F.struct(exact_score(F.col("f"), F.col(f"l{j}"), F.col(f"r{j}")).alias("score"), F.lit(j).alias("j"),
                     F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r")) for j in range(1, k)]
    least = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return out.withColumn("cut", least).select("sig", "words", "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")


def exact_score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers."""
    wide = [x.cast("decimal(19,0)") for x in (a, l, r)]
    square, product = wide[0] * wide[0], wide[1] * wide[2]
    return F.call_function("div", square.cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)"), product)


def standing(levels: dict[int, DataFrame], k: int, found: DataFrame, cover: int) -> DataFrame:
    """``found`` without the phrases that one longer phrase covers (what covers through two more words does through one)."""
    if k + 1 not in levels:
        return found
    longer = levels[k + 1]
    parts = reduce(DataFrame.union, [longer.select(F.slice("words", j, k).alias("words"), "f") for j in (1, 2)])
    covered = parts.groupBy("words").agg(F.max("f").alias("most"))
    held = found.join(covered, "words", "left")
    return held.filter(F.col("most").isNull() | (100 * F.col("most") < cover * F.col("a"))).drop("most")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language by score, count and phrase."""
    totals, levels = phrase_counts(docs, least, longest)
    found = reduce(DataFrame.unionByName, [standing(levels, k, scored(levels, k), cover) for k in range(2, longest + 1)])
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = found.withColumn("__group", F.pmod("sig", F.lit(GROUPS)))
    firsts = top_k_per_group(dealt, ["lang", "__group"], order, top, "__rank").drop("__rank", "__group")
    best = top_k_per_group(firsts, ["lang"], order, top, "rank").join(totals, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
