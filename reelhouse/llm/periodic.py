"""Periodic run detection (operator 13): runs of words by a dictionary of basic factors.

A run is a stretch of words of smallest period q that no neighbouring word
extends; those of ``least_words`` words and ``least_powers`` periods count.  The
dictionary names, for every power of two m, the factor of m words at each
position; the factors of 2m words are named by pairs of names.  Two occurrences
of a factor that both lie in a window of 2m words are at most m apart.  Where
successive occurrences keep one distance q three times (an arithmetic
progression), q is proposed as a period; neighbouring proposals of a distance
extend to the whole stretch.  A run of four periods shows up at the smallest
m >= q, and a factor of m >= q words has no nearer occurrence inside the run
than its smallest period, so the stretch's ends are those of the run.  Longer
factors find the run again; equal runs are kept once.

A factor that does not occur again within the longest period its text has room
for takes no part in longer ones, so ordinary text ends after a few lengths.  A
batch of documents is named at once; names of different documents never meet.

Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are.  Edge cases: a null,
empty or blank text has no words, no runs and collapses to an empty text; very
long texts are taken whole (a few arrays of the batch's words are held, not one
for each length); a fixed word repeated through the text is one run of period
1; repeated rows give equal rows; an empty table gives an empty one; columns of
the table other than the text are carried on unread, one of a result's name is
replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from reelhouse.llm.util import add_columns
from reelhouse.llm.words import word_lists

LEAST_WORDS, LEAST_POWERS = 6, 4
RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])


def successors(name: np.ndarray, at: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of ``at``) and the distance to the next position of equal name, where that is at most ``reach`` there."""
    order = np.argsort(name, kind="stable")
    name, at = name[order], at[order]
    gap = at[1:] - at[:-1]
    near = (name[1:] == name[:-1]) & (gap <= reach[at[:-1]])
    return at[:-1][near], gap[near]


def stretches(nxt: np.ndarray, m: int) -> np.ndarray:
    """(start, length, period) proposed at factor length m; ``nxt`` holds the successor's distance or 0."""
    at = np.flatnonzero((nxt > 0) & (nxt <= m))
    q = nxt[at]
    third = nxt[at + q] == q  # at, at + q and at + 2q: an arithmetic progression
    # extend: neighbouring positions of one distance belong to one stretch
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + 1) | (q[1:] != q[:-1])
    group = np.cumsum(first) - 1
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(at)))
    proposed = np.bincount(group[third], minlength=len(begin)) > 0
    begin, size = begin[proposed], size[proposed]
    return np.stack([at[begin], size - 1 + m + q[begin], q[begin]], axis=1)


def runs_of(codes: np.ndarray, counts: np.ndarray, least_words: int = LEAST_WORDS,
            least_powers: int = LEAST_POWERS) -> np.ndarray:
    """(position, length, period) of the runs of concatenated documents, by position and period.

    ``codes`` names each word, ``counts`` the number of words of each document;
    positions count over all documents.  Four periods are the least that the
    progressions are sure to show.
    """
    if least_powers < 4:
        raise ValueError("runs of fewer than four periods need not show up as a progression")
    n = len(codes)
    doc = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(np.cumsum(counts), counts)
    longest = np.repeat(np.asarray(counts) // least_powers, counts)  # period
    # one name in two documents is two names
    name = np.unique(doc * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1]
    at, m = np.arange(n), 1
    found = [np.zeros((0, 3), np.int64)]
    while len(at):
        here, gap = successors(name, at, longest)
        nxt = np.zeros(n, np.int64)
        nxt[here] = gap
        found.append(stretches(nxt, m))
        # factors of 2m words: both halves occur again
        again = np.zeros(n, bool)
        again[here] = again[here + gap] = True
        left = again[at] & (at + 2 * m <= end[at])
        left[left] = again[at[left] + m]
        full = np.zeros(n, np.int64)
        full[at] = name
        at = at[left]
        name = np.unique(full[at] * (int(full.max(initial=0)) + 1) + full[at + m], return_inverse=True)[1]
        m *= 2
    every = np.unique(np.concatenate(found), axis=0)
    return every[every[:, 1] >= np.maximum(least_words, least_powers * every[:, 2])][:, [0, 1, 2]]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words are in no run after that run's first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:n]) == 0


def mark_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed",
              least_words: int = LEAST_WORDS, least_powers: int = LEAST_POWERS) -> DataFrame:
    """``docs`` with the runs of each text and its kept words joined by a space, in place of the text."""

    def mark(b: pa.RecordBatch) -> list:
        flat, counts = word_lists(b.column(b.schema.get_field_index(text)), lower=False)
        codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found = runs_of(codes, counts, least_words, least_powers)
        keep = kept_words(len(codes), found)
        base = np.concatenate(([0], np.cumsum(counts)))
        of = np.searchsorted(base, found[:, 0], "right") - 1
        ends = np.searchsorted(of, np.arange(len(counts) + 1))
        rows = pa.StructArray.from_arrays([pa.array(found[:, 0] - base[of]), pa.array(found[:, 1]), pa.array(found[:, 2])],
                                          names=RUN.names)
        kept = np.concatenate(([0], np.cumsum(keep)))[base]
        lists = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.filter(pa.array(keep)))
        texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows), texts.cast(pa.string())]

    fields = [T.StructField(runs, T.ArrayType(RUN)), T.StructField(collapsed, T.StringType())]
    return add_columns(docs, mark, fields, drop=(text, runs, collapsed))


def repeat_tail(words: list[str], h: int) -> list[str]:
    """Words from h's place on become copies of the first few from there (h: a hash of the document's id)."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text: the texts of the ids that ``repeat_tail`` picks hold repeats (a null id: empty text's hash)."""

    def plant(b: pa.RecordBatch) -> list:
        ids, texts = b.column(0).to_pylist(), b.column(1)
        pick = {i: h for i, x in enumerate(ids) if (h := zlib.crc32(b"" if x is None else str(x).encode())) % 10 == 0}
        some = texts.take(pa.array(list(pick), pa.int64()))
        flat, counts = word_lists(some, lower=False)
        out, at = texts.to_pylist(), 0
        for (i, h), n in zip(pick.items(), counts.tolist()):
            out[i] = " ".join(repeat_tail(flat.slice(at, n).to_pylist(), h))
            at += n
        return [pa.array(out, pa.string())]

    return add_columns(docs.select("doc_id", "text"), plant, [T.StructField("text", T.StringType())], drop=("text",))


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, number of runs, the longest run (ties: smallest start, then period) and digests of runs and kept words."""
    r = mark_runs(docs.select("doc_id", "text"))
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS size, r.start AS start, r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    r = r.withColumn("top", longest)
    length = -F.col("top.size")
    return r.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), length.alias("length"),
                    F.col("top.period").alias("period"), F.expr("-top.size * 1000 div top.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
