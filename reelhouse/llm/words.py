"""Words and word shingles of whole texts, as numpy arrays inside Arrow batches.

Words are the maximal runs without ASCII white space (bytes 9 to 13 and 32) of
the text with A-Z lower-cased.  They travel as 64-bit hashes, shingles as mixed
64-bit hashes of their words; two different shingles get one hash with a chance
of 2**-64 for each pair.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

pa.set_memory_pool(pa.system_memory_pool())  # gives freed memory back: a worker outlives its tasks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
SHINGLE = 5
WORDS_AT_ONCE = 1 << 17
STEPS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(1, SHINGLE + 1)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (three shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_lists(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch in order, and the number of words of each text (null: none)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(full).as_py() and len(flat):
        owner = owner[full.to_numpy(zero_copy_only=False)]
        flat = flat.filter(full)
    return flat, np.bincount(owner, minlength=len(texts)).astype(np.int64)


def word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where every word of a batch begins and ends in its text, in code points; the words of ``word_lists``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    inside = ~WHITE[data]
    first = np.zeros(len(data) + 1, bool)  # of a text; a word ends there too
    first[at] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= first[1:-1] | ~inside[:-1]
    end[:-1] &= first[1:-1] | ~inside[1:]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    point = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)  # code points before each byte
    np.cumsum(data & 0xC0 != 0x80, out=point[1:])
    base = point[at[np.searchsorted(at, begin, "right") - 1]]
    return (point[begin] - base).astype(np.int64), (point[end] - base).astype(np.int64)


def hashes_of(values: pa.Array) -> np.ndarray:
    """64-bit hash of each string (the same in every process)."""
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a batch in order, and the number of words of each text."""
    flat, counts = word_lists(texts)
    if not len(flat):
        return np.zeros(0, np.uint64), counts
    out = np.empty(len(flat), np.uint64)
    for at in range(0, len(flat), WORDS_AT_ONCE):  # a dictionary that stays in the processor's cache
        enc = flat.slice(at, WORDS_AT_ONCE).dictionary_encode()
        out[at:at + WORDS_AT_ONCE] = hashes_of(enc.dictionary)[enc.indices.to_numpy(zero_copy_only=False)]
    return out, counts


def shingles(words: np.ndarray) -> np.ndarray:
    """Hash of the SHINGLE words from each position on (positions near the end run over it)."""
    out = np.zeros(len(words), np.uint64)
    for k, step in enumerate(STEPS):
        out[:len(words) - k or None] += words[k:] * step
    return mix(out)


def short_shingle(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text with fewer than SHINGLE words: its whole sequence."""
    total = (words * np.array(STEPS[:len(words)], np.uint64)).sum(keepdims=True) + np.uint64(len(words))
    return mix(total ^ np.uint64(0x5851F42D4C957F2D))


def shingle_sets(words: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingles of each text (empty without words)."""
    every, out, at = shingles(words), [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            out.append(np.unique(every[at:at + n - SHINGLE + 1]))
        else:
            out.append(short_shingle(words[at:at + n]) if n else np.zeros(0, np.uint64))
        at += n
    return out


def set_hash(s: np.ndarray) -> int:
    """Signed 64-bit identity of a set of shingles."""
    return int(mix(np.array([(mix(s).sum(dtype=np.uint64) + np.uint64(len(s)))], np.uint64)).view(np.int64)[0])
