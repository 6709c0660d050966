"""Katz backoff language model (operator 5).

Bigrams back off to unigrams.  Good-Turing discounts (counts up to ``K``) and
the backoff weight of every context follow from counts over all training
documents; each context's distribution sums to one over the training vocabulary
and one unknown word.

Tokens meet by context: every token goes, with its predecessor, to the bucket of
the predecessor's hash.  A bucket then holds all counts of its contexts and all
tokens to be scored under them, so counting and scoring share one shuffle, and
only partial sums by document leave it.  Frequent contexts (found in a bounded
sample; this only steers where tokens go) spread over all buckets by bigram;
their totals are added up on the driver, at most ``MAX_HOT`` of them.  Frequent
pairs of frequent words don't travel at all: their counts are known from the
unigram pass, and each task sends one number for each document and pair.

The shuffled tokens are an RDD because two jobs read them (counts of counts,
then scores): Spark keeps the files of an RDD's shuffle for both.

Edge cases: a null text counts as empty (its end is its only token); rows that
repeat an id and text get equal scores; without training tokens every word is
unknown with probability 1; an empty table gives an empty result.  Words travel
as 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.llm.util import cut, trim
from reelhouse.llm.words import hashes_of, mix, word_hashes, word_lists

K = 5
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)  # stand-ins outside the vocabulary
LEAST_BUCKETS = 32
BUCKET_BYTES = 28_000_000  # of text: about 4 million tokens
SAMPLE_DOCS = 2000
MAX_HOT = 1024
FLUSH_TOKENS = 1_800_000
FLUSH_TEXT = 2_000_000  # bytes of text whose words are counted at a time: a worker's arrays take many times as much
FLUSH_DOCS = 60_000
BLOCK = 200_000
PART_TOKENS = 500_000


def text_column() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).alias("text")


@dataclass
class Plan:
    """Where tokens go: buckets, frequent contexts and frequent pairs."""

    n_buckets: int
    hot: np.ndarray  # sorted hashes of frequent contexts; START is always one
    pair_keys: np.ndarray  # sorted keys of the frequent pairs
    pair_counts: np.ndarray  # their training counts
    pair_words: np.ndarray  # their words' hashes


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + mix(b))


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, place) of keys in a sorted table."""
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


def bigrams(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, predecessor, token) of every token of a batch; each document closes with END."""
    ends = np.cumsum(counts + 1) - 1
    if not len(ends):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    token = np.empty(int(ends[-1]) + 1, np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[~is_end], token[is_end] = words, END
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[ends - counts] = START
    return np.repeat(np.arange(len(counts), dtype=np.int32), counts + 1), before, token


def bucket_of(plan: Plan, before: np.ndarray, token: np.ndarray) -> np.ndarray:
    out = np.empty(len(before), np.int32)
    for at in range(0, len(before), BLOCK):  # in blocks: the steps between take several times the result's memory
        s = slice(at, at + BLOCK)
        h = mix(before[s])
        spread = lookup(plan.hot, before[s])[0]
        h[spread] = pair_key(before[s][spread], token[s][spread])
        out[s] = h % np.uint64(plan.n_buckets)
    return out


# --- unigrams -------------------------------------------------------------------------------------------------

UNIGRAMS = "word string, c long, part int, mask long"


def count_words(sent):
    """Partial (word, training count, buckets that will ask for it) of a task.

    Buckets come in groups of 32: one row for each group, the count in the word's first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = sent.value
        held, n = [], 0

        def flush():
            nonlocal held, n
            texts = pa.concat_arrays([t for t, _ in held])
            train = np.concatenate([x for _, x in held])
            held, n = [], 0
            flat, counts = word_lists(texts)
            if not len(flat):
                return
            enc = flat.dictionary_encode()
            del texts, flat
            codes = enc.indices.to_numpy(zero_copy_only=False)
            hashes = hashes_of(enc.dictionary)
            doc, before, token = bigrams(hashes[codes], counts)
            word = token != END
            c = np.bincount(codes, weights=train[doc[word]], minlength=len(hashes)).astype(np.int64)
            del doc
            before, token = before[word], token[word]
            asked = codes.astype(np.int64) * plan.n_buckets + bucket_of(plan, before, token)
            del before, token, word, codes
            asked = np.unique(asked)
            code, place = asked // plan.n_buckets, asked % plan.n_buckets
            group = code * (plan.n_buckets // 32 + 1) + place // 32
            begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            mask = np.bitwise_or.reduceat(np.int64(1) << (place % 32), begin)
            code, part = code[begin], (place // 32)[begin]
            c = c[code]
            c[1:][code[1:] == code[:-1]] = 0
            words = enc.dictionary.cast(pa.string()).take(pa.array(code))
            for at in range(0, len(code), 100_000):
                s = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([words.slice(at, 100_000), pa.array(c[s]), pa.array(part[s], pa.int32()), pa.array(mask[s])],
                                                 names=["word", "c", "part", "mask"])

        for b in batches:
            held.append((b.column(0).cast(pa.large_string()), b.column(1).to_numpy(zero_copy_only=False)))
            n += b.column(0).nbytes
            if n > FLUSH_TEXT:
                yield from flush()
                trim()
        if held:
            yield from flush()
        trim()

    return run


def count_hot_pairs(hot: np.ndarray):
    """Training counts of pairs of frequent words, one partial row for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for b in batches:
            words, counts = word_hashes(b.column(0))
            _, before, token = bigrams(words, counts)
            fa, a = lookup(hot, before)
            fb, z = lookup(hot, token)
            both = fa & fb
            keys, n = np.unique(a[both] * len(hot) + z[both], return_counts=True)
            for k, c in zip(keys.tolist(), n.tolist()):
                total[k] = total.get(k, 0) + c
        trim()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["pair", "n"])

    return run


def make_plan(rows: DataFrame, n_docs: int, text_bytes: int) -> Plan:
    """Buckets from the size of the text; frequent contexts and pairs."""
    n_buckets = max(LEAST_BUCKETS, -(-text_bytes // BUCKET_BYTES))
    every = max(1, n_docs // SAMPLE_DOCS)

    def sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, _ = word_hashes(b.column(0))
            w, c = np.unique(words, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c, pa.int64())], names=["w", "c"])

    sample = rows.filter(F.pmod(F.col("rk"), F.lit(every)) == 0).select("text")
    counted = sample.mapInArrow(sample_words, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))
    top = counted.orderBy(F.desc("c"), "w").limit(MAX_HOT).collect()
    total = counted.agg(F.sum("c")).first()[0] or 0
    hot = np.sort(np.array([r["w"] for r in top if r["c"] * 4 * n_buckets > total], np.int64).view(np.uint64))
    hot = np.unique(np.append(hot, START))
    pairs = (rows.filter("train").select("text").mapInArrow(count_hot_pairs(hot), "pair long, n long")
             .groupBy("pair").agg(F.sum("n").alias("n")).collect()) if len(hot) > 1 else []  # at most MAX_HOT ** 2 sums
    n_tokens = max(1, text_bytes // 6)
    often = [(r["pair"], r["n"]) for r in pairs if r["n"] * 8 * n_buckets > n_tokens]
    a = np.array([p // len(hot) for p, _ in often], np.int64)
    b = np.array([p % len(hot) for p, _ in often], np.int64)
    keys = pair_key(hot[a], hot[b]) if len(often) else np.zeros(0, np.uint64)
    order = np.argsort(keys)
    words = np.stack((hot[a], hot[b]), axis=1)[order] if len(often) else np.zeros((0, 2), np.uint64)
    return Plan(n_buckets, hot, keys[order], np.array([n for _, n in often], np.int64)[order], words)


# --- messages to the buckets ----------------------------------------------------------------------------------

MESSAGES = "bucket int, kind string, a binary, b binary, c binary, d binary, e binary"


def message(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string())] + [pa.array(c, pa.binary()) for c in cols[2:]],
                                      names=["bucket", "kind", "a", "b", "c", "d", "e"])


def pack_sorted(x: np.ndarray) -> bytes:
    """Sorted 64-bit hashes as byte planes of their differences, which compress."""
    return np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(x: bytes, n: int | None = None, offset: int = 0) -> np.ndarray:
    n = (len(x) - offset) // 8 if n is None else n
    planes = np.frombuffer(x, np.uint8, 8 * n, offset).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def small(x: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type; the first byte names its width."""
    top = int(x.max()) if len(x) else 0
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def wide(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64)


def send_counts(sent):
    """Unigram counts other than 1 to the buckets that ask, and statistics (kind 'stat') for the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = sent.value
        stats = np.zeros(K + 4, np.int64)  # 1..K+1: counts of counts; K+2: tokens; K+3: types
        hot: dict[int, int] = {}
        held: list[tuple] = []

        def flush():
            nonlocal held
            h, c, place = (np.concatenate(x) for x in zip(*held))
            held = []
            order = np.lexsort((h, place))
            h, c, place = h[order], c[order], place[order]
            cuts = np.searchsorted(place, np.arange(plan.n_buckets + 1))
            rows = [(int(b), "count", pack_sorted(h[i:j]), small(c[i:j]), b"", b"", b"")
                    for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i]
            if rows:
                yield message(rows)

        for b in batches:
            h = hashes_of(b.column(0))
            c = b.column(1).to_numpy()
            masks = b.column(2)
            stats[1:K + 2] += np.bincount(c[(c > 0) & (c <= K + 1)], minlength=K + 2)[1:K + 2]
            stats[K + 2] += c.sum()
            stats[K + 3] += (c > 0).sum()
            found, at = lookup(plan.hot, h)
            for i in np.flatnonzero(found):
                hot[int(plan.hot[at[i]])] = int(c[i])
            sizes = np.diff(masks.offsets.to_numpy())
            flat = masks.flatten()
            part, mask = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            owner = np.repeat(np.arange(len(h)), sizes)
            other = c[owner] != 1
            part, mask, owner = part[other], mask[other], owner[other]
            bits = (mask[:, None] >> np.arange(32)) & 1
            row, bit = np.nonzero(bits)
            held.append((h[owner[row]], c[owner[row]], part[row] * 32 + bit))
            if sum(len(x[0]) for x in held) > 2_000_000:
                yield from flush()
        if held:
            yield from flush()
        yield message([(0, "stat", stats.tobytes(), np.array(list(hot), np.uint64).tobytes(), np.array(list(hot.values()), np.int64).tobytes(), b"", b"")])

    return run


def send_tokens(sent):
    """Tokens of a task by bucket: contexts as runs, tokens as codes, documents as places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = sent.value
        held, n, docs = [], 0, 0

        def flush():
            nonlocal held, n, docs
            base = np.cumsum([0] + [len(h[0]) for h in held[:-1]])
            rk = np.concatenate([h[0] for h in held])
            train = np.concatenate([h[1] for h in held])
            doc = np.concatenate([h[2] + np.int32(b) for h, b in zip(held, base)])
            del base
            for h in held:
                h[2] = None
            before = np.concatenate([h[3] for h in held])
            for h in held:
                h[3] = None
            token = np.concatenate([h[4] for h in held])
            held, n, docs = [], 0, 0
            if len(plan.pair_keys):
                frequent, at = lookup(plan.pair_keys, pair_key(before, token))
                if frequent.any():
                    key, times = np.unique(doc[frequent].astype(np.int64) * len(plan.pair_keys) + at[frequent], return_counts=True)
                    used, place = np.unique(key // len(plan.pair_keys), return_inverse=True)
                    b = int(mix(np.array([rk[0]]).view(np.uint64))[0] % np.uint64(plan.n_buckets))
                    yield message([(b, "pairs", rk[used].tobytes(), small(place), small(key % len(plan.pair_keys)), small(times), b"")])
                    doc, before, token = doc[~frequent], before[~frequent], token[~frequent]
            bucket = bucket_of(plan, before, token)
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            cuts = np.searchsorted(bucket, np.arange(plan.n_buckets + 1), sorter=order)
            del bucket
            for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):  # a bucket's tokens are ordered by themselves: no copy of all
                if j > i:
                    own = order[i:j]
                    own = own[np.argsort(before[own], kind="stable")]
                    context = before[own]
                    first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
                    run_of = pack_sorted(context[first]) + small(np.diff(np.append(first, j - i)))
                    head = len(first).to_bytes(4, "little")
                    tokens, code = np.unique(token[own], return_inverse=True)
                    used, place = np.unique(doc[own], return_inverse=True)
                    yield message([(b, "tokens", head + run_of, pack_sorted(tokens), small(code),
                                    rk[used].tobytes() + np.packbits(train[used]).tobytes(), small(place))])

        for b in batches:
            words, counts = word_hashes(b.column(0))
            doc, before, token = bigrams(words, counts)
            held.append([b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False), doc, before, token])
            del words, doc, before, token, b
            n, docs = n + len(held[-1][4]), docs + len(counts)
            if n > FLUSH_TOKENS or docs > FLUSH_DOCS:
                yield from flush()
                trim()
        if held:
            yield from flush()
        trim()

    return run


# --- buckets --------------------------------------------------------------------------------------------------

class Bucket:
    """All tokens of a bucket's contexts, and the counts they need."""

    def __init__(self, plan: Plan, messages: list[tuple]):
        ctx, tok, ctx_code, tok_code, rks, trains, docs = [], [], [], [], [], [], []
        n_ctx = n_tok = n_doc = 0
        self.pairs = []
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        while messages:
            kind, a, b, c, d, e = messages.pop()
            if kind == "count":
                hashes.append(unpack_sorted(a)), counts.append(wide(b))
            elif kind == "pairs":
                self.pairs.append((np.frombuffer(a, np.int64), wide(b), wide(c), wide(d)))
            elif kind == "tokens":
                n = int.from_bytes(a[:4], "little")
                ctx.append(unpack_sorted(a, n, 4))
                ctx_code.append(np.repeat(np.arange(n_ctx, n_ctx + n, dtype=np.int32), wide(a[4 + 8 * n:])))
                tok.append(unpack_sorted(b))
                tok_code.append((wide(c) + n_tok).astype(np.int32))
                place = wide(e)
                k = int(place.max()) + 1
                rks.append(np.frombuffer(d, np.int64, k))
                trains.append(np.unpackbits(np.frombuffer(d, np.uint8, offset=8 * k))[:k].astype(bool))
                docs.append((place + n_doc).astype(np.int32))
                n_ctx, n_tok, n_doc = n_ctx + n, n_tok + len(tok[-1]), n_doc + k
        self.empty = not ctx
        if self.empty:
            return
        self.ctx, back = np.unique(np.concatenate(ctx), return_inverse=True)
        self.c = back.astype(np.int32)[np.concatenate(ctx_code)]
        del ctx_code
        self.tok, back = np.unique(np.concatenate(tok), return_inverse=True)
        self.t = back.astype(np.int32)[np.concatenate(tok_code)]
        del tok_code, back
        self.rk, self.doc, self.train = np.concatenate(rks), np.concatenate(docs), np.concatenate(trains)
        # training counts of the tokens as unigrams: 1 unless told otherwise
        h, n = np.concatenate(hashes), np.concatenate(counts)
        order = np.argsort(h)
        found, at = lookup(h[order], self.tok)
        self.uni = np.ones(len(self.tok), np.int64)
        self.uni[found] = n[order][at[found]]
        self.is_hot, self.hot_at = lookup(plan.hot, self.ctx)

    def parts(self) -> Iterator[Part]:
        """The bucket's contexts in ranges of about ``PART_TOKENS`` tokens (one context is never split)."""
        if self.empty:
            return
        ends = np.cumsum(np.bincount(self.c, minlength=len(self.ctx)))
        lo = 0
        while lo < len(self.ctx):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + PART_TOKENS, side="right")))
            yield Part(self, lo, hi)
            lo = hi

    def mass(self, unigram: np.ndarray, end: float) -> np.ndarray:
        """Unigram probability of each token; ``unigram``: of counts 0..K, then the share of one count."""
        p = np.where(self.uni <= K, unigram[np.minimum(self.uni, K)], self.uni * unigram[K + 1])
        p[self.tok == END] = end
        return p


class Part:
    """A range of a bucket's contexts: tokens, distinct bigrams and their training counts."""

    def __init__(self, x: Bucket, lo: int, hi: int):
        pick = np.flatnonzero((x.c >= lo) & (x.c < hi))
        self.ctx, self.is_hot, self.hot_at = x.ctx[lo:hi], x.is_hot[lo:hi], x.hot_at[lo:hi]
        self.c, self.doc = x.c[pick] - np.int32(lo), x.doc[pick]
        self.pair, inverse = np.unique(self.c.astype(np.int64) * len(x.tok) + x.t[pick], return_inverse=True)
        self.inverse = inverse.astype(np.int32)
        self.r = np.bincount(self.inverse[x.train[self.doc]], minlength=len(self.pair))
        self.pair_ctx = (self.pair // len(x.tok)).astype(np.int32)
        self.pair_tok = (self.pair % len(x.tok)).astype(np.int32)

    def histogram(self) -> np.ndarray:
        return np.bincount(np.minimum(self.r, K + 2), minlength=K + 3)[1:K + 2]

    def context_sums(self, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By context: counts of counts 1..K and the sum of larger counts; unigram mass of the seen tokens."""
        seen = self.r > 0
        rows = np.zeros((len(self.ctx), K + 1))
        np.add.at(rows, (self.pair_ctx[seen], np.minimum(self.r[seen], K + 1) - 1), np.where(self.r[seen] <= K, 1, self.r[seen]))
        return rows, np.bincount(self.pair_ctx[seen], weights=mass[self.pair_tok[seen]], minlength=len(self.ctx))


@dataclass
class Model:
    n_tokens: int
    n_types: int
    n_docs: int
    unigram: np.ndarray
    end: float
    discount: np.ndarray  # factor of counts 0..K
    hot_total: np.ndarray
    hot_sums: np.ndarray
    hot_mass: np.ndarray


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Katz's discount factors of the counts 0..K (1 where Good-Turing gives none)."""
    n = np.concatenate(([0.0], np.asarray(counts_of_counts, float)))
    for k in range(K, 0, -1):
        if n[1] <= 0 or (n[1:k + 2] <= 0).any():
            continue
        a = (k + 1) * n[k + 1] / n[1]
        if a >= 1:
            continue
        r = np.arange(1, k + 1)
        d = ((r + 1) * n[2:k + 2] / n[1:k + 1] / r - a) / (1 - a)
        if ((d > 0) & (d < 1)).all():
            return np.concatenate(([1.0], d, np.ones(K - k)))
    return np.concatenate(([1.0], np.full(K, 0.5)))  # too little data for Good-Turing: half of each small count


def unigram_model(counts_of_counts: np.ndarray, n: int) -> np.ndarray:
    """Probability of a word of count 0 (unknown), 1..K, and the factor of larger counts; sums to one."""
    d = discounts(counts_of_counts)
    r = np.arange(K + 1)
    lost = float(((1 - d[1:]) * r[1:] * np.asarray(counts_of_counts[:K], float)).sum())
    total = n if lost > 0 else n + 1
    unknown = lost / total if lost > 0 else 1 / total
    return np.concatenate(([unknown], d[1:] * r[1:] / total, [1 / total]))


def backoff(sums: np.ndarray, mass: np.ndarray, total: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(divisor, weight) of contexts: seen tokens get d * r / divisor, others weight * unigram.

    A context whose counts lose nothing to the discount reserves one count.
    """
    r = np.arange(1, K + 1)
    kept = (sums[:, :K] * (discount[1:] * r)).sum(axis=1) + sums[:, K]
    divisor = np.where(total - kept > 1e-9, total, total + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.where(total > 0, (1 - kept / divisor) / np.maximum(1 - mass, 1e-300), 1.0)
    return divisor, weight


def bucket_stats(plan: Plan):
    """First job: counts of counts, unigram statistics, sums of frequent contexts by unigram count."""

    def run(rows) -> Iterator[tuple]:
        total = nothing(plan)
        for _, messages in grouped(rows):
            for kind, a, b, c, _, _ in messages:
                if kind == "stat":
                    counts = dict(zip(np.frombuffer(b, np.uint64).tolist(), np.frombuffer(c, np.int64).tolist()))
                    total = plus(total, (np.frombuffer(a, np.int64), counts, *nothing(plan)[2:]))
            x = Bucket(plan, [m for m in messages if m[0] != "stat"])
            for p in x.parts():
                total = plus(total, (0, {}, p.histogram(), *frequent(x, p)))
            del x
            trim()
        yield total

    def frequent(x: Bucket, p: Part) -> tuple[np.ndarray, np.ndarray]:
        hot = np.zeros((len(plan.hot), K + 1))
        # the unigram mass of seen tokens, by their count: numbers of counts 0..K, the sum of larger ones, END
        mass = np.zeros((len(plan.hot), K + 3))
        pick = (p.r > 0) & p.is_hot[p.pair_ctx]
        at, r, tok = p.hot_at[p.pair_ctx[pick]], p.r[pick], p.pair_tok[pick]
        np.add.at(hot, (at, np.minimum(r, K + 1) - 1), np.where(r <= K, 1, r))
        uni, end = x.uni[tok], x.tok[tok] == END
        np.add.at(mass, (at, np.where(end, K + 2, np.minimum(uni, K + 1))), np.where(end | (uni <= K), 1, uni))
        return hot, mass

    return run


def nothing(plan: Plan) -> tuple:
    return (np.zeros(K + 4, np.int64), {}, np.zeros(K + 1, np.int64), np.zeros((len(plan.hot), K + 1)), np.zeros((len(plan.hot), K + 3)))


def plus(x: tuple, y: tuple) -> tuple:
    """Sum of two partial statistics (each word's count is in one of them only)."""
    return x[0] + y[0], x[1] | y[1], x[2] + y[2], x[3] + y[3], x[4] + y[4]


def grouped(rows) -> Iterator[tuple]:
    """(bucket, its messages) of a partition."""
    by: dict[int, list] = {}
    for b, m in rows:
        by.setdefault(b, []).append(m)
    while by:
        yield by.popitem()


def bucket_scores(plan: Plan, sent):
    """Second job: packed partial sums by row: log10 probability, log10(c + 1) of its words, known words."""

    def run(rows) -> Iterator[tuple]:
        m: Model = sent.value
        divisor_hot, weight_hot = backoff(m.hot_sums, m.hot_mass, m.hot_total, m.discount)
        for _, messages in grouped(rows):
            x = Bucket(plan, [y for y in messages if y[0] != "stat"])
            for rk, place, pair, times in x.pairs:  # frequent pairs
                at = lookup(plan.hot, plan.pair_words[:, 0])[1]
                d = np.where(plan.pair_counts > K, 1.0, m.discount[np.minimum(plan.pair_counts, K)])
                lp = np.log10(d * plan.pair_counts) - np.log10(divisor_hot[at])
                score = np.bincount(place, weights=lp[pair] * times, minlength=len(rk))
                is_word = plan.pair_words[:, 0] != START
                uni = m.hot_total[at] * is_word
                base = np.bincount(place, weights=np.where(is_word, np.log10(uni + 1.0), 0)[pair] * times, minlength=len(rk))
                known = np.bincount(place, weights=((uni > 0) & is_word)[pair] * times, minlength=len(rk))
                yield rk.tobytes(), score.tobytes(), base.tobytes(), known.astype(np.int64).tobytes()
            if x.empty:
                continue
            score, base, known = np.zeros(len(x.rk)), np.zeros(len(x.rk)), np.zeros(len(x.rk))
            p1 = x.mass(m.unigram, m.end)
            for p in x.parts():
                sums, mass = p.context_sums(p1)
                total = (sums[:, :K] * np.arange(1, K + 1)).sum(axis=1) + sums[:, K]
                hot = p.hot_at[p.is_hot]
                total[p.is_hot] = m.hot_total[hot]
                divisor, weight = backoff(sums, mass, total, m.discount)
                divisor[p.is_hot], weight[p.is_hot] = divisor_hot[hot], weight_hot[hot]
                kept = np.where(p.r > K, 1.0, m.discount[np.minimum(p.r, K)]) * p.r / np.maximum(divisor, 1)[p.pair_ctx]
                prob = np.where(p.r > 0, kept, weight[p.pair_ctx] * p1[p.pair_tok])
                word = np.where(p.ctx == START, 0.0, np.log10(total + 1))
                score += np.bincount(p.doc, weights=np.log10(prob)[p.inverse], minlength=len(x.rk))
                base += np.bincount(p.doc, weights=word[p.c], minlength=len(x.rk))
                known += np.bincount(p.doc, weights=((total > 0) & (p.ctx != START))[p.c], minlength=len(x.rk))
            yield x.rk.tobytes(), score.tobytes(), base.tobytes(), known.astype(np.int64).tobytes()
            del x, p, prob, kept, score, base, known
            trim()

    return run


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for rk, s, base, known in zip(*(b.column(i).to_pylist() for i in range(4))):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rk, np.int64)), pa.array(np.frombuffer(s, np.float64)),
                                              pa.array(np.frombuffer(base, np.float64)), pa.array(np.frombuffer(known, np.int64))],
                                             names=["rk", "s", "base", "known"])


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = word_lists(b.column(0))[1] + 1
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(n)], names=[*b.schema.names[1:], "n_tokens"])


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    text = text_column()
    rows = docs.select(text, F.xxhash64(F.col("doc_id"), text).alias("rk"), (~held_out).alias("train"),
                       F.col("doc_id").cast("long").alias("doc_id"))
    n_docs, train_docs, text_bytes = rows.agg(F.count("*"), F.sum(F.col("train").cast("long")), F.sum(F.octet_length("text"))).first()
    plan = make_plan(rows, n_docs, text_bytes or 0)
    sent = sc.broadcast(plan)
    tokens = rows.select("text", "rk", "train")
    unigrams = rows.select("text", "train").mapInArrow(count_words(sent), UNIGRAMS).repartition("word")
    unigrams = (unigrams.groupBy("word", "part").agg(F.sum("c").alias("c"), F.bit_or("mask").alias("mask"))
                .groupBy("word").agg(F.sum("c").alias("c"), F.collect_list(F.struct("part", "mask")).alias("masks")))
    messages = unigrams.mapInArrow(send_counts(sent), MESSAGES).union(tokens.mapInArrow(send_tokens(sent), MESSAGES))
    buckets = messages.rdd.map(lambda r: (r[0], tuple(bytes(x) if isinstance(x, bytearray) else x for x in r[1:]))).partitionBy(plan.n_buckets)
    # first job: statistics, added up on the way
    model = fit(plan, *buckets.mapPartitions(bucket_stats(plan)).treeReduce(plus), int(train_docs or 0))
    known = sc.broadcast(model)
    packed = buckets.mapPartitions(bucket_scores(plan, known))
    partial = spark.createDataFrame(packed, "a binary, b binary, c binary, d binary").mapInArrow(unpack, "rk long, s double, base double, known long")
    sums = partial.groupBy("rk").agg(F.sum("s").alias("s"), F.sum("base").alias("base"), F.sum("known").alias("known"))
    own = rows.select("text", "rk", "doc_id", (~F.col("train")).alias("held_out")).mapInArrow(
        count_tokens, "rk long, doc_id long, held_out boolean, n_tokens long")
    own = cut(own)
    times = own.groupBy("rk").agg(F.count("*").alias("times"))
    sums = sums.join(times, "rk").select("rk", *(((F.col(c) / F.col("times")) if c != "known" else (F.col(c) / F.col("times")).cast("long")).alias(c)
                                                 for c in ("s", "base", "known")))
    n, v, ends = model.n_tokens, model.n_types, model.n_docs
    scale = math.log10(n + 1 * (v + 1)) if n + v + 1 > 0 else 0.0
    return own.join(sums, "rk").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(math.log10(ends + 1)) - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        F.col("s").alias("score"))


def fit(plan: Plan, stats, hot_counts, histogram, hot_sums, hot_by_count, train_docs: int) -> Model:
    """Discounts, unigram probabilities and the frequent contexts' totals from the first job's sums."""
    stats = stats.copy()
    n_types, n_words = int(stats[K + 3]), int(stats[K + 2])
    counts = stats[1:K + 2].copy()  # END is a type with one count for each training document
    if train_docs:
        n_types += 1
        if train_docs <= K + 1:
            counts[train_docs - 1] += 1
    n = n_words + train_docs
    unigram = unigram_model(counts, n) if n else np.concatenate(([1.0], np.zeros(K + 1)))
    prob = lambda c: unigram[c] if c <= K else c * unigram[K + 1]
    end = float(prob(train_docs)) if train_docs else float(unigram[0])
    total = np.array([train_docs if h == int(START) else hot_counts.get(h, 0) for h in plan.hot.tolist()], np.int64)
    hot_sums, by_count = hot_sums.copy(), hot_by_count
    mass = by_count[:, :K + 1] @ unigram[:K + 1] + by_count[:, K + 1] * unigram[K + 1] + by_count[:, K + 2] * end
    for (a, b), r in zip(plan.pair_words.tolist(), plan.pair_counts.tolist()):  # pairs that didn't travel
        i = int(np.searchsorted(plan.hot, np.uint64(a)))
        hot_sums[i, min(r, K + 1) - 1] += 1 if r <= K else r
        mass[i] += prob(hot_counts.get(b, 0))
        if r <= K + 1:
            histogram = histogram.copy()
            histogram[r - 1] += 1
    return Model(n, n_types, train_docs, unigram, end, discounts(histogram), total, hot_sums, mass)
