"""Packing by lexical retrieval (operator 9).

Every whole text is tokenised, closed with an end id and cut into full windows;
what is left of each text (shorter than a window) becomes an item.  Document
frequencies and the mean length are counted over all items.  Items are dealt to
shards by content: in the order of their heaviest shared terms (BM25 weights),
cut into ranges of about ``shard_items``, so items that share them lie together
however many shards there are.  A shard builds a BM25 index of its items' ids
with the corpus's statistics.  Each sequence starts from the shard's longest
unused item, its seed; the index returns the seed's unused neighbours by BM25
over all of the seed's terms, and they fill the window greedily, best first.  A gap that no
neighbour fits takes the longest unused item that fits, then a cut piece of one.
Only a shard's last window can stay short; it is split at powers of two, which
need no padding.

A task holds one shard at a time: ``shard_items`` items of less than a window
each, however long or frequent the texts are.

Edge cases: a null text counts as empty (its end id is its only token).  Null or
repeated ids are packed like any other row.  Repeated rows give equal pieces in
places of their own.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from reelhouse.llm.util import cut
from reelhouse.llm.words import word_lists

WINDOW = 2048
SHARD_ITEMS = 2048
CACHE_WORDS = 300_000  # words of each of the two generations of a worker's cache
ROUTE_TERMS = 16  # heaviest shared terms, by which items are ordered
BOUND_SAMPLE = 20  # items of a shard, about, that choose the ranges' bounds
GATHER_BYTES = 16 * 1024 * 1024
K1, B = 1.2, 0.75
#: The vocabulary's pre-tokenizer pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same over lower-cased words of printable Latin characters, and such words (below U+0250, where nothing
#: composes and letters fold one by one, but for the dotted capital I).
LATIN_PATTERN = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+)"
LATIN_WORD = r"^[\x{21}-\x{7e}\x{a1}-\x{12f}\x{131}-\x{24f}]+$"


class Cache:
    """Two generations: what is used again moves to the young one, the old one is dropped."""

    def __init__(self, limit: int = CACHE_WORDS):
        self.young, self.old, self.limit = {}, {}, limit

    def get(self, key):
        got = self.young.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value


class WordTokenizer:
    """Ids of texts under a tokenizer that drops white space: words are encoded once and reused."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.no_truncation()
        self.t.no_padding()
        self.model, self.parts, self.pattern = self.t.model, Cache(), regex.compile(PATTERN)
        self.kind = np.dtype("<u2" if self.t.get_vocab_size() <= 1 << 16 else "<u4")
        self.words, self.code = Cache(), "H" if self.kind.itemsize == 2 else "I"
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.stand_in = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        probe = "Don't stop, Édouard's 42 café_x   é!"
        whole = self.t.encode(probe, add_special_tokens=False).ids
        self.direct = whole == [i for w in probe.encode().split() for i in np.frombuffer(self.word(w), self.kind)]
        self.words, self.parts = Cache(), Cache()

    direct = True

    def word(self, w: bytes) -> bytes:
        """Packed ids of a stretch without ASCII white space."""
        if not self.direct or b"<|" in w:
            return np.array(self.t.encode(w.decode(), add_special_tokens=False).ids, self.kind).tobytes()
        s = w.decode()
        if not s.isascii() and max(s) >= "\u0250":  # other scripts: the library's own normaliser and classes
            return np.array(self.t.encode(s, add_special_tokens=False).ids, self.kind).tobytes()
        s = s.lower()  # below U+0250 nothing composes and letters fold one by one
        if s.isalpha():
            return self.part(s)
        if s[:-1].isalpha() and s[-1] in ".,":
            return self.part(s[:-1]) + self.part(s[-1])
        return b"".join([self.part(x) for x in self.pattern.findall(s)])

    def part(self, s: str) -> bytes:
        """Packed ids of one pre-token."""
        ids = self.parts.get(s)
        if ids is None:
            tokens = self.model.tokenize(s if s.isascii() and s.isprintable() else s.encode().decode("latin1").translate(self.stand_in))
            ids = array(self.code, [x.id for x in tokens]).tobytes()
            self.parts.put(s, ids)
        return ids

    def ids_of_parts(self, parts: list[str]) -> list[bytes]:
        found = list(map(self.parts.young.get, parts))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self.part(parts[i])
        return found

    def ids_of_words(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.words.get, words))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self.word(words[i])
                self.words.put(words[i], found[i])
        return found

    def spell(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, place of each word's first, their number) of distinct words.

        Latin words are lower-cased and cut into pre-tokens together, each distinct pre-token is encoded
        once; the other words are encoded one by one.
        """
        plain = pc.match_substring_regex(words, LATIN_WORD).to_numpy(zero_copy_only=False)
        plain = plain & ~pc.match_substring(words, "<|").to_numpy(zero_copy_only=False) if self.direct else np.zeros(len(words), bool)
        low = pc.utf8_lower(words.filter(pa.array(plain)))
        stems = pc.utf8_rtrim(low, ".,")
        marks = pc.subtract(pc.binary_length(low), pc.binary_length(stems)).to_numpy(zero_copy_only=False)
        easy = pc.utf8_is_alpha(stems).to_numpy(zero_copy_only=False) & (marks < 2)  # letters, perhaps one mark behind them
        marked = marks[easy] == 1
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(low.filter(pa.array(~easy)), LATIN_PATTERN, r"\1 "))
        n_rest = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        keep = np.ones(int(n_rest.sum()), bool)
        keep[np.cumsum(n_rest) - 1] = False  # each word ends with a separator, behind which is nothing
        ends_of = pc.utf8_slice_codeunits(low.filter(pa.array(easy)).filter(pa.array(marked)), -1)
        enc = pa.concat_arrays([stems.filter(pa.array(easy)), ends_of, lists.flatten()]).dictionary_encode()
        got = enc.indices.to_numpy(zero_copy_only=False)
        n = np.concatenate((1 + marked, n_rest - 1))  # pre-tokens of the easy words, then of the rest
        codes = np.empty(int(n.sum()), np.int64)
        first = np.cumsum(1 + marked) - 1 - marked
        codes[first], codes[first[marked] + 1] = got[:len(marked)], got[len(marked):len(marked) + len(ends_of)]
        codes[len(marked) + len(ends_of):] = got[len(marked) + len(ends_of):][keep]
        of = np.flatnonzero(plain)
        of = np.concatenate((of[easy], of[~easy]))
        parts = self.ids_of_parts(enc.dictionary.to_pylist())
        others = self.ids_of_words(words.filter(pa.array(~plain)).cast(pa.large_binary()).to_pylist())
        del low, stems, lists, enc, got, keep
        width = self.kind.itemsize
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // width
        length = sizes[codes]
        ends = np.cumsum(length)
        place = np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)
        table = np.concatenate((np.frombuffer(b"".join(parts), self.kind)[place], np.frombuffer(b"".join(others), self.kind)))
        size, begin = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        size[of] = np.diff(np.append(0, ends)[np.append(0, np.cumsum(n))])
        begin[of] = np.cumsum(size[of]) - size[of]
        size[~plain] = np.fromiter(map(len, others), np.int64, len(others)) // width
        begin[~plain] = len(place) + np.cumsum(size[~plain]) - size[~plain]
        return table, begin.astype(np.int32), size.astype(np.int32)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of whole texts; each distinct word of the batch is looked up once."""
        flat, counts = word_lists(texts, lower=False)
        if not len(flat):
            return [np.zeros(0, self.kind)] * len(texts)
        enc = flat.dictionary_encode()
        codes = enc.indices.to_numpy(zero_copy_only=False)
        table, begin, size = self.spell(enc.dictionary)
        del flat, enc
        out, at = [], 0
        for block in np.array_split(counts, max(1, len(codes) // 200_000)):
            words = codes[at:at + int(block.sum())]
            at += len(words)
            sizes = size[words]
            ends = np.cumsum(sizes, dtype=np.int32)
            total = int(ends[-1]) if len(ends) else 0
            place = np.repeat(begin[words] - (ends - sizes), sizes) + np.arange(total, dtype=np.int32)
            out += np.split(table[place], np.concatenate(([0], ends))[np.cumsum(block)][:-1]) if len(block) else []
        return out


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "seed_score double")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined to about ``GATHER_BYTES``: more repeated words in each."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= GATHER_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def cut_texts(path: str, end_id: int, window: int):
    """Full windows (without their ids) and the rest of every text (with its ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        end = np.array([end_id], t.kind)
        for b in gathered(batches):
            out: list[list] = [[] for _ in range(6)]
            for doc_id, ids in zip(b.column(0).to_pylist(), t.encode(b.column(1))):
                ids = np.concatenate((ids, end))
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    full = len(piece) == window
                    row = (doc_id, start, len(piece), crc(piece) if full else None, len(ids), None if full else piece.tobytes())
                    for col, x in zip(out, row):
                        col.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out[:5]] + [pa.array(out[5], pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return run


class Corpus:
    """Document frequency of every term, number and mean length of all items."""

    def __init__(self, df: np.ndarray, n: int, tokens: int):
        self.df, self.n, self.mean = df, n, max(tokens / max(n, 1), 1)
        self.idf = np.log(1 + (n - df + 0.5) / (df + 0.5))

    @classmethod
    def of(cls, items: list[np.ndarray]) -> Corpus:
        df = np.zeros(1 + max((int(x.max()) for x in items if len(x)), default=0), np.int64)
        for x in items:
            df[np.unique(x)] += 1
        return cls(df, len(items), sum(map(len, items)))

    def weights(self, terms: np.ndarray, tf: np.ndarray, lengths) -> np.ndarray:
        return self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths / self.mean))

    def route(self, ids: np.ndarray) -> bytes:
        """The item's heaviest terms that another item holds too, heaviest first, four bytes each."""
        terms, tf = np.unique(ids, return_counts=True)
        keep = self.df[terms] > 1
        terms, tf = terms[keep], tf[keep]
        w = np.round(self.weights(terms, tf, len(ids)), 9)
        if len(terms) > ROUTE_TERMS:  # ties of the last one stay
            top = w >= np.partition(w, -ROUTE_TERMS)[-ROUTE_TERMS]
            terms, w = terms[top], w[top]
        return terms[np.lexsort((terms, -w))][:ROUTE_TERMS].astype(">u4").tobytes()


def count_terms(kind: str, size: int):
    """(term, items that hold it) of a task; -1: all items, -2: their tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, tokens = np.zeros(size, np.int64), 0, 0
        for b in batches:
            for x in b.column(0).to_pylist():
                ids = np.frombuffer(x, kind)
                held = np.zeros(size, bool)
                held[ids] = True
                df += held
                n, tokens = n + 1, tokens + len(ids)
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *terms.tolist()], pa.int64()), pa.array([n, tokens, *df[terms].tolist()], pa.int64())],
                                         names=["term", "n"])

    return run


def corpus_of(items: DataFrame, kind: str, size: int) -> Corpus:
    """Statistics of the column ``ids``; the driver sees a number for each entry of the vocabulary."""
    df, total = np.zeros(size, np.int64), {-1: 0, -2: 0}
    for term, n in items.select("ids").mapInArrow(count_terms(kind, size), "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        if term < 0:
            total[term] = n
        else:
            df[term] = n
    return Corpus(df, total[-1], total[-2])


ROUTED = PIECES + ", route binary, tie long, shard int"


def route_items(sent, kind: str, shards: int, bounds, every: int = 1):
    """Pieces with their route and shard; of ``every`` items one (by hash), full windows by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, cuts = sent.value, bounds.value if bounds else []
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                tie = hash((row[0] or 0, row[1], row[4], row[3] if row[5] is None else zlib.crc32(row[5])))
                if row[5] is None:
                    out.append((*row, b"", tie, tie % shards))
                elif tie % every == 0:
                    key = (corpus.route(np.frombuffer(row[5], kind)), tie)
                    out.append((*row, *key, bisect.bisect_right(cuts, key)))
            cols = list(zip(*out)) or [()] * 9
            types = [pa.int64()] * 5 + [pa.binary(), pa.binary(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split(" ")[0] for x in ROUTED.split(", ")])

    return run


class Index:
    """BM25 index over one shard's items, with the corpus's statistics."""

    def __init__(self, items: list[np.ndarray], corpus: Corpus | None = None):
        self.n = len(items)
        corpus = corpus or Corpus.of(items)
        lengths = np.array([len(x) for x in items])
        owner = np.repeat(np.arange(self.n, dtype=np.int64), lengths)
        key, tf = np.unique(np.concatenate(items).astype(np.int64) + (owner << 32), return_counts=True)
        item, term = key >> 32, key & 0xFFFFFFFF
        terms, place, df = np.unique(term, return_inverse=True, return_counts=True)
        weight = corpus.weights(term, tf, lengths[item])
        keep = df[place] > 1  # terms of one item find nothing
        item, place, weight = item[keep], place[keep], weight[keep]
        self.begin = np.searchsorted(item, np.arange(self.n + 1))
        self.place, self.n_terms = place, len(terms)
        self.live = (item, place, weight)
        self.room = np.empty(len(place))
        self.cut_live(np.ones(self.n, bool))

    def cut_live(self, free: np.ndarray) -> None:
        """Keep the postings of free items only."""
        item, place, weight = self.live
        keep = free[item]
        self.live = item, place, weight = item[keep], place[keep], weight[keep]
        self.first = np.flatnonzero(np.diff(item, prepend=-1))
        self.owner, self.left = item[self.first], int(free.sum())

    def neighbours(self, seed: int, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Free items that share terms with the seed, best first, with their scores over all of them."""
        if free.sum() < 0.7 * self.left:
            self.cut_live(free)
        scores = np.zeros(self.n)
        if len(self.first):
            query = np.zeros(self.n_terms)
            query[self.place[self.begin[seed]:self.begin[seed + 1]]] = 1
            _, place, weight = self.live
            met = np.take(query, place, out=self.room[:len(place)], mode="clip")
            scores[self.owner] = np.add.reduceat(np.multiply(weight, met, out=met), self.first)
        scores[~free] = 0
        found = np.flatnonzero(scores)
        order = np.argsort(-scores[found], kind="stable")
        return found[order], scores[found][order]


def pack_shard(ids: list[np.ndarray], window: int, corpus: Corpus | None = None) -> list[tuple[int, int, int, int, int, float]]:
    """(item, its ids before the piece, length, sequence, offset, BM25 score) of every piece."""
    n = len(ids)
    index = Index(ids, corpus)
    begin = np.zeros(n, np.int64)
    left = np.array([len(x) for x in ids], np.int64)
    free = left > 0
    out, sequence = [], 0
    order = np.argsort(-left, kind="stable")
    pos = 0

    def place(i: int, size: int, at: int, score: float) -> int:
        out.append((i, int(begin[i]), size, sequence, at, score))
        begin[i] += size
        left[i] -= size
        free[i] = left[i] > 0
        return at + size

    while True:
        while pos < n and not free[order[pos]]:
            pos += 1
        if pos == n:
            break
        seed = int(order[pos])
        at = place(seed, int(min(left[seed], window)), 0, 0.0)
        found, scores = index.neighbours(seed, free) if at < window else (np.zeros(0, np.int64), np.zeros(0))
        sizes, next_one = left[found], 0  # neighbours are free; each is met once, best first
        while at < window and next_one < len(sizes):
            fitting = sizes[next_one:] <= window - at
            step = int(fitting.argmax())
            if not fitting[step]:
                break
            k = next_one + step
            at, next_one = place(int(found[k]), int(sizes[k]), at, float(scores[k])), k + 1
        while at < window:
            fits = np.flatnonzero(free & (left <= window - at))
            if len(fits):
                i = int(fits[np.argmax(left[fits])])
                at = place(i, int(left[i]), at, 0.0)
                continue
            near = found[free[found]][:1] if free[found].any() else np.flatnonzero(free)[:1]
            if not len(near):
                break
            at = place(int(near[0]), window - at, at, 0.0)
        sequence += 1
    return split_last(out, window)


def split_last(pieces: list[tuple], window: int) -> list[tuple]:
    """The last sequence, if short, as sequences whose lengths are powers of two."""
    if not pieces:
        return pieces
    last = pieces[-1][3]
    tail = [p for p in pieces if p[3] == last]
    rest = sum(p[2] for p in tail)
    if rest == window:
        return pieces
    out = [p for p in pieces if p[3] != last]
    sequence, at, room = last, 0, 1 << (rest.bit_length() - 1)
    for item, start, size, _, _, score in tail:
        while size:
            take = min(size, room - at)
            out.append((item, start, take, sequence, at, score))
            start, size, at, rest = start + take, size - take, at + take, rest - take
            if at == room and rest:
                sequence, at, room = sequence + 1, 0, 1 << (rest.bit_length() - 1)
    return out


def pack_shards(sent, kind: str, window: int, shard_items: int):
    """Pack a partition's pieces, ``shard_items`` items at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        items: list[tuple] = []

        def rows_of(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.float64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "seed_score"])

        def shard():
            nonlocal sequence, items
            ids = [np.frombuffer(x[5], kind) for x in items]
            rows = []
            for i, start, size, seq, at, score in pack_shard(ids, window, sent.value):
                doc_id, first, _, _, total, _ = items[i]
                rows.append((doc_id, first + start, size, crc(ids[i][start:start + size]), total, sequence + seq, at, score))
            sequence = max(r[5] for r in rows) + 1
            items = []
            return rows_of(rows)

        for b in batches:
            full = []
            for row in zip(*(b.column(i).to_pylist() for i in range(6))):
                if row[5] is None:
                    full.append((*row[:5], sequence, 0, 0.0))
                    sequence += 1
                else:
                    items.append(row)
                    if len(items) >= shard_items:
                        yield shard()
            if full:
                yield rows_of(full)
        if items:
            yield shard()

    return run


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, shard_items: int = SHARD_ITEMS,
         least_shards: int = 8) -> DataFrame:
    """Pieces of every row's ids in sequences of at most ``window``."""
    spark, t = docs.sparkSession, tokenizer(path)
    kind, size = str(t.kind.str), max(t.t.get_vocab_size(), end_id + 1)
    pieces = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut_texts(path, end_id, window), PIECES))
    items = pieces.filter("ids is not null")
    corpus = corpus_of(items, kind, size)
    sent = spark.sparkContext.broadcast(corpus)
    shards = max(least_shards, -(-corpus.n // shard_items))
    # a bounded sample chooses where the order of routes is cut
    sample = items.mapInArrow(route_items(sent, kind, shards, None, max(1, corpus.n // (BOUND_SAMPLE * shards))), ROUTED)
    keys = sorted((bytes(r.route), r.tie) for r in sample.select("route", "tie").collect())
    bounds = spark.sparkContext.broadcast([keys[len(keys) * k // shards] for k in range(1, shards)] if keys else [])
    dealt = (pieces.mapInArrow(route_items(sent, kind, shards, bounds), ROUTED).repartitionById(shards, "shard")
             .sortWithinPartitions("route", "tie", "doc_id", "start", "doc_tokens"))
    return dealt.select(*[x.split(" ")[0] for x in PIECES.split(", ")]).mapInArrow(pack_shards(sent, kind, window, shard_items), PACKED)
