"""BPE encoding and decoding with content-defined chunk reuse (operator 7).

A rolling hash over the text's bytes proposes chunk ends, which move on to the
next place where a word ends and ASCII white space begins.  A chunk that many
documents share is encoded and decoded once per worker and reused.  Where two
chunks meet, the last word of one and the first of the next are encoded
together; if the ids differ from the chunks' own, the chunks are merged and
encoded again, until they agree.

Chunks are shared inside a Python worker (its cache holds ``CACHE_BYTES`` at
most and outlives tasks).  A table of all chunks, joined back, would shuffle
every text and every id once more.

Edge cases: a null text counts as empty (no ids, empty decoded text).  Special
strings in a text become their ids, as in the tokenizers library.  Texts without
a chunk end are one chunk.  Repeated rows give equal rows.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reelhouse.llm.util import add_columns

MASK = np.uint32((1 << 9) - 1)  # mean chunk: about 512 bytes
CACHE_BYTES = 96 * 1024 * 1024
#: The byte-level pre-tokenizer's pattern (fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_table() -> dict[str, int]:
    """Printable stand-in of each byte in a byte-level vocabulary -> the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """A byte-level BPE vocabulary of the tokenizers library, encoded chunk by chunk."""

    def __init__(self, path: str):
        import tiktoken

        spec = json.load(open(path, encoding="utf-8"))
        table, vocab = byte_table(), spec["model"]["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(table[c] for c in t): i for t, i in vocab.items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges)) or spec.get("normalizer"):
            raise ValueError(f"{path}: ids don't follow the order of the merges")
        self.encoding = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.bytes_of = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in special.items()}
        self.text_of = [str(i) for i in range(max(self.bytes_of) + 1)]
        self.cache: dict[bytes, tuple] = {}
        self.cached = 0
        self.reused = self.encoded = self.repaired = 0

    def ids(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special="all")

    def record(self, chunk: bytes) -> tuple:
        """(ids as text, their number, decoded bytes, first word, its ids, last word, its ids)."""
        got = self.cache.get(chunk)
        if got is not None:
            self.reused += 1
            return got
        self.encoded += 1
        ids = self.ids(chunk.decode())
        decoded = b"".join([self.bytes_of[i] for i in ids])
        head, tail = edges(chunk)
        h, t = self.ids(head.decode()), self.ids(tail.decode())
        names = self.text_of
        got = (",".join([names[i] for i in ids]), len(ids), decoded, head, h, tail, t, ids[:len(h)] == h and ids[-len(t):] == t)
        if self.cached > CACHE_BYTES:
            self.cache.clear()
            self.cached = 0
        self.cache[chunk] = got
        self.cached += 4 * len(chunk) + 600
        return got

    def agree(self, a: tuple, b: tuple) -> bool:
        """True if the ids around the join of two chunks are those of the whole text."""
        return a[7] and b[7] and self.ids((a[5] + b[3]).decode()) == a[6] + b[4]

    def encode(self, text: str) -> list[tuple]:
        """Records of the text's chunks, joins repaired."""
        data = text.encode()
        out: list[tuple] = []
        chunks: list[bytes] = []
        for chunk in chunks_of(data):
            rec = self.record(chunk)
            while out and not self.agree(out[-1], rec):
                self.repaired += 1
                chunk = chunks.pop() + chunk
                out.pop()
                rec = self.record(chunk)
            out.append(rec)
            chunks.append(chunk)
        return out


GRAPH = np.zeros(256, bool)
GRAPH[33:127] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def chunks_of(data: bytes) -> list[bytes]:
    """Content-defined chunks of UTF-8 bytes; each ends where a word ends before ASCII white space."""
    if len(data) < 64:
        return [data] if data else []
    b = np.frombuffer(data, np.uint8)
    h, m = b.astype(np.uint32), 0x01000193
    for step in (1, 2, 4, 8):  # hash of the 16 bytes that end here
        grown = h.copy()
        grown[step:] += h[:-step] * np.uint32(pow(m, step, 1 << 32))
        h = grown
    hits = np.flatnonzero(((h ^ (h >> np.uint32(15))) & MASK) == 0)
    if not len(hits):
        return [data]
    safe = np.flatnonzero(GRAPH[b[:-1]] & SPACE[b[1:]]) + 1
    at = np.searchsorted(safe, hits + 1)
    ends = np.unique(safe[at[at < len(safe)]]).tolist()
    return [data[i:j] for i, j in zip([0, *ends], [*ends, len(data)])]


def edges(chunk: bytes) -> tuple[bytes, bytes]:
    """First and last stretch of the chunk that a safe boundary closes."""
    lead = len(chunk) - len(chunk.lstrip(b" \t\n\r\x0b\x0c"))
    cuts = [i for i in (chunk.find(c, lead) for c in (b" ", b"\n", b"\t", b"\r")) if i > 0 and GRAPH[chunk[i - 1]]]
    head = chunk[:min(cuts)] if cuts else chunk
    last = max(chunk.rfind(c) for c in (b" ", b"\n", b"\t", b"\r"))
    while last > 0 and SPACE[chunk[last - 1]]:
        last -= 1
    tail = chunk[last:] if last > 0 and GRAPH[chunk[last - 1]] else chunk
    return head, tail


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""

    def run(b: pa.RecordBatch) -> list:
        t = tokenizer(path)
        n, ids, dec = [], [], []
        for text in b.column(b.schema.get_field_index("text")).to_pylist():
            records = t.encode(text or "")
            n.append(sum(r[1] for r in records))
            ids.append(hashlib.sha256(",".join([r[0] for r in records]).encode()).hexdigest())
            whole = b"".join([r[2] for r in records]).decode("utf-8", "replace")
            dec.append(hashlib.sha256(whole.encode()).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(dec, pa.string())]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return add_columns(docs.select("doc_id", "text"), run, fields, drop=("text",))
