"""Retrieval over the corpus: neighbours meet however many shards there are, and all seed terms count."""

import collections
import math
import random

import numpy as np
import pyarrow as pa

from reelhouse.llm import packing
from reelhouse.llm.queries import WORD_VOCABULARY, vocabulary

PAIRS = 400


def test_true_neighbours_meet_in_many_shards(docs):
    r = random.Random(4)
    rare = [f"{a}{b}" for a in ("zur", "kle", "vop", "mix", "dra", "tun") for b in ("bik", "gom", "fex", "lyn", "pra", "sut")]
    rows = []
    for i in range(PAIRS):  # pairs share words, all texts share some more
        own = [r.choice(rare) + str(r.randrange(10**6)) for _ in range(25)]
        for d in (i, PAIRS + i):
            words = own + ["the", "of", "and"] * 5
            r.shuffle(words)
            rows.append((d, " ".join(words)))
    got = packing.pack(docs(rows), vocabulary(WORD_VOCABULARY), window=512, shard_items=16).collect()
    held = collections.defaultdict(set)
    for x in got:
        held[x.doc_id].add(x.sequence_id >> 40)
    met = sum(bool(held[i] & held[PAIRS + i]) for i in range(PAIRS))
    assert len({s for x in held.values() for s in x}) >= 40
    assert met >= 0.8 * PAIRS, met  # by a hash of the id: about 2 in 100


def test_scores_are_bm25_over_all_terms_of_the_seed_and_the_corpus():
    r = np.random.default_rng(3)
    every = [r.integers(0, 300, int(r.integers(5, 200))).astype("<u2") for _ in range(120)]
    corpus = packing.Corpus.of(every)
    items = every[:40]
    index, free = packing.Index(items, corpus), np.ones(40, bool)
    free[[0, 7]] = False
    df = collections.Counter(t for x in every for t in set(x.tolist()))
    mean = sum(map(len, every)) / len(every)
    for seed in (0, 11):
        found, scores = index.neighbours(seed, free)
        want = {}
        for i in np.flatnonzero(free).tolist():
            tf = collections.Counter(items[i].tolist())
            s = sum(math.log(1 + (120 - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (packing.K1 + 1)
                    / (tf[t] + packing.K1 * (1 - packing.B + packing.B * len(items[i]) / mean))
                    for t in set(items[seed].tolist()) if tf[t] and sum(t in set(x.tolist()) for x in items) > 1)
            if s:
                want[i] = s
        assert set(found.tolist()) == set(want) and np.allclose(scores, [want[i] for i in found.tolist()])
        assert all(a >= b for a, b in zip(scores, scores[1:]))
        free[20:] = False


def test_latin_words_are_spelled_together_as_the_library_does():
    t = packing.WordTokenizer(vocabulary(WORD_VOCABULARY))
    r = random.Random(5)
    words = [chr(c) for c in range(33, 0x300) if c not in (0x85, 0xA0)] + [f"aB{chr(c)}'S" for c in range(33, 0x300)]
    words += ["".join(r.choice("abSt'dD1.,<|éÉß") for _ in range(r.randint(1, 9))) for _ in range(3000)] + ["日本語", "<|endoftext|>", "éa"]
    r.shuffle(words)
    texts = [" ".join(words[i:i + 50]) for i in range(0, len(words), 50)] + ["", None]
    alone, word = [], t.word
    t.word = lambda w: alone.append(w) or word(w)
    got = t.encode(pa.array(texts))
    assert [x.tolist() for x in got] == [t.t.encode(x or "", add_special_tokens=False).ids for x in texts]
    latin = [w for w in set(words) if max(w) < "ɐ" and "İ" not in w and "<|" not in w and not set(w) & set(map(chr, range(127, 161)))]
    assert len(latin) > 3000 and not set(alone) & {w.encode() for w in latin}  # before: each of them alone


def test_a_window_is_filled_by_the_neighbours_that_fit_best_first():
    r = np.random.default_rng(8)
    items = [r.integers(0, 40, int(r.integers(3, 20))).astype("<u2") for _ in range(200)]
    pieces = packing.pack_shard(items, 64)
    free, index = np.ones(len(items), bool), packing.Index(items)
    first = [p for p in pieces if p[3] == 0]
    seed = first[0][0]
    free[seed] = False
    room, want = 64 - len(items[seed]), []
    for i in index.neighbours(seed, free)[0]:
        if len(items[i]) <= room:
            want.append(int(i))
            room -= len(items[i])
    assert len(want) > 1 and [p[0] for p in first[1:1 + len(want)]] == want
