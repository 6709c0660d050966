"""Phrase collocations against a plain count, tiles against a Counter, and the contract's edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from reelhouse.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=10, longest=3, top=2000, cover=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        longer = [b for (other, q), b in f.items() if other == lang and len(q) > len(p) and b >= least
                  and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= cover * a for b in longer):
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        found.append((lang, -score, -a, " ".join(p).encode(), l, r))
    out, rank = [], Counter()
    for lang, s, a, p, l, r in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], p.decode(), -a, l, r, n[lang], -s))
    return out


def texts(seed, n, vocabulary):
    r = random.Random(seed)
    fixed = [" ".join(r.choices(vocabulary, k=3)) for _ in range(4)]
    rows = []
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.3 else r.choice(vocabulary) + r.choice(["", ",", ". ", "\t", "\n", "  "]) for _ in range(r.randint(0, 40))]
        rows.append((r.choice([str.upper, str, str.title])(" ".join(parts)), r.choice(["en", "de", None])))
    return rows


def run(docs, rows, **args):
    got = C.collocations(docs([(i, *r) for i, r in enumerate(rows)]), **args).select(*COLUMNS).collect()
    return sorted((tuple(r) for r in got), key=lambda x: x[:2])


@pytest.mark.parametrize("seed,args", [(1, {}), (2, {"longest": 4, "least": 5, "top": 7}), (3, {"longest": 2})])
def test_equals_a_plain_count(docs, seed, args):
    rows = texts(seed, 150, ["a", "bb", "é", "ß", "C", "don't", "x-y", "Ünique", "\x00z", "a" * 300])
    rows += [(None, "en"), ("", None), ("  ", "en"), rows[0], rows[0]]
    exp = plain(rows, **args)
    assert exp and run(docs, rows, **args) == exp


def test_ids_beyond_the_head_and_sparse_tiles(docs, monkeypatch):
    rows = texts(5, 120, [f"w{i}" for i in range(12)])
    for name, value in (("HEAD", 3), ("SIDE", 2), ("BLOCK_BYTES", 500)):
        monkeypatch.setattr(C, name, value)
    assert run(docs, rows) == plain(rows)


def test_tiles_equal_a_counter():
    r = np.random.default_rng(1)
    a, b = (r.zipf(1.3, 20_000) - 1 for _ in range(2))
    a, b = np.minimum(a, 5000), np.minimum(b, 7000)
    for side, dense in ((256, 16), (16, 1), (64, 10**9)):
        x, y, n = C.tile_counts(a, b, side, dense)
        assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == Counter(zip(a.tolist(), b.tolist())) and len(x) == len(set(zip(x.tolist(), y.tolist())))


def test_scores_past_64_bits(llm):
    a, l, r = 3 * 10**12 + 1, 5 * 10**12 + 7, 4 * 10**12 + 9
    got = llm.createDataFrame([(a, l, r)], "a long, l long, r long").select(C.exact_score(*(C.F.col(c) for c in "alr"))).first()[0]
    assert got == 1_000_000 * a * a // (l * r)


def test_pieces_overlaps_and_long_words(docs):
    long = "y" * 200_000
    rows = [("go go go", "en")] * 6 + [(f"{long} end; go. go", "en")] * 10
    got = {r[2]: r for r in run(docs, rows)}
    assert got[f"{long} end"][3:6] == (10, 10, 10) and got["go go"][3:6] == (12, 38, 38)
    assert "end go" not in got and run(docs, [("a b", "en")] * 9) == []


def test_empty_table_and_clashing_columns(docs, llm):
    assert run(docs, []) == []
    rows = [(i, "go on", "en") for i in range(10)]
    clash = docs(rows).selectExpr("*", "1 AS sig", "2 AS c", "'x' AS phrase", "3 AS f", "4 AS `rank`")
    assert [tuple(r) for r in C.collocations(clash).select(*COLUMNS).collect()] == [("en", 1, "go on", 10, 10, 10, 20, 1_000_000)]
