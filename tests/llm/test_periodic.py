"""Periodic runs against brute force, the planted tails and the digests."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from reelhouse.llm import periodic as P


def brute(w, least_words=6, powers=4):
    out = set()
    for q in range(1, len(w) // powers + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if i > s and n >= max(least_words, powers * q):
                smallest = next(p for p in range(1, q + 1) if all(w[j] == w[j + p] for j in range(s, s + n - p)))
                if smallest == q:
                    out.add((s, n, q))
            i += i == s
    return sorted(out)


def words_like(r):
    n, k = r.randint(0, 70), r.randint(1, 4)
    w = [f"w{r.randrange(k)}" for _ in range(n)]
    if n and r.random() < 0.6:
        a = r.randrange(n)
        p = r.randint(1, max(1, (n - a) // 3))
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("least_words,powers", [(6, 4), (1, 4), (20, 5)])
def test_runs_equal_brute_force(least_words, powers):
    r = random.Random(least_words)
    for _ in range(400):
        docs = [words_like(r) for _ in range(r.randint(1, 5))]
        codes = np.array([int(x[1:]) for w in docs for x in w], np.int64)
        base = np.cumsum([0] + [len(w) for w in docs])
        got = [tuple(x) for x in P.runs_of(codes, np.array([len(w) for w in docs]), least_words, powers).tolist()]
        assert got == [(s + b, n, q) for w, b in zip(docs, base) for s, n, q in brute(w, least_words, powers)]


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        P.runs_of(np.zeros(9, np.int64), np.array([9]), 6, 3)


def planted(doc_id, text):
    w, h = re.findall(r"[^\x20\x09-\x0D]+", text or ""), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def digest(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), collapse(w, runs))]
    return doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha


def test_query_rows_equal_brute_force(docs):
    r = random.Random(7)
    rows = [(i, r.choice([" ", "\n", "\t\x0b "]).join(words_like(r))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \n "), (None, "a b c d e f g h"), (5, rows[5][1]), (5, "Other text x x x x x x x"), (303, "a " * 3000),
             (304, "ü\xa0x " * 20), (305, "A a A a A a A a")]
    got = P.run_digests(P.with_repeats(docs(rows))).collect()
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert P.run_digests(docs(rows)).columns == columns
    key = lambda x: (x[0] is None, x[0] or 0, x[-1])
    assert sorted((tuple(x) for x in got), key=key) == sorted((digest(*x) for x in rows), key=key)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(300)) and any(x[1] > 1 for x in got)


def test_very_long_text(docs):
    r = random.Random(3)
    unit = [f"v{r.randrange(9000)}" for _ in range(30_000)]
    w = ["lead"] + unit * 5 + ["tail"]
    got = P.mark_runs(docs([(1, " ".join(w))])).first()
    assert [(x["start"], x["length"], x["period"]) for x in got["runs"]] == [(1, 150_000, 30_000)]
    assert got["collapsed"].split() == ["lead", *unit, "tail"]


def test_empty_table_and_clashing_columns(docs):
    assert P.run_digests(P.with_repeats(docs([]))).count() == 0
    clash = docs([(1, "x x x x x x y")]).selectExpr("*", "1 AS runs", "2 AS collapsed")
    row = P.mark_runs(clash).first().asDict()
    assert row["collapsed"] == "x y" and len(row["runs"]) == 1 and set(row) == {"doc_id", "lang", "source", "n_chars", "runs", "collapsed"}
