"""Jaccard join: rows of one id with different texts, null ids, regions of unlike sets, tasks and rounds against brute force."""

import random
import re

import pytest

from reelhouse.llm import jaccard, setjoin

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, set size, component_id) of each row, and its component's number."""
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and comp[i] != comp[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                comp = [comp[j] if c == comp[i] else c for c in comp]
    least = {}
    for (d, _), c in zip(rows, comp):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    return [(d, len(s), least.get(c, d) if s else d) for (d, _), s, c in zip(rows, sets, comp)], comp


def words_of(r, n, vocabulary=5000):
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def near(r, words, edits):
    w = list(words)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return w


def corpus(seed):
    """Near copies, and unlike texts that share passages: they meet in cells without a link."""
    r = random.Random(seed)
    passages = [words_of(r, 12) for _ in range(3)]
    rows, d = [], 0
    for g in range(8):
        base = words_of(r, r.randint(40, 150))
        for i in range(r.randint(1, 9)):
            w = near(r, base, i % 5)
            if r.random() < 0.5:
                at = r.randrange(len(w))
                w[at:at] = r.choice(passages)
            rows.append((d, " ".join(w)))
            d += 1
    for _ in range(40):
        rows.append((d, " ".join(words_of(r, 20) + r.choice(passages) + r.choice(passages) + words_of(r, 10))))
        d += 1
    return rows + [(d, None), (d + 1, " \n "), (d + 2, "Two Words"), (d + 3, "two words"), (d + 4, "x " * 4000)]


@pytest.mark.parametrize("seed,shingles_in_task", [(1, 1 << 25), (2, 600), (3, 3000)])
def test_tasks_and_rounds_equal_brute_force(docs, monkeypatch, seed, shingles_in_task):
    monkeypatch.setattr(setjoin, "REGION_SHINGLES", shingles_in_task)
    rows = corpus(seed)
    want, _ = brute(rows)
    got = sorted(tuple(x) for x in jaccard.jaccard_components(docs(rows)).collect())
    assert got == sorted(want)


def test_rows_of_one_id_keep_their_own_texts(docs):
    r = random.Random(5)
    a, b = words_of(r, 80), words_of(r, 80)
    filler = [(10 + i, " ".join(words_of(r, 30))) for i in range(1500)]
    rows = [(1, " ".join(a)), *filler, (1, " ".join(b)), (2000, " ".join(near(r, b, 1)))]
    got = {tuple(x) for x in jaccard.jaccard_components(docs(rows)).filter("doc_id in (1, 2000)").collect()}
    assert {c for _, _, c in got} == {1}
    assert got == {x for x in brute([rows[0], *rows[-2:]])[0]}


def test_drop_goes_by_id_and_text(docs):
    r = random.Random(6)
    b, other = words_of(r, 90), words_of(r, 70)
    rows = [(1, " ".join(b)), (2, " ".join(near(r, b, 1))), (None, " ".join(near(r, b, 2))), (2, " ".join(other)),
            (None, " ".join(words_of(r, 50))), (None, None), (3, ""), (7, "only five words are here"), (7, "only five words are here")]
    kept = jaccard.drop_near_copies(docs(rows))
    assert kept.columns == docs(rows).columns
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=key) == sorted([rows[0], *rows[3:]], key=key)
    assert jaccard.drop_near_copies(docs([])).count() == 0


def test_clashing_columns_are_kept(docs):
    clash = docs([(1, "a b c d e f"), (2, "a b c d e f")]).selectExpr("*", "1 AS th", "2 AS comp", "3 AS n", "4 AS sid")
    assert [tuple(x) for x in sorted(jaccard.jaccard_components(clash).collect())] == [(1, 2, 1), (2, 2, 1)]
    assert [(x.doc_id, x.th, x.comp, x.n, x.sid) for x in jaccard.drop_near_copies(clash).collect()] == [(1, 1, 2, 3, 4)]
