"""Paragraph passes without work for each word or copy."""

import collections
import random

import pyarrow as pa

from reelhouse.llm import jaccard, paragraphs
from reelhouse.llm.setjoin import shared_cells
from reelhouse.llm.words import WORD, word_hashes, word_lists, word_spans

ODD = [None, "", " \n\t", "A", "x " * 300, "Ünïcode ΑΣ 你好 \x1c \x85 x", "\t\tlead é", "trail \x0b\x0c ", "a\x00b\U0001F600 c", "é"]


def test_word_spans_are_those_of_the_pattern():
    r = random.Random(3)
    texts = ODD + ["".join(r.choice("ab \n\té你\U0001F600 ") for _ in range(500)) for _ in range(20)]
    for t in (texts, [], [None], [""], ["", "b", ""]):
        start, end = word_spans(pa.array(t, pa.string()))
        assert list(zip(start.tolist(), end.tolist())) == [m.span() for x in t for m in WORD.finditer(x or "")]
    start, _ = word_spans(pa.array(["é é", *texts], pa.string()).slice(1))
    assert start.tolist() == [m.start() for x in texts for m in WORD.finditer(x or "")]


def test_word_hashes_do_not_depend_on_how_many_go_at_once(monkeypatch):
    from reelhouse.llm import words

    texts = pa.array(ODD + ["a b c a b " * 9])
    whole, counts = word_hashes(texts)
    monkeypatch.setattr(words, "WORDS_AT_ONCE", 7)
    few, again = word_hashes(texts)
    assert whole.tolist() == few.tolist() and counts.tolist() == again.tolist() and len(whole) == len(word_lists(texts)[0])


def test_copies_of_a_paragraph_are_one_member_of_a_cell(docs):
    r = random.Random(4)
    fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    passage = fresh(120)
    rows = [(d, " ".join(fresh(40) + passage + fresh(40))) for d in range(40)]
    sent = jaccard.text_rows(docs(rows)).repartition(4)
    bands, of_band = paragraphs.tune_bands(0.8, 0.995)
    cells = shared_cells(sent, paragraphs.band_keys(bands, of_band), 8).collect()
    alone = [n for n in collections.Counter(x.cell for x in cells).values() if n == 1]
    assert len(alone) >= 3 * bands  # the passage's inner paragraphs: it was one member for each task that has copies
    found = paragraphs.repeated_paragraphs(docs(rows))
    assert {x.doc_id for x in found.collect()} == set(range(40))
