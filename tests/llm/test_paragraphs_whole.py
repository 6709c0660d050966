"""Short repeated passages: a lone inner paragraph counts by the match that holds it."""

import random

from reelhouse.llm import paragraphs

N, WORDS = 600, 51


def fresh(r, n):
    return [f"w{r.randrange(10**9)}" for _ in range(n)]


def test_many_passages_of_51_words(docs):
    r = random.Random(5)
    rows, passages = [], {}
    for i in range(N):
        p = fresh(r, WORDS)
        for d in (i, N + i):
            passages[d] = set(p)
            rows.append((d, " ".join(fresh(r, 60) + p + fresh(r, 60))))
    texts = dict(rows)
    got = paragraphs.repeated_paragraphs(docs(rows)).collect()
    for x in got:
        words = texts[x.doc_id][x.start:x.end].split()  # near copies: words beside the passage may belong
        assert sum(w in passages[x.doc_id] for w in words) >= 0.75 * len(words)
        assert x.component_id == x.doc_id % N and x.n_copies == 2 and x.removed == (x.doc_id >= N)
    found = {x.doc_id for x in got}
    assert len(found) >= 2 * N - 4  # 5 in 100 were lost; a passage may hold no whole paragraph: 7 in 10,000
    assert all((d in found) == (d + N in found) for d in range(N))


def test_short_stock_lines_stay_and_any_two_copies_count(docs):
    r = random.Random(6)
    line, near, rows = fresh(r, 17), {}, []
    for d in range(40):  # 17 words in contexts of their own: no match of 20
        rows.append((d, " ".join(fresh(r, 60) + line + fresh(r, 60))))
    assert paragraphs.repeated_paragraphs(docs(rows)).count() == 0
    passage = fresh(r, 17) + line + fresh(r, 17)  # the line's owner, document 0, has none of the text around it
    both = rows + [(100 + k, " ".join(fresh(r, 60) + passage + fresh(r, 60))) for k in range(2)]
    got = paragraphs.repeated_paragraphs(docs(both)).collect()
    assert {x.doc_id for x in got} == {100, 101}
    assert {x.doc_id for x in paragraphs.repeated_paragraphs(docs(rows[:2]), run_words=17).collect()} <= {0, 1}


def test_whole_passages_are_covered_and_one_copy_of_every_word_stays(docs):
    r = random.Random(7)
    rows, passages = [], {}
    for size, base in ((30, 0), (51, 1000), (100, 2000)):
        for i in range(100):
            p = fresh(r, size)
            for k in range(3):
                doc = base + i + 300 * k
                passages[doc] = p
                rows.append((doc, " ".join(fresh(r, 40) + p + fresh(r, 40))))
    texts = dict(rows)
    table = docs(rows)
    spans = paragraphs.repeated_paragraphs(table).cache()
    share = {}
    for doc, p in passages.items():
        share.setdefault(len(p), {})[doc] = set()
    for x in spans.collect():
        words = texts[x.doc_id][x.start:x.end].split()
        inside = [w for w in words if w in passages[x.doc_id]]  # near copies: words beside the passage may belong
        assert x.n_words == len(words) and len(inside) >= 0.75 * len(words)
        assert x.start <= x.cut_start < x.cut_end <= x.end if x.removed else x.cut_start is None and x.cut_end is None
        share[len(passages[x.doc_id])][x.doc_id].update(inside)
    for size, docs_of in share.items():
        mean = sum(len(w) for w in docs_of.values()) / size / len(docs_of)
        # every eighth passage of 30 words has no boundary pair inside it that both copies share, so no paragraph to extend
        assert mean >= {30: 0.85, 51: 0.98, 100: 0.99}[size], (size, mean)
    left = {x.doc_id: set(x.text.split()) for x in paragraphs.remove_spans(table, spans).collect()}
    for doc, p in passages.items():
        if doc % 1000 < 300:
            assert left[doc] == set(texts[doc].split())
        gone = set(texts[doc].split()) - left[doc]  # near copies at both ends may hold words beside the passage
        assert len(gone - set(p)) <= 0.25 * len(gone)


def test_of_an_extension_that_two_of_three_share_one_copy_stays(docs):
    r = random.Random(8)
    core, tail, rows = fresh(r, 40), fresh(r, 6), []
    for doc in (1, 2, 3):  # documents 2 and 3 go on alike, the one that stays does not
        rows.append((doc, " ".join(fresh(r, 30) + core + (tail if doc > 1 else []) + fresh(r, 30))))
    rows += [(3, rows[2][1]), (None, None)]  # a repeated row, a null one
    texts = dict(rows)
    spans = paragraphs.repeated_paragraphs(docs(rows))
    got = spans.collect()
    last = {x.doc_id: x for x in sorted(got, key=lambda x: x.start)}
    assert texts[1][:last[1].end].split()[-1] == core[-1] and not last[1].removed
    for doc in (2, 3):
        assert texts[doc][:last[doc].end].split()[-1] == tail[-1] and last[doc].removed
    assert texts[2][:last[2].cut_end].split()[-1] == core[-1]  # document 2 keeps the tail
    assert last[3].cut_end == last[3].end
    cleaned = {x.doc_id: x.text.split() for x in paragraphs.remove_spans(docs(rows[:3]), spans).collect()}
    assert set(tail) <= set(cleaned[2]) and not set(tail) & set(cleaned[3]) and not set(core) & set(cleaned[3])
