"""The registered queries and the pipeline as the driver calls them, over the whole smallest tables."""

import re
from html import unescape

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from reelhouse.llm import queries
from test_periodic import digest  # beside this file
from tools.oracle_check import digest as rows_digest

CONTRACT = {
    "op2_exact_top_k": {"query_id", "rank", "vec_id", "score"},
    "op4_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op5_lm_scores": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op6_jaccard_join": {"doc_id", "n_shingles", "component_id"},
    "op7_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op9_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op10_secret_scans": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op11_collocations": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    "op12_html_extraction": {"page_id", "url", "text", "n_chars"},
    "op13_periodic_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
}


@pytest.mark.parametrize("name", sorted(queries.oracle_queries()))
def test_rows_equal_the_sql(llm, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    columns, want = [d[0] for d in res.description], res.fetchall()
    df = E.queries()[name](llm, sf_small)
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert rows_digest(list(df.columns), got) == rows_digest(columns, want)


@pytest.mark.parametrize("name", [n for n in sorted(CONTRACT) if n not in queries.oracle_queries()])
def test_columns_and_rows(llm, sf_small, name):
    df = E.queries()[name](llm, sf_small)
    assert CONTRACT[name] <= set(df.columns)
    table, key = ("pages", "page_id") if name.startswith("op12") else ("documents", "doc_id")
    want = {r[0] for r in llm.read.parquet(f"{sf_small}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in df.select(key).distinct().collect()} == want


def test_periodic_runs_of_the_table(llm, sf_small):
    docs = [(r.doc_id, r.text) for r in llm.read.parquet(f"{sf_small}/documents.parquet").collect() if len((r.text or "").split()) < 300]
    got = {r.doc_id: tuple(r) for r in E.queries()["op13_periodic_runs"](llm, sf_small).collect()}
    assert len(docs) > 50 and all(got[d] == digest(d, t) for d, t in docs)


def test_main_text_of_the_table(llm, sf_small):
    pages = {r.page_id: r.html for r in llm.read.parquet(f"{sf_small}/pages.parquet").collect()}
    for r in E.queries()["op12_html_extraction"](llm, sf_small).collect():
        article = re.search("<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        blocks = (" ".join(unescape(re.sub("</?b>", "", x).replace("<br>", " ")).split()) for x in re.split("</?(?:h1|p)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_pipeline_packs_whole_documents_it_kept(llm, sf_small):
    rows = corpus_pipeline.run(llm, sf_small).collect()
    docs = {r.doc_id for r in llm.read.parquet(f"{sf_small}/documents.parquet").select("doc_id").collect()}
    parts, sequences = {}, {}
    for r in rows:
        parts.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert 0 < len(parts) < len(docs) and set(parts) <= docs
    for pieces in list(parts.values()) + [[(o, n, None) for o, n in s] for s in sequences.values()]:
        at = 0
        for start, length, _ in sorted(pieces):
            assert start == at
            at += length
        assert pieces[0][2] in (None, at)
    assert all(sum(n for _, n in s) <= 2048 for s in sequences.values())
