"""One query for each operator of this subpackage, and SQL where SQL can express it."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.llm import (bpe, chat, collocations, exact_dedup, jaccard, katz, langid, mainpage, packing, paragraphs, periodic,
                           secrets, topk)
from reelhouse.llm.util import id_bucket, prepare, read_table

#: Vocabulary files; a parameter of the operators.
BYTE_VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(read_table(prepare(spark), sf_dir, "documents"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(prepare(spark), sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(prepare(spark), sf_dir, "conversations")
    return chat.parse_transcripts(conversations, id_bucket(F.col("conv_id"), 5) != 0)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(prepare(spark), sf_dir, "documents"), keep="largest")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(read_table(prepare(spark), sf_dir, "documents"), id_bucket(F.col("doc_id"), 7) == 2)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(prepare(spark), sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read_table(prepare(spark), sf_dir, "documents"), vocabulary(BYTE_VOCABULARY))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(read_table(prepare(spark), sf_dir, "documents"), id_bucket(F.col("doc_id"), 3) == 1)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(prepare(spark), sf_dir, "documents"), vocabulary(WORD_VOCABULARY))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_table(prepare(spark), sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(prepare(spark), sf_dir, "documents"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainpage.extract(read_table(prepare(spark), sf_dir, "pages").select("page_id", "url", "html"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.with_repeats(read_table(prepare(spark), sf_dir, "documents")))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_substring_dedup, op2_exact_top_k, op3_chat_format, op4_exact_dedup, op5_lm_scores, op6_jaccard_join,
             op7_bpe, op8_language_id, op9_packing, op10_secret_scans, op11_collocations, op12_html_extraction, op13_periodic_runs)
    return {f.__name__: f for f in found}


LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

ORACLE = {
    "op2_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op4_exact_dedup": f"""
        WITH t AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op6_jaccard_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        sh AS (
            SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS g
            FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        l AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * i >= 80 * (x.n + y.n - i)),
        reach(doc_id, other) AS (
            SELECT a, b FROM l UNION SELECT r.doc_id, l.b FROM reach r JOIN l ON r.other = l.a),
        c AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
               least(d.doc_id, coalesce(c.least, d.doc_id)) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)""",
    "op11_collocations": f"""
        WITH piece AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS x FROM documents),
        w AS (SELECT lang, list_filter(regexp_split_to_array(x, '[\\x20\\x09]+'), lambda y: y <> '') AS ws FROM piece),
        g AS (
            SELECT lang, k, array_to_string(p, ' ') AS phrase, p, count(*) AS f
            FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS p
                  FROM w, (SELECT unnest([1, 2, 3]) AS k))
            GROUP BY lang, k, p),
        t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
        u AS (SELECT * FROM g WHERE f >= 10),
        c AS (
            SELECT u.lang, u.k, u.p, u.phrase, u.f AS a, x.f AS l, y.f AS r,
                   (1000000::HUGEINT * u.f * u.f) // (x.f::HUGEINT * y.f) AS score, x.k AS j
            FROM u JOIN u x ON x.lang = u.lang AND x.k < u.k AND x.p = u.p[1:x.k]
                   JOIN u y ON y.lang = u.lang AND y.k = u.k - x.k AND y.p = u.p[x.k + 1:]
            WHERE u.k > 1 QUALIFY row_number() OVER (PARTITION BY u.lang, u.p ORDER BY score, x.k) = 1),
        part AS (
            SELECT lang, p, max(f) AS most
            FROM (SELECT lang, p[1:2] AS p, f FROM u WHERE k = 3 UNION ALL SELECT lang, p[2:3], f FROM u WHERE k = 3)
            GROUP BY lang, p)
        SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank,
               c.phrase, c.a, c.l, c.r, t.n, CAST(c.score AS BIGINT) AS score
        FROM c JOIN t USING (lang) LEFT JOIN part ON part.lang = c.lang AND part.p = c.p
        WHERE c.k > 2 OR part.most IS NULL OR 100 * part.most < 50 * c.a
        QUALIFY rank <= 2000""",
}


def oracle_queries() -> dict[str, str]:
    return dict(ORACLE)
