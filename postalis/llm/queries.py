"""The registered queries of the operators in this subpackage, one a numbered operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.llm.common import fold, read


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm import langid

    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold("doc_id", 3) != 1))
    return langid.predict(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from postalis.llm.packing import pack

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm.topk import top_k

    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm.licenses import scan

    return scan(read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm.quality import judge

    return judge(read(spark, sf_dir, "documents")).drop("clean_text")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from postalis.llm.lattice import score

    docs = read(spark, sf_dir, "documents")
    return score(docs, public_tokenizers.path("piece_bpe_32k.model"), held_out=fold("doc_id", 7) == 2)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm.mixing import mix

    return mix(read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm.jaccard import classes

    return classes(read(spark, sf_dir, "documents"))


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm.toolchat import as_tool_chat, link_tool_calls

    rows = [(tool, name, kind, True) for tool, names in {"ask": {"prompt": "string", "turn": "integer"}, "follow_up": {"after": "integer", "prompt": "string", "turn": "integer"}}.items() for name, kind in names.items()]
    schemas = spark.createDataFrame(rows, "tool string, argument string, type string, required boolean")
    return link_tool_calls(as_tool_chat(read(spark, sf_dir, "conversations")), schemas).drop("place")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm import htmltext

    pages = read(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.fit(pages))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from postalis.llm.alignment import token_alignment

    return token_alignment(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm import toxicity

    docs = read(spark, sf_dir, "documents")
    field = toxicity.fit(docs, read(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    return toxicity.score(docs, field).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "n_spans", "spans")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm.search import search

    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalis.llm.stages import run

    return run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_best_fit_packing, op3_exact_top_k, op4_license_scan, op5_quality_rules, op6_lm_scoring, op7_source_mixing, op8_jaccard_join, op9_tool_calls, op10_html_text, op11_token_alignment, op12_toxicity, op13_ranked_search, pipeline)}

ORACLE_SQL = {
    "op3_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op9_tool_calls": """
        WITH u AS (SELECT conv_id, turn, text, conv_id % 7 AS f, CASE WHEN turn >= 2 THEN turn - 2 WHEN turn = 0 AND conv_id % 7 = 4 THEN 2 END AS up FROM conversations WHERE role = 'user' AND text IS NOT NULL),
        a AS (SELECT conv_id, turn - 1 AS turn, CASE WHEN conv_id % 7 = 5 THEN turn - 2 ELSE turn END AS said, text FROM conversations WHERE role = 'assistant' AND text IS NOT NULL),
        deep AS (WITH RECURSIVE d AS (
                   SELECT conv_id, turn, 0::BIGINT AS depth FROM u x WHERE up IS NULL OR NOT EXISTS (SELECT 1 FROM u y WHERE y.conv_id = x.conv_id AND y.turn = x.up)
                   UNION ALL SELECT u.conv_id, u.turn, d.depth + 1 FROM d JOIN u ON u.conv_id = d.conv_id AND u.up = d.turn)
                 SELECT * FROM d),
        j AS (SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.turn, a.turn) AS t, u.turn, u.f, u.up, u.text AS prompt, a.text AS answer, deep.depth, a.said
              FROM u FULL JOIN a ON u.conv_id = a.conv_id AND u.turn = a.turn LEFT JOIN deep ON deep.conv_id = u.conv_id AND deep.turn = u.turn),
        k AS (SELECT *, 'c' || conv_id || '-' || t AS call_id, CASE WHEN turn IS NULL THEN NULL WHEN turn < 2 THEN 'ask' ELSE 'follow_up' END AS tool,
                     CASE f WHEN 1 THEN 'type turn' WHEN 2 THEN 'missing prompt' WHEN 3 THEN 'unknown mood' ELSE '' END AS errors,
                     CASE WHEN turn IS NULL THEN 'orphan' WHEN f = 6 THEN 'repeated' WHEN depth IS NULL THEN 'cyclic' WHEN said IS NULL THEN 'unanswered' WHEN said <= turn THEN 'early' ELSE 'linked' END AS status FROM j)
        SELECT conv_id, call_id, tool, turn, depth, status, coalesce(errors, '') AS errors,
          '{"arguments":' || CASE WHEN turn IS NULL THEN 'null' ELSE '{' || CASE WHEN turn >= 2 THEN '"after":' || (turn - 2) || ',' ELSE '' END || CASE WHEN f = 3 THEN '"mood":"calm",' ELSE '' END || CASE WHEN f = 2 THEN '' ELSE '"prompt":' || to_json(prompt)::VARCHAR || ',' END
            || '"turn":' || CASE WHEN f = 1 THEN '"' || turn || '"' ELSE turn::VARCHAR END || '}' END
          || ',"call_id":"' || call_id || '","conversation":' || conv_id || ',"depth":' || coalesce(depth::VARCHAR, 'null') || ',"errors":[' || CASE WHEN coalesce(errors, '') = '' THEN '' ELSE '"' || errors || '"' END || '],"parent_id":'
          || CASE WHEN up IS NOT NULL THEN '"c' || conv_id || '-' || up || '"' ELSE 'null' END || ',"result":' || coalesce(to_json(answer)::VARCHAR, 'null')
          || ',"status":"' || status || '","tool":' || coalesce('"' || tool || '"', 'null') || ',"turn":' || coalesce(turn::VARCHAR, 'null') || '}' AS record
        FROM k""",
    "op13_ranked_search": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
        i AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
        q AS (SELECT i, item_id, term, count(*) AS n FROM (SELECT i, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
        a AS (SELECT count(*) FILTER (len(t) > 0) AS docs, sum(len(t))::BIGINT AS words FROM d),
        p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, a GROUP BY term, docs),
        s AS (SELECT q.i, q.item_id, d.doc_id, d.r, sum(q.n * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * len(d.t) * a.docs) // a.words))))::BIGINT AS score
              FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (r), a GROUP BY ALL)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 10""",
}
