"""Queries of the training-data operators and, where DuckDB can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from qatlam.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function under ``name``; the operator's module is imported when the query runs."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


@query("p9_found")
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.leak import leaked

    return leaked(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("p1_statistics")
def p1_statistics(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.quality import records, text_quality

    return text_quality(records(table(spark, d, "results"), table(spark, d, "blocks")), table(spark, d, "common_words"))


@query("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.quality import records, text_quality

    texts = records(table(spark, d, "results"), table(spark, d, "blocks"))
    return text_quality(texts, table(spark, d, "common_words")).where("kind is not null").select("record", "record_id", "kind")


P2_KEY = "regexp_replace(lower(line), '[^\\p{L}]+|[ʻʼ]+', '', 'g')"
P2_SITE = "regexp_replace(lower(regexp_extract(url, '^\\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#\\s]+)', 1)), '^www\\.|\\.$', '')"
P2_PAGE = "regexp_replace(regexp_replace(regexp_replace(url, '^\\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#\\s]+', ''), '[?#].*$', ''), '/+\\s*$', '')"
P2_LINES = f"""
WITH p AS (SELECT page_id, {P2_SITE} AS site, {P2_PAGE} AS page FROM pages),
s AS (SELECT page_id, candidate_id, string_split(text, chr(10)) AS ls FROM candidates WHERE text IS NOT NULL),
l AS (SELECT page_id, candidate_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM s),
k AS (SELECT page_id, candidate_id, line_no, {P2_KEY} AS key, site, page FROM l JOIN p USING (page_id) WHERE site <> ''),
n AS (SELECT site, key, count(DISTINCT page) AS pages FROM k WHERE key <> '' GROUP BY site, key HAVING count(DISTINCT page) >= 5)
"""


@query("p2_found", P2_LINES + "SELECT page_id, candidate_id, CAST(line_no AS BIGINT) AS line_no FROM k JOIN n USING (site, key)")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The occurrences of the blocks' lines. A line without a neighbour is a block of its own, so its SQL needs no graph."""
    from qatlam.llm.sitelines import boilerplate

    return boilerplate(table(spark, d, "candidates"), table(spark, d, "pages"))[1].select("page_id", "candidate_id", "line_no")


@query("p2_blocks")
def p2_blocks(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.sitelines import block_report, boilerplate

    return block_report(boilerplate(table(spark, d, "candidates"), table(spark, d, "pages"))[1])


P2_TEXTS = P2_LINES + """, gone AS (SELECT page_id, candidate_id, line_no FROM k JOIN n USING (site, key)),
kept AS (SELECT l.page_id, l.candidate_id, l.line_no, l.line FROM l ANTI JOIN gone g ON l.page_id = g.page_id AND l.candidate_id = g.candidate_id AND l.line_no = g.line_no),
t AS (SELECT page_id, candidate_id, string_agg(line, chr(10) ORDER BY line_no) AS clean_text FROM kept GROUP BY page_id, candidate_id)
SELECT c.page_id, c.candidate_id, CASE WHEN c.text IS NULL THEN NULL ELSE coalesce(t.clean_text, '') END AS clean_text
FROM candidates c LEFT JOIN t ON c.page_id = t.page_id AND c.candidate_id = t.candidate_id"""


@query("p2_texts", P2_TEXTS)
def p2_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every occurrence of a block's line is deleted; each line of high support belongs to a block."""
    from qatlam.llm.sitelines import boilerplate, without_lines

    candidates = table(spark, d, "candidates")
    found = boilerplate(candidates, table(spark, d, "pages"))[1]
    return without_lines(candidates.select("page_id", "candidate_id", "text"), found).select("page_id", "candidate_id", "clean_text")


@query("p3_found")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.mainbody import page_furniture

    return page_furniture(table(spark, d, "candidates"), table(spark, d, "pages"))


@query("p3_body")
def p3_body(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate's text without its furniture lines."""
    from qatlam.llm.mainbody import page_furniture
    from qatlam.llm.sitelines import without_lines

    candidates = table(spark, d, "candidates").select("page_id", "candidate_id", "text")
    return without_lines(candidates, page_furniture(candidates, table(spark, d, "pages"))).select("page_id", "candidate_id", "clean_text")


@query("p10_found")
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.mojibake import found, garbled

    return found(garbled(table(spark, d, "documents")))


@query("p10_restored")
def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.mojibake import garbled, restored

    documents = table(spark, d, "documents")
    return restored(documents, garbled(documents))


def _through_history(spark: SparkSession, d: str, batch: str) -> DataFrame:
    from uuid import uuid4

    from qatlam.llm.history import batches
    from qatlam.runtime import ensure_checkpoint_dir

    rows = table(spark, d, "results").selectExpr("result_id AS id", "kept_text AS text", f"{batch} AS batch")
    return batches(rows, spark, f"{ensure_checkpoint_dir(spark)}/history-{uuid4().hex}")


@query("p7_found")
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The accepted history is added first, then all that arrived later."""
    return _through_history(spark, d, "least(batch_no, 1)")


@query("p7_batches")
def p7_batches(spark: SparkSession, d: str) -> DataFrame:
    """Each batch is matched against what was accepted before it came; the rows are those of p7_found."""
    return _through_history(spark, d, "batch_no")


@query("p6_segments")
def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.language import block_segments

    return block_segments(table(spark, d, "blocks"), table(spark, d, "language_results"))


@query("p6_found")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.language import relabelled

    return relabelled(table(spark, d, "blocks"), table(spark, d, "language_results"), table(spark, d, "common_words")).select("block_id", "lang")


@query("p5_found")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.ocr import Repaired

    return Repaired(table(spark, d, "ocr_pages")).findings()


@query("p5_text")
def p5_text(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.ocr import Repaired

    return Repaired(table(spark, d, "ocr_pages")).text()


@query("p4_document_tokens")
def p4_document_tokens(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.tokens import with_tokens

    return with_tokens(table(spark, d, "documents"), "doc_id")


@query("p4_documents")
def p4_documents(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.tokens import slice_tokens

    return slice_tokens(table(spark, d, "documents"))


@query(
    "p4_books",
    """
WITH now AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY coalesce(processed_at, TIMESTAMP '0001-01-01') DESC, book_id DESC) AS rn
                 FROM books WHERE path IS NOT NULL)
  WHERE rn = 1 AND dedup_status IS NULL),
t AS (SELECT coalesce(nullif(lower(trim(category)), ''), 'uncategorized') AS category, exact_tokens,
        coalesce(CASE WHEN exact_tokens >= 0 THEN exact_tokens END, CASE WHEN estimated_tokens >= 0 THEN estimated_tokens END,
                 CAST(round_even(CASE WHEN char_count >= 0 THEN char_count END / 4.0, 0) AS BIGINT), 0) AS tokens FROM now)
SELECT category, count(*) AS n_books, CAST(sum(tokens) AS BIGINT) AS n_tokens,
       CAST(coalesce(sum(CASE WHEN exact_tokens >= 0 THEN 1 END), 0) AS BIGINT) AS n_exact
FROM t GROUP BY category""",
)
def p4_books(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.tokens import ledger_tokens

    return ledger_tokens(table(spark, d, "books"))


@query("p8_packed")
def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.packing import packed

    return packed(table(spark, d, "documents"), table(spark, d, "containers"))


@query("p8_fill")
def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    from qatlam.llm.packing import fill, packed

    return fill(packed(table(spark, d, "documents"), table(spark, d, "containers")))
