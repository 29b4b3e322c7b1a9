"""Queries over the test tables, one or more per core operator, with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qatlam import sql as S
from qatlam.functions import names as N
from qatlam.functions import quality as Q
from qatlam.functions import text as T
from qatlam.functions import urls as U
from qatlam.operators import crawl, dedup, ledger, ordered, spelling, web
from qatlam.plans import clean
from qatlam.runtime import table, widened
from qatlam.sinks import files
from qatlam.sources import catalogue, readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def col(name: str = "text"):
    return F.col(name)


# Text transforms


@query("transliterate", f"SELECT doc_id, {S.to_latin('text')} AS latin FROM documents WHERE text IS NOT NULL")
def transliterate(spark, d):
    return widened(table(spark, d, "documents").select("doc_id", "text").where("text is not null")).select("doc_id", T.to_latin(col()).alias("latin"))


@query("strip_garbage", f"SELECT block_id, {S.strip_garbage('text')} AS kept FROM blocks WHERE text IS NOT NULL")
def strip_garbage(spark, d):
    return table(spark, d, "blocks").where("text is not null").select("block_id", T.strip_garbage(col()).alias("kept"))


@query("normalize_text", f"SELECT doc_id, {S.normalized('text')} AS normal FROM documents WHERE text IS NOT NULL")
def normalize_text(spark, d):
    return widened(table(spark, d, "documents").select("doc_id", "text").where("text is not null")).select("doc_id", T.normalized(col()).alias("normal"))


@query("wiki_edit_links", f"SELECT doc_id, {S.normalized(chr(39) + 'Tarix[tahrirlash | manbasini tahrirlash] ' + chr(39) + ' || text')} AS normal FROM documents WHERE text IS NOT NULL")
def wiki_edit_links(spark, d):
    t = F.concat(F.lit("Tarix[tahrirlash | manbasini tahrirlash] "), "text")
    return widened(table(spark, d, "documents").select("doc_id", "text").where("text is not null")).select("doc_id", T.normalized(t).alias("normal"))


@query("content_hash", f"SELECT doc_id, sha1({S.dedup_form('text')}) AS hash, sha256(text) AS sha FROM documents WHERE text IS NOT NULL")
def content_hash(spark, d):
    return widened(table(spark, d, "documents").select("doc_id", "text").where("text is not null")).select("doc_id", T.content_hash(col()).alias("hash"), F.sha2("text", 256).alias("sha"))


PII = "text || ' +998 90 123 45 ' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || ' a' || doc_id || '@pochta.example'"


@query(
    "pii_scrub",
    f"""WITH t AS (SELECT doc_id, {PII} AS text FROM documents WHERE text IS NOT NULL), e AS (SELECT *, {S.rep('text', T.EMAIL)} AS e FROM t)
SELECT doc_id, {S.rep('e', T.PHONE)} AS scrubbed, CAST(len(regexp_extract_all(text, {S.q(T.EMAIL)})) + len(regexp_extract_all(e, {S.q(T.PHONE)})) AS INTEGER) AS hits FROM e""",
)
def pii_scrub(spark, d):
    t = F.concat("text", F.lit(" +998 90 123 45 "), F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0"), F.lit(" a"), F.col("doc_id").cast("string"), F.lit("@pochta.example"))
    x = widened(table(spark, d, "documents").select("doc_id", "text").where("text is not null")).select("doc_id", t.alias("text"))
    return x.select("doc_id", T.scrub_pii(col()).alias("scrubbed"), T.pii_count(col()).alias("hits"))


@query(
    "pii_report",
    f"""WITH e AS (SELECT coalesce(source, '') AS source, text, {S.rep('text', T.EMAIL)} AS e FROM documents WHERE text IS NOT NULL),
h AS (SELECT source, len(regexp_extract_all(text, {S.q(T.EMAIL)})) + len(regexp_extract_all(e, {S.q(T.PHONE)})) AS hits FROM e)
SELECT source, CAST(sum(hits) AS BIGINT) AS hits, CAST(count(*) FILTER (hits > 0) AS BIGINT) AS n_documents FROM h GROUP BY source""",
)
def pii_report(spark, d):
    x = widened(table(spark, d, "documents").select("source", "text").where("text is not null"))
    x = x.select(F.coalesce("source", F.lit("")).alias("source"), T.pii_count(col()).alias("hits"))
    return x.groupBy("source").agg(F.sum("hits").alias("hits"), F.count_if(F.col("hits") > 0).alias("n_documents"))


@query(
    "denoise_lines",
    f"""SELECT ocr_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: {S.denoised_line('l')}), chr(10)) AS denoised,
CAST(len(list_filter(string_split(text, chr(10)), lambda l: ({S.denoised_line('l')}) <> l)) AS INTEGER) AS changed FROM ocr_pages WHERE text IS NOT NULL""",
)
def denoise_lines(spark, d):
    return table(spark, d, "ocr_pages").where("text is not null").select("ocr_id", T.denoised(col()).alias("denoised"), T.changed_lines(col()).alias("changed"))


@query(
    "line_labels",
    f"""WITH l AS (SELECT page_id, candidate_id, unnest(string_split(text, chr(10))) AS line FROM candidates WHERE text IS NOT NULL)
SELECT page_id, candidate_id, CAST(count(*) FILTER ({S.is_page_number('line')}) AS BIGINT) AS page_numbers, CAST(count(*) FILTER ({S.is_byline('line')}) AS BIGINT) AS bylines
FROM l GROUP BY page_id, candidate_id""",
)
def line_labels(spark, d):
    x = table(spark, d, "candidates").where("text is not null").select("page_id", "candidate_id", F.explode(F.split("text", "\n")).alias("line"))
    return x.groupBy("page_id", "candidate_id").agg(F.count_if(T.is_page_number(F.col("line"))).alias("page_numbers"), F.count_if(T.is_byline(F.col("line"))).alias("bylines"))


@query(
    "token_estimate",
    """SELECT result_id, CAST(CASE WHEN length(kept_text) = 0 THEN 0 ELSE greatest(1, round_even(length(kept_text) / 4.0, 0)) END AS BIGINT) AS tokens,
CAST(NULL AS BIGINT) AS exact FROM results WHERE kept_text IS NOT NULL""",
)
def token_estimate(spark, d):
    return table(spark, d, "results").where("kept_text is not null").select("result_id", T.token_estimate(col("kept_text")).alias("tokens"), F.lit(None).cast("bigint").alias("exact"))


@query("slugs", "SELECT doc_id, regexp_replace(path, '[^a-zA-Z0-9_-]+', '_', 'g') AS slug, replace(path, '/', '_') AS name FROM documents")
def slugs(spark, d):
    return table(spark, d, "documents").select("doc_id", T.slug(F.col("path")).alias("slug"), F.replace("path", F.lit("/"), F.lit("_")).alias("name"))


#: File names of every form: dataset shards under their own, their public and an unknown name, library files, others.
FILES = """(SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'tahrirchi_uz-crawl' WHEN 1 THEN 'yakhyo_uz-wiki' WHEN 2 THEN 'corpus-b' WHEN 3 THEN 'boshqa_x' WHEN 4 THEN '10763_kimdir' ELSE coalesce(path, 'x') END
|| CASE WHEN doc_id % 6 < 4 THEN '__' || coalesce(source, 'train') || '__shard-' || lpad(CAST(doc_id AS VARCHAR), 6, '0') ELSE '' END || '.txt' AS name FROM documents)"""


def file_names(spark, d):
    i = F.col("doc_id") % 6
    head = F.when(i == 0, "tahrirchi_uz-crawl").when(i == 1, "yakhyo_uz-wiki").when(i == 2, "corpus-b").when(i == 3, "boshqa_x").when(i == 4, "10763_kimdir").otherwise(F.coalesce("path", F.lit("x")))
    tail = F.when(i < 4, F.concat(F.lit("__"), F.coalesce("source", F.lit("train")), F.lit("__shard-"), F.lpad(F.col("doc_id").cast("string"), 6, "0"))).otherwise("")
    return table(spark, d, "documents").select("doc_id", F.concat(head, tail, F.lit(".txt")).alias("name"))


@query(
    "source_ids",
    f"""WITH f AS {FILES}, m AS (SELECT doc_id, name, regexp_extract(name, '[^/]*$', 0) AS n, regexp_extract(regexp_extract(name, '[^/]*$', 0), '^(.+)__(.+)__shard-([0-9]+)[.]txt$', ['slug', 'split', 'shard']) AS p FROM f),
k AS (SELECT *, CASE p.slug WHEN 'tahrirchi_uz-crawl' THEN 'tahrirchi/uz-crawl' WHEN 'tahrirchi_uz-books-v2' THEN 'tahrirchi/uz-books-v2' WHEN 'yakhyo_uz-wiki' THEN 'yakhyo/uz-wiki' END AS dataset FROM m)
SELECT doc_id, CASE WHEN dataset IS NOT NULL THEN 'hf:' || dataset || ':' || p.split || ':shard-' || p.shard WHEN regexp_matches(n, '^[0-9]+_') THEN 'ziyouz:' || regexp_extract(n, '^([0-9]+)_', 1) END AS source_id,
CASE dataset WHEN 'tahrirchi/uz-crawl' THEN 'corpus-a' WHEN 'tahrirchi/uz-books-v2' THEN 'corpus-b' WHEN 'yakhyo/uz-wiki' THEN 'corpus-c' END || '__' || p.split || '__shard-' || p.shard || '.txt' AS renamed,
p.slug IN ('tahrirchi_uz-crawl', 'tahrirchi_uz-books-v2', 'yakhyo_uz-wiki', 'corpus-a', 'corpus-b', 'corpus-c') AS from_dataset FROM k""",
)
def source_ids(spark, d):
    n = N.file_name(F.col("name"))
    return file_names(spark, d).select("doc_id", N.source_id(n).alias("source_id"), N.renamed(n).alias("renamed"), N.is_from_dataset(n).alias("from_dataset"))


@query("shard_names", "SELECT doc_id, 'tahrirchi_uz-crawl__' || coalesce(lang, 'x') || '__shard-' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || '.txt' AS name FROM documents")
def shard_names(spark, d):
    return table(spark, d, "documents").select("doc_id", N.shard_name(F.lit("tahrirchi/uz-crawl"), F.coalesce("lang", F.lit("x")), F.col("doc_id")).alias("name"))


@query(
    "unknown_datasets",
    f"""WITH f AS {FILES} SELECT DISTINCT regexp_extract(regexp_extract(name, '[^/]*$', 0), '^(.+)__(.+)__shard-([0-9]+)[.]txt$', 1) AS slug FROM f WHERE regexp_matches(regexp_extract(name, '[^/]*$', 0), '__shard-[0-9]+[.]txt$')
EXCEPT SELECT * FROM (VALUES ('tahrirchi_uz-crawl'), ('tahrirchi_uz-books-v2'), ('yakhyo_uz-wiki'))""",
)
def unknown_datasets(spark, d):
    dataset, slug, _, _ = N.shard_parts(N.file_name(F.col("name")))
    return file_names(spark, d).where(slug.isNotNull() & dataset.isNull()).select(slug.alias("slug")).distinct()


@query(
    "formats",
    """WITH e AS (SELECT result_id, lower(regexp_extract(source_path, '\\.([A-Za-z0-9]+)$', 1)) AS x FROM results)
SELECT result_id, CASE WHEN x IN ('pdf', 'djvu', 'epub', 'docx', 'pptx', 'fb2', 'txt') THEN x WHEN x IN ('html', 'htm') THEN 'html' WHEN x = 'djv' THEN 'djvu' ELSE 'unknown' END AS detected FROM e""",
)
def formats(spark, d):
    return table(spark, d, "results").select("result_id", F.coalesce(readers.format_of(F.col("source_path")), F.lit("unknown")).alias("detected"))


@query(
    "paragraphs",
    f"""WITH p AS (SELECT result_id, list_filter(list_transform(string_split(kept_text, chr(10) || chr(10)), lambda x: {S.strip('x')}), lambda x: x <> '') AS ps
FROM results WHERE kept_text IS NOT NULL) SELECT result_id, CAST(unnest(range(len(ps))) AS INTEGER) AS page, unnest(ps) AS text FROM p""",
)
def paragraphs(spark, d):
    return table(spark, d, "results").where("kept_text is not null").select("result_id", F.posexplode(T.paragraphs(col("kept_text"))).alias("page", "text"))


# Language, quality, structure


@query("language_score", f"SELECT block_id, round({S.language_score('text')}, 6) AS score, ({S.language_score('text')}) >= 0.20 AS is_uzbek FROM blocks WHERE text IS NOT NULL")
def language_score(spark, d):
    s = Q.language_score(col())
    return widened(table(spark, d, "blocks").select("block_id", "text").where("text is not null")).select("block_id", F.round(s, 6).alias("score"), Q.is_uzbek(s).alias("is_uzbek"))


@query("quality_reasons", f"SELECT block_id, {S.quality_reason('text')} AS reason FROM blocks WHERE text IS NOT NULL")
def quality_reasons(spark, d):
    return widened(table(spark, d, "blocks").select("block_id", "text").where("text is not null")).select("block_id", Q.quality_reason(col()).alias("reason"))


@query("quality_histogram", f"SELECT coalesce(lang, '') AS lang, coalesce({S.quality_reason('text')}, 'kept') AS reason, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1, 2")
def quality_histogram(spark, d):
    x = widened(table(spark, d, "documents").where("text is not null").select("lang", "text"))
    x = x.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce(Q.quality_reason(col()), F.lit("kept")).alias("reason"))
    return x.groupBy("lang", "reason").agg(F.count("*").alias("n"))


#: Blocks with a running header and a page number added on each page.
HEADED = "(SELECT path, page, text FROM blocks WHERE text IS NOT NULL UNION ALL SELECT DISTINCT path, page, 'Sarlavha ' || coalesce(path, '') || ' ' || page FROM blocks UNION ALL SELECT DISTINCT path, page, '- ' || page || ' -' FROM blocks)"


def headed_blocks(spark, d):
    b = table(spark, d, "blocks").select("path", "page", "text")
    pages, p = b.select("path", "page").distinct(), F.col("page").cast("string")
    heads = pages.select("path", "page", F.concat(F.lit("Sarlavha "), F.coalesce("path", F.lit("")), F.lit(" "), p).alias("text"))
    return b.where("text is not null").unionByName(heads).unionByName(pages.select("path", "page", F.concat(F.lit("- "), p, F.lit(" -")).alias("text")))


@query(
    "repeated_headers",
    f"""SELECT path, form, count(DISTINCT page) AS n_pages FROM (SELECT path, page, {S.repeat_form('text')} AS form FROM {HEADED})
WHERE form <> '' AND length(form) < 100 GROUP BY path, form HAVING count(DISTINCT page) >= 2""",
)
def repeated_headers(spark, d):
    return clean.repeated_texts(headed_blocks(spark, d), 2)


@query("structure_cascade", S.FUNNEL + "SELECT block_id, structure_reason FROM s")
def structure_cascade(spark, d):
    b = table(spark, d, "blocks").select("block_id", "path", "page", F.coalesce("text", F.lit("")).alias("text"))
    return clean.structured(b).select("block_id", "structure_reason")


@query(
    "ambiguous_blocks",
    S.FUNNEL
    + f""", kept AS (SELECT block_id, path, page, text, form FROM s WHERE structure_reason IS NULL),
near AS (SELECT path, form FROM kept WHERE form <> '' AND length(form) < 100 GROUP BY path, form HAVING count(DISTINCT page) >= 2)
SELECT block_id, near.form IS NOT NULL OR (page <= 3 AND length({S.strip('text')}) <= 150)
  OR ({S.marks(S.strip('text'))} = 2 AND length({S.strip('text')}) <= 300 AND regexp_matches({S.strip('text')}, '(19|20)[0-9]{{2}}')) AS ambiguous
FROM kept LEFT JOIN near USING (path, form)""",
)
def ambiguous_blocks(spark, d):
    b = table(spark, d, "blocks").select("block_id", "path", "page", F.coalesce("text", F.lit("")).alias("text"))
    kept = clean.structured(b).where("structure_reason is null")
    near = clean.repeated_texts(kept, 2).select("path", "form", F.lit(True).alias("near"))
    k = kept.withColumn("form", T.repeat_form(col())).join(near, ["path", "form"], "left")
    return k.select("block_id", Q.is_ambiguous(col(), F.col("page"), F.coalesce("near", F.lit(False))).alias("ambiguous"))


# The funnel


@query("clean_funnel", S.FUNNEL + "SELECT block_id, drop_reason, CASE WHEN drop_reason IS NULL THEN clean_text END AS clean_text FROM funnel")
def clean_funnel(spark, d):
    return clean.cleaned(table(spark, d, "blocks")).select("block_id", "drop_reason", F.when(F.col("drop_reason").isNull(), F.col("clean_text")).alias("clean_text"))


@query(
    "doc_report",
    S.FUNNEL
    + """, t AS (SELECT path, coalesce(string_agg(clean_text, chr(10) || chr(10) ORDER BY block_idx) FILTER (drop_reason IS NULL), '') AS kept_text,
count(*) AS total_blocks, count(*) FILTER (drop_reason IS NULL) AS kept_blocks FROM funnel GROUP BY path)
SELECT path, length(kept_text) AS char_count, CAST(CASE WHEN kept_text = '' THEN 0 ELSE greatest(1, round_even(length(kept_text) / 4.0, 0)) END AS BIGINT) AS estimated_tokens,
total_blocks, kept_blocks, total_blocks - kept_blocks AS dropped_blocks, round((total_blocks - kept_blocks) / total_blocks * 100, 2) AS dropped_pct FROM t""",
)
def doc_report(spark, d):
    return clean.reports(clean.cleaned(table(spark, d, "blocks")))


@query(
    "clean_documents",
    S.FUNNEL + "SELECT path, 0 AS part, string_agg(clean_text, chr(10) || chr(10) ORDER BY block_idx) AS kept_text FROM funnel WHERE drop_reason IS NULL GROUP BY path",
)
def clean_documents(spark, d):
    return clean.documents(clean.cleaned(table(spark, d, "blocks")), 1 << 40)


@query("reject_reasons", S.FUNNEL + "SELECT drop_reason AS reason, count(*) AS n FROM funnel WHERE drop_reason IS NOT NULL GROUP BY 1")
def reject_reasons(spark, d):
    return clean.cleaned(table(spark, d, "blocks")).where("drop_reason is not null").groupBy(F.col("drop_reason").alias("reason")).agg(F.count("*").alias("n"))


@query("rejected_blocks", S.FUNNEL + "SELECT path, page, drop_reason AS reason, count(*) AS n FROM funnel WHERE drop_reason IS NOT NULL GROUP BY 1, 2, 3")
def rejected_blocks(spark, d):
    return clean.cleaned(table(spark, d, "blocks")).where("drop_reason is not null").groupBy("path", "page", F.col("drop_reason").alias("reason")).agg(F.count("*").alias("n"))


@query(
    "paragraph_dedup",
    f"""WITH k AS (SELECT result_id, sha1({S.dedup_form('kept_text')}) AS key FROM results WHERE kept_text IS NOT NULL)
SELECT result_id, row_number() OVER (PARTITION BY key ORDER BY result_id) > 1 AS is_repeat FROM k""",
)
def paragraph_dedup(spark, d):
    k = table(spark, d, "results").where("kept_text is not null").select("result_id", T.content_hash(col("kept_text")).alias("key"))
    return dedup.flag_repeats(k, "key", ["result_id"]).select("result_id", "is_repeat")


@query(
    "duplicate_groups",
    f"""WITH k AS (SELECT source_path, sha1({S.dedup_form('kept_text')}) AS hash FROM results WHERE kept_text IS NOT NULL)
SELECT hash, min(source_path) AS kept, count(*) - 1 AS n_duplicates FROM k GROUP BY hash HAVING count(*) > 1""",
)
def duplicate_groups(spark, d):
    k = table(spark, d, "results").where("kept_text is not null").select("source_path", T.content_hash(col("kept_text")).alias("hash"))
    return dedup.duplicate_groups(k, "hash", "source_path")


@query(
    "quarantine",
    f"""WITH k AS (SELECT result_id, lower(trim(category)) AS category, sha1({S.dedup_form('kept_text')}) AS hash FROM results WHERE kept_text IS NOT NULL)
SELECT category, count(*) AS n FROM (SELECT category, row_number() OVER (PARTITION BY hash ORDER BY result_id) AS r FROM k) WHERE r > 1 GROUP BY category""",
)
def quarantine(spark, d):
    k = table(spark, d, "results").where("kept_text is not null").select("result_id", F.lower(F.trim("category")).alias("category"), T.content_hash(col("kept_text")).alias("hash"))
    return dedup.flag_repeats(k, "hash", ["result_id"]).where("is_repeat").groupBy("category").agg(F.count("*").alias("n"))


# Spelling


TOKENS = """t AS (SELECT unnest(string_split_regex(lower(text), '[\\s\\p{Z}]+')) AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT regexp_extract(t, '(?s)^(.*?)([.,!?:;)"»]*)$', 1) AS word FROM t), n AS (SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word)"""


@query("trusted_dictionary", f"WITH {TOKENS} SELECT word, n FROM n WHERE n >= 3")
def trusted_dictionary(spark, d):
    return spelling.dictionary(table(spark, d, "documents"))


VARIANTS = ", ".join(f"replace(word, {S.q(a)}, {S.q(b)})" for x, y in spelling.CONFUSED for a, b in ((x, y), (y, x)))


#: Every second document with the letter q read as k, as scanners do; the others are trusted.
MISREAD = "(SELECT doc_id, replace(text, 'q', 'k') AS text FROM documents WHERE text IS NOT NULL AND doc_id % 2 = 0)"
SPELL = f"""WITH r AS (SELECT word FROM (SELECT unnest(string_split_regex(lower(text), '[\\s\\p{{Z}}]+')) AS t FROM documents WHERE text IS NOT NULL AND doc_id % 2 = 1) x, LATERAL (SELECT regexp_extract(x.t, '(?s)^(.*?)([.,!?:;)"»]*)$', 1) AS word)
WHERE word <> '' GROUP BY word HAVING count(*) >= 3),
u AS (SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(lower(text), '[\\s\\p{{Z}}]+')) AS t FROM {MISREAD}) x, LATERAL (SELECT regexp_extract(x.t, '(?s)^(.*?)([.,!?:;)"»]*)$', 1) AS word) WHERE word <> '' AND word NOT IN (SELECT word FROM r)),
v AS (SELECT DISTINCT word, unnest([{VARIANTS}]) AS correction FROM u), c AS (SELECT word, correction FROM v WHERE word <> correction AND correction IN (SELECT word FROM r)),
fix AS (SELECT word, min(correction) AS correction FROM c GROUP BY word HAVING count(*) = 1)
"""


def misread_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text").where("text is not null")
    bad = docs.where("doc_id % 2 = 0").select("doc_id", F.replace("text", F.lit("q"), F.lit("k")).alias("text"))
    return bad, spelling.corrections(spelling.words(bad), spelling.dictionary(docs.where("doc_id % 2 = 1")))


@query("spell_corrections", SPELL + "SELECT word, correction FROM fix")
def spell_corrections(spark, d):
    return misread_documents(spark, d)[1]


@query(
    "corrected_lines",
    SPELL
    + f""", l AS (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {MISREAD})),
t AS (SELECT doc_id, i, line, unnest(range(len(ts))) AS j, unnest(ts) AS t FROM (SELECT *, list_filter(string_split_regex(line, '[\\s\\p{{Z}}]+'), lambda x: x <> '') AS ts FROM l) WHERE len(ts) > 0),
k AS (SELECT *, regexp_extract(t, '(?s)^(.*?)([.,!?:;)"»]*)$', 1) AS core, regexp_extract(t, '(?s)^(.*?)([.,!?:;)"»]*)$', 2) AS rest FROM t),
f AS (SELECT doc_id, i, string_agg(CASE WHEN correction IS NULL THEN t WHEN left(core, 1) <> lower(left(core, 1)) THEN upper(left(correction, 1)) || substr(correction, 2) || rest ELSE correction || rest END, ' ' ORDER BY j) AS line
FROM k LEFT JOIN fix ON lower(core) = word GROUP BY doc_id, i)
SELECT doc_id, string_agg(coalesce(f.line, l.line), chr(10) ORDER BY i) AS corrected FROM l LEFT JOIN f USING (doc_id, i) GROUP BY doc_id""",
)
def corrected_lines(spark, d):
    bad, fixes = misread_documents(spark, d)
    return spelling.corrected_lines(bad, "doc_id", fixes)


FIXES = {"kitob": "kitoblar", "bilan": "birga", "uchun": "atab"}
FIX_SQL = " ".join(f"WHEN lower(regexp_extract(t, '(?s)^(.*?)([.,!?:;)\"»]*)$', 1)) = {S.q(k)} THEN {S.q(v[0].upper() + v[1:])} || regexp_extract(t, '(?s)^(.*?)([.,!?:;)\"»]*)$', 2)" for k, v in FIXES.items())


@query(
    "known_corrections",
    f"""SELECT block_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: array_to_string(list_transform(list_filter(string_split_regex(l, '[\\s\\p{{Z}}]+'), lambda t: t <> ''),
lambda t: CASE {FIX_SQL} ELSE t END), ' ')), chr(10)) AS fixed FROM blocks WHERE text IS NOT NULL""",
)
def known_corrections(spark, d):
    fixes = F.create_map(*[F.lit(x) for kv in FIXES.items() for x in kv])
    return table(spark, d, "blocks").where("text is not null").select("block_id", T.corrected_text(col(), fixes).alias("fixed"))


@query("unresolved_words", f"WITH {TOKENS} SELECT count(*) AS n_words, CAST(sum(n) AS BIGINT) AS n_tokens FROM n WHERE n < 3")
def unresolved_words(spark, d):
    n = spelling.counted(table(spark, d, "documents")).where("n < 3")
    return n.agg(F.count("*").alias("n_words"), F.sum("n").alias("n_tokens"))


# Ledger


LATEST = """WITH now AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY coalesce(processed_at, TIMESTAMP '0001-01-01') DESC, book_id DESC) AS rn,
coalesce(dedup_status, max(dedup_status) OVER (PARTITION BY path)) AS status FROM books WHERE path IS NOT NULL) WHERE rn = 1)"""


@query("ledger_latest", LATEST + " SELECT path, book_id, category, estimated_tokens, exact_tokens, status AS dedup_status FROM now")
def ledger_latest(spark, d):
    return ledger.latest(table(spark, d, "books")).select("path", "book_id", "category", "estimated_tokens", "exact_tokens", "dedup_status")


@query("collected_tokens", LATEST + " SELECT category, CAST(sum(coalesce(exact_tokens, estimated_tokens)) AS BIGINT) AS collected_tokens FROM now WHERE status IS NULL GROUP BY category")
def collected_tokens(spark, d):
    return ledger.collected(ledger.latest(table(spark, d, "books")))


TARGETS = ", ".join(f"({S.q(k)}, {v * 1_000_000})" for k, v in ledger.BUDGETS.items())


@query(
    "budget_progress",
    LATEST
    + f""", b(category, target_tokens) AS (VALUES {TARGETS}), c AS (SELECT category, sum(coalesce(exact_tokens, estimated_tokens)) AS n FROM now WHERE status IS NULL GROUP BY category),
j AS (SELECT b.category, CAST(b.target_tokens AS BIGINT) AS target_tokens, CAST(coalesce(n, 0) AS BIGINT) AS collected_tokens FROM b LEFT JOIN c ON b.category = c.category),
a AS (SELECT coalesce(category, 'JAMI') AS category, CAST(sum(target_tokens) AS BIGINT) AS target_tokens, CAST(sum(collected_tokens) AS BIGINT) AS collected_tokens FROM j GROUP BY ROLLUP (category))
SELECT category, target_tokens, collected_tokens, round(least(collected_tokens / target_tokens * 100, 100.0), 6) AS progress_pct FROM a""",
)
def budget_progress(spark, d):
    return ledger.progress(ledger.latest(table(spark, d, "books"))).withColumn("progress_pct", F.round("progress_pct", 6))


@query("ledger_count", LATEST + " SELECT count(*) AS n_documents, count(*) FILTER (status IS NOT NULL) AS n_duplicates FROM now")
def ledger_count(spark, d):
    return ledger.latest(table(spark, d, "books")).agg(F.count("*").alias("n_documents"), F.count_if(F.col("dedup_status").isNotNull()).alias("n_duplicates"))


DUP_PATHS = f"""dup AS (SELECT DISTINCT source_path AS path FROM (SELECT source_path, row_number() OVER (PARTITION BY sha1({S.dedup_form('kept_text')}) ORDER BY result_id) AS r
FROM results WHERE kept_text IS NOT NULL) WHERE r > 1)"""


@query("mark_duplicates", LATEST + f", {DUP_PATHS} SELECT path, CASE WHEN path IN (SELECT path FROM dup) THEN 'duplicate' ELSE status END AS dedup_status FROM now")
def mark_duplicates(spark, d):
    k = table(spark, d, "results").where("kept_text is not null").select("result_id", "source_path", T.content_hash(col("kept_text")).alias("hash"))
    dup = dedup.flag_repeats(k, "hash", ["result_id"]).where("is_repeat").select(F.col("source_path").alias("path"))
    return ledger.mark_duplicates(ledger.latest(table(spark, d, "books")), dup).select("path", "dedup_status")


@query("ledger_removal", LATEST + " SELECT category, count(*) AS n FROM now WHERE category IS DISTINCT FROM 'books' GROUP BY category")
def ledger_removal(spark, d):
    return ledger.removed(ledger.latest(table(spark, d, "books")), category="books").groupBy("category").agg(F.count("*").alias("n"))


@query("unprocessed_files", "SELECT DISTINCT path FROM documents WHERE path NOT IN (SELECT path FROM books WHERE path IS NOT NULL)")
def unprocessed_files(spark, d):
    return ledger.unprocessed(table(spark, d, "documents").select("path").distinct().where("path is not null"), table(spark, d, "books"))


@query("shard_rows", "SELECT shard, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM (SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 100) AS BIGINT) + 1 AS shard FROM documents) GROUP BY shard")
def shard_rows(spark, d):
    s = ordered.shards(table(spark, d, "documents").select("doc_id"), ["doc_id"], 100)
    return s.groupBy("shard").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query(
    "stop_at_budget",
    """SELECT category, count(*) AS n, CAST(sum(estimated_tokens) AS BIGINT) AS n_tokens FROM (SELECT category, estimated_tokens,
coalesce(sum(coalesce(estimated_tokens, 0)) OVER (PARTITION BY category ORDER BY result_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM results WHERE category IS NOT NULL)
WHERE before < 20000 GROUP BY category""",
)
def stop_at_budget(spark, d):
    r = table(spark, d, "results").where("category is not null").select("result_id", "category", "estimated_tokens")
    kept = ordered.until_budget(r, ["category"], ["result_id"], F.col("estimated_tokens"), F.lit(20000))
    return kept.groupBy("category").agg(F.count("*").alias("n"), F.sum("estimated_tokens").alias("n_tokens"))


@query("retry_delays", "SELECT page_id, CAST(least(60, 5 * pow(2, attempts - 1)) AS BIGINT) AS minutes FROM pages WHERE attempts > 0")
def retry_delays(spark, d):
    return table(spark, d, "pages").where("attempts > 0").select("page_id", ledger.retry_minutes(F.col("attempts")).alias("minutes"))


# URLs and categories


@query("canonical_urls", f"SELECT page_id, {S.canonical('url')} AS canonical, {S.host_key('url')} AS host FROM pages")
def canonical_urls(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", U.canonical(u).alias("canonical"), U.host_key(u).alias("host"))


SEED = "https://tongxabar.uz.example/"
ENDS = "(" + ", ".join(S.q(x) for x in U.SKIPPED) + ")"


@query(
    "collectable_urls",
    f"""WITH c AS (SELECT page_id, {S.canonical('url')} AS c, {S.host_key('url')} AS a, {S.host_key(S.q(SEED))} AS b FROM pages)
SELECT page_id, a = b OR ends_with(a, '.' || b) OR ends_with(b, '.' || a) AS belongs,
coalesce(c IS NOT NULL AND (a = b OR ends_with(a, '.' || b) OR ends_with(b, '.' || a)) AND regexp_extract(lower({S.url_part('c', 3)}), '\\.([^./]+)$', 1) NOT IN {ENDS}, false) AS collectable FROM c""",
)
def collectable_urls(spark, d):
    u, s = F.col("url"), F.lit(SEED)
    return table(spark, d, "pages").select("page_id", U.belongs(u, s).alias("belongs"), U.collectable(u, s).alias("collectable"))


DATE = "/(20[0-9]{2})/(0?[1-9]|1[0-2])/(0?[1-9]|[12][0-9]|3[01])(?:/|$)"


@query(
    "url_dates",
    f"""WITH p AS (SELECT page_id, {S.url_part('url', 3)} AS p FROM pages), m AS (SELECT page_id, regexp_extract(p, {S.q(DATE)}, 1) AS y, lpad(regexp_extract(p, {S.q(DATE)}, 2), 2, '0') AS m,
lpad(regexp_extract(p, {S.q(DATE)}, 3), 2, '0') AS d FROM p) SELECT page_id, CASE WHEN y <> '' THEN strftime(try_cast(y || '-' || m || '-' || d AS DATE), '%Y-%m-%d') || 'T00:00:00+00:00' END AS url_date FROM m""",
)
def url_dates(spark, d):
    return table(spark, d, "pages").select("page_id", U.url_date(F.col("url")).alias("url_date"))


@query(
    "published_days",
    """SELECT page_id, strftime(coalesce(CASE WHEN regexp_matches(trim(published_at), '^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}') THEN try_cast(trim(published_at) AS TIMESTAMPTZ) END,
try_cast(CASE WHEN regexp_matches(trim(published_at), '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN left(trim(published_at), 10) END AS TIMESTAMPTZ)) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') AS published FROM pages""",
)
def published_days(spark, d):
    return table(spark, d, "pages").select("page_id", F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), U.parsed_time(F.col("published_at")).cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss").alias("published"))


@query("domain_folders", f"SELECT DISTINCT regexp_replace(CASE WHEN {S.host_key('url')} = '' THEN 'website' ELSE {S.host_key('url')} END, '[^a-zA-Z0-9._-]+', '_', 'g') AS folder FROM pages")
def domain_folders(spark, d):
    return table(spark, d, "pages").select(U.folder(F.col("url")).alias("folder")).distinct()


@query("categorize_urls", f"SELECT page_id, {S.category_from_url('url')} AS from_url, coalesce({S.category_from_url('url')}, {S.hinted('title')}, 'web_news') AS category FROM pages")
def categorize_urls(spark, d):
    none = F.lit(None).cast("string")
    return table(spark, d, "pages").select("page_id", U.category_from_url(F.col("url")).alias("from_url"), U.resolved_category(F.col("url"), F.col("title"), none, none).alias("category"))


@query("folder_categories", "SELECT doc_id, CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) ELSE 'uncategorized' END AS folder FROM documents")
def folder_categories(spark, d):
    return table(spark, d, "documents").select("doc_id", N.folder_category(F.col("path")).alias("folder"))


# Crawling


@query("status_counts", "SELECT status, count(*) AS n FROM pages GROUP BY status")
def status_counts(spark, d):
    return table(spark, d, "pages").groupBy("status").agg(F.count("*").alias("n"))


@query("crawl_frontier", "SELECT page_id FROM pages WHERE status = 'discovered' ORDER BY coalesce(published_at, sitemap_lastmod, '1970-01-01') DESC, discovered_at DESC NULLS LAST, page_id LIMIT 20")
def crawl_frontier(spark, d):
    return web.frontier(table(spark, d, "pages"), 20).select("page_id")


@query("recent_median", "SELECT median(clean_chars) AS median_chars FROM (SELECT clean_chars FROM pages WHERE clean_chars IS NOT NULL ORDER BY updated_at DESC NULLS LAST, page_id LIMIT 100) WHERE clean_chars > 0")
def recent_median(spark, d):
    return web.recent_median(table(spark, d, "pages"))


@query("sitemap_order", "SELECT page_id, row_number() OVER (PARTITION BY status ORDER BY coalesce(sitemap_lastmod, '') DESC, url, page_id) AS place FROM pages WHERE status IS NOT NULL")
def sitemap_order(spark, d):
    p = table(spark, d, "pages").where("status is not null").select("page_id", "status", "url", "sitemap_lastmod")
    return crawl.places(p, ["status"], [F.coalesce("sitemap_lastmod", F.lit("")).desc(), F.col("url"), F.col("page_id")]).select("page_id", "place")


WORDS = r"[\p{L}\p{N}_ʻʼ‘’'-]+"


@query(
    "candidate_rank",
    f"""WITH c AS (SELECT c.page_id, candidate_id, text, score, coalesce(title, '') AS title FROM candidates c LEFT JOIN pages p ON c.page_id = p.page_id),
w AS (SELECT *, list_distinct(list_filter(regexp_extract_all(lower(title), {S.q(WORDS)}), lambda w: length(w) >= 4)) AS tw, regexp_extract_all(lower(left(text, 1600)), {S.q(WORDS)}) AS ow FROM c),
s AS (SELECT page_id, candidate_id, text, score + CASE WHEN len(tw) > 0 THEN len(list_intersect(tw, ow)) / len(tw) ELSE 0.0 END * 14000
  - CASE WHEN {' OR '.join(f"contains(lower(left(text, 1200)), {S.q(x)})" for x in web.LEGAL)} THEN 16000 ELSE 0 END AS final_score FROM w),
u AS (SELECT *, row_number() OVER (PARTITION BY page_id, sha256(text) ORDER BY final_score DESC NULLS LAST, candidate_id) AS r FROM s)
SELECT page_id, candidate_id, round(final_score, 4) AS final_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY final_score DESC NULLS LAST, candidate_id) AS rank FROM u WHERE r = 1) WHERE rank <= 12""",
)
def candidate_rank(spark, d):
    return web.ranked(table(spark, d, "candidates"), table(spark, d, "pages")).withColumn("final_score", F.round("final_score", 4))


@query(
    "local_acceptance",
    f"""WITH p AS (SELECT page_id, trim({S.url_part('url', 3)}, '/') AS path, regexp_matches({S.url_part('url', 3)}, {S.q(DATE)}) AS dated FROM pages)
SELECT page_id, candidate_id, method IN ('jsonld', 'nuxt', 'next') AND (length(text) >= 700 OR coalesce(dated AND length(path) - length(replace(path, '/', '')) >= 3, false)) AS accepted, length(text) >= 250 AS long_enough
FROM candidates LEFT JOIN p USING (page_id) WHERE text IS NOT NULL""",
)
def local_acceptance(spark, d):
    n = F.length("text")
    p = table(spark, d, "pages").select("page_id", U.article_path(F.col("url")).alias("dated"))
    c = table(spark, d, "candidates").where("text is not null").join(p, "page_id", "left")
    return c.select("page_id", "candidate_id", web.accepted(F.col("method"), n, F.coalesce("dated", F.lit(False))).alias("accepted"), (n >= 250).alias("long_enough"))


@query(
    "payload_budget",
    """SELECT page_id, candidate_id FROM (SELECT page_id, candidate_id, row_number() OVER w AS n, sum(length(text)) OVER (PARTITION BY page_id ORDER BY candidate_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t
FROM candidates WHERE text IS NOT NULL WINDOW w AS (PARTITION BY page_id ORDER BY candidate_id)) WHERE n = 1 OR t <= 3000""",
)
def payload_budget(spark, d):
    c = table(spark, d, "candidates").where("text is not null").select("page_id", "candidate_id", F.length("text").alias("size"))
    return web.within_budget(c, ["page_id"], ["candidate_id"], F.col("size"), 3000).select("page_id", "candidate_id")


@query("trash_lines", f"""WITH l AS (SELECT page_id, candidate_id, unnest(string_split(text, chr(10))) AS line FROM candidates WHERE text IS NOT NULL)
SELECT page_id, candidate_id, count(*) AS n FROM l WHERE regexp_replace(lower({S.strip('line')}), '^[ .:—\\-\t]+|[ .:—\\-\t]+$', '', 'g') IN ('reklama', 'advertisement', 'реклама', 'sponsored', 'homiylik materiali')
OR (length({S.strip('line')}) <= 300 AND regexp_matches({S.strip('line')}, '(?i)^(foto|surat|video|illustratsiya|manba)\\s*:')) GROUP BY page_id, candidate_id""")
def trash_lines(spark, d):
    x = table(spark, d, "candidates").where("text is not null").select("page_id", "candidate_id", F.explode(F.split("text", "\n")).alias("line"))
    return x.where(Q.is_trash(F.col("line"))).groupBy("page_id", "candidate_id").agg(F.count("*").alias("n"))


CLEAN_LINE = lambda x: S.rep(S.rep(S.strip(x), r"[\s\p{Z}]+", " "), r" +([.,:;!?])", r"\1")
TRASH = lambda x: f"""(regexp_replace(lower({x}), '^[ .:—\\-\t]+|[ .:—\\-\t]+$', '', 'g') IN ('reklama', 'advertisement', 'реклама', 'sponsored', 'homiylik materiali')
OR (length({x}) <= 300 AND regexp_matches({x}, '(?i)^(foto|surat|video|illustratsiya|manba)\\s*:')))"""  # noqa: E731


@query(
    "content_blocks",
    f"""WITH b AS (SELECT page_id, candidate_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {CLEAN_LINE('x')}), lambda x: x <> '' AND NOT {TRASH('x')}) AS bs FROM candidates WHERE text IS NOT NULL),
k AS (SELECT *, list_transform(bs, lambda x: regexp_replace(lower(x), '[^\\p{{L}}\\p{{N}}_]+', '', 'g')) AS ks FROM b)
SELECT page_id, candidate_id, array_to_string(list_filter(bs, lambda x, i: ks[i] <> '' AND list_position(ks, ks[i]) = i), chr(10)) AS body FROM k""",
)
def content_blocks(spark, d):
    c = table(spark, d, "candidates").where("text is not null")
    return c.select("page_id", "candidate_id", F.array_join(web.content_blocks(F.col("text")), "\n").alias("body"))


@query(
    "articles",
    f"""WITH c AS (SELECT page_id, candidate_id, coalesce({CLEAN_LINE('title')}, '') AS t, list_filter(list_transform(string_split(text, chr(10)), lambda x: {S.strip('x')}), lambda x: x <> '') AS bs
FROM candidates LEFT JOIN pages USING (page_id) WHERE text IS NOT NULL),
k AS (SELECT *, regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}_]+', '', 'g') AS tk, CASE WHEN t <> '' AND right(t, 1) NOT IN ('.', '!', '?', '…') THEN t || '.' ELSE t END AS head FROM c),
f AS (SELECT *, CASE WHEN tk <> '' AND len(bs) > 0 AND regexp_replace(lower(bs[1]), '[^\\p{{L}}\\p{{N}}_]+', '', 'g') = tk THEN bs[2:] ELSE bs END AS rest FROM k)
SELECT page_id, candidate_id, {S.strip("CASE WHEN head = '' THEN array_to_string(rest, chr(10) || chr(10)) ELSE head || chr(10) || chr(10) || array_to_string(rest, chr(10) || chr(10)) END")} AS article FROM f""",
)
def articles(spark, d):
    c = table(spark, d, "candidates").where("text is not null").join(table(spark, d, "pages").select("page_id", "title"), "page_id", "left")
    blocks = F.filter(F.transform(F.split("text", "\n"), T.stripped), lambda x: x != "")
    return c.select("page_id", "candidate_id", T.composed(F.col("title"), blocks).alias("article"))


@query(
    "titles",
    f"""WITH l AS (SELECT page_id, list_filter(list_transform(string_split_regex(title, '\\r\\n?|\\n'), lambda x: {CLEAN_LINE('x')}), lambda x: x <> '') AS ls FROM pages WHERE title IS NOT NULL),
t AS (SELECT page_id, array_to_string(list_filter(ls, lambda x, i: i = 1 OR x <> ls[i - 1]), chr(10) || chr(10)) AS t FROM l)
SELECT page_id, CASE WHEN t <> '' AND right(t, 1) NOT IN ('.', '!', '?', '…') THEN t || '.' ELSE t END AS heading FROM t""",
)
def titles(spark, d):
    return table(spark, d, "pages").where("title is not null").select("page_id", T.title_with_stop(F.col("title")).alias("heading"))


LINKS = "links AS (SELECT DISTINCT a.page_id AS source, b.page_id AS target FROM pages a, (VALUES (2, 0), (2, 1), (3, 1), (7, 5)) k(m, r), pages b WHERE b.page_id = a.page_id * m + r)"


@query(
    "catalog_bfs",
    f"""WITH RECURSIVE {LINKS}, r(page, depth) AS (SELECT min(page_id), 0 FROM pages UNION SELECT target, depth + 1 FROM r JOIN links ON source = page)
SELECT page, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY page""",
)
def catalog_bfs(spark, d):
    p = table(spark, d, "pages").select("page_id")
    links = p.select(F.col("page_id").alias("source"), F.explode(F.array(*[F.col("page_id") * m + r for m, r in ((2, 0), (2, 1), (3, 1), (7, 5))])).alias("target"))
    links = links.join(p.select(F.col("page_id").alias("target")), "target", "left_semi").distinct()
    return web.reachable(links, p.agg(F.min("page_id").alias("page"))).select("page", "depth")


@query(
    "bundles",
    f"""WITH RECURSIVE p AS (SELECT {S.host_key('url')} AS domain, page_id AS article_id, left(published_at, 10) AS day, coalesce(clean_chars, 0) AS size FROM pages WHERE published_at IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY day DESC, article_id) AS seq FROM p),
r(domain, seq, article_id, bundle, used, month) AS (SELECT domain, seq, article_id, 1, CAST(size AS BIGINT), left(day, 7) FROM s WHERE seq = 1
UNION ALL SELECT s.domain, s.seq, s.article_id, CASE WHEN left(s.day, 7) > month OR used + s.size > 20000 THEN bundle + 1 ELSE bundle END,
CASE WHEN left(s.day, 7) > month OR used + s.size > 20000 THEN s.size ELSE used + s.size END, left(s.day, 7) FROM r JOIN s ON s.domain = r.domain AND s.seq = r.seq + 1)
SELECT domain, article_id, bundle FROM r""",
)
def bundles(spark, d):
    p = table(spark, d, "pages").where("published_at is not null").select(U.host_key(F.col("url")).alias("domain"), F.col("page_id").alias("article_id"), F.left("published_at", F.lit(10)).alias("day"), F.coalesce("clean_chars", F.lit(0)).alias("size"))
    seq = crawl.places(p, ["domain"], [F.desc("day"), F.col("article_id")]).withColumnRenamed("place", "seq")
    return web.bundled(seq, 20_000)


@query(
    "library_categories",
    """WITH n AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN ' Fizika' WHEN 1 THEN 'O‘zbek nasri' WHEN 2 THEN 'O''zbek nasri' WHEN 3 THEN 'Prezident asarlari' WHEN 4 THEN 'Hajviyot' WHEN 5 THEN 'Tibbiyotga oid risolalar' ELSE 'Yo''q bo''lim' END AS name FROM documents)
SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'education' WHEN 1 THEN 'books' WHEN 2 THEN 'books' WHEN 3 THEN 'gov_legal' WHEN 4 THEN 'web_news' WHEN 5 THEN 'domain_haf' END AS category FROM n""",
)
def library_categories(spark, d):
    i = F.col("doc_id") % 7
    name = F.when(i == 0, " Fizika").when(i == 1, "O‘zbek nasri").when(i == 2, "O'zbek nasri").when(i == 3, "Prezident asarlari").when(i == 4, "Hajviyot").when(i == 5, "Tibbiyotga oid risolalar").otherwise("Yo'q bo'lim")
    return N.library_category(table(spark, d, "documents").select("doc_id", name.alias("name")), "name").select("doc_id", "category")


@query(
    "downloads",
    "SELECT result_id, lower(regexp_extract(source_path, '[.][^.]+$', 0)) IN ('.pdf', '.djvu', '.epub', '.docx', '.pptx', '.fb2', '.html', '.txt') AND coalesce(char_count * 10000 <= 209715200, true) AS wanted FROM results WHERE source_path IS NOT NULL",
)
def downloads(spark, d):
    return table(spark, d, "results").where("source_path is not null").select("result_id", N.downloadable(F.col("source_path"), F.col("char_count") * 10000).alias("wanted"))


@query("flat_categories", "SELECT doc_id, CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) WHEN category IN ('books', 'web_news') THEN category ELSE 'books' END AS category FROM documents WHERE path IS NOT NULL")
def flat_categories(spark, d):
    return table(spark, d, "documents").where("path is not null").select("doc_id", N.flat_category(F.col("path"), F.col("category"), ["books", "web_news"]).alias("category"))


# State of the crawl


@query("pending_pages", "SELECT CAST(count(*) FILTER (status = 'discovered') AS BIGINT) AS n_pending FROM pages")
def pending_pages(spark, d):
    return crawl.pending(table(spark, d, "pages"))


@query("ai_pages", "SELECT page_id FROM pages WHERE status = 'manual_review' AND contains(url, '.uz') ORDER BY coalesce(published_at, '') DESC, page_id LIMIT 15")
def ai_pages(spark, d):
    p = table(spark, d, "pages").withColumn("status", F.when(F.col("status") == "manual_review", "ai_pending"))
    return crawl.ai_pages(p, ".uz", 15).select("page_id")


@query(
    "recovered_pages",
    "SELECT CASE WHEN status IN ('processing', 'writing', 'download_failed') THEN 'discovered' WHEN status = 'ai_processing' THEN 'ai_pending' ELSE status END AS status, count(*) AS n FROM pages GROUP BY 1",
)
def recovered_pages(spark, d):
    return table(spark, d, "pages").groupBy(crawl.recovered(F.col("status")).alias("status")).agg(F.count("*").alias("n"))


@query(
    "added_pages",
    """WITH old AS (SELECT url, max(nullif(sitemap_lastmod, '')) AS sitemap_lastmod FROM pages WHERE page_id % 3 = 0 GROUP BY url), new AS (SELECT url, '2024-03-0' || max(1 + page_id % 9) AS p FROM pages WHERE page_id % 2 = 0 GROUP BY url)
SELECT url, CASE WHEN new.url IS NOT NULL THEN p || 'T00:00:00+00:00' END AS published_at, CASE WHEN old.url IS NULL THEN 'x' WHEN new.url IS NULL THEN sitemap_lastmod ELSE 'x' END AS sitemap_lastmod,
CASE WHEN old.url IS NULL THEN 'discovered' ELSE 'done' END AS status FROM old FULL JOIN new USING (url) WHERE url IS NOT NULL""",
)
def added_pages(spark, d):
    p = table(spark, d, "pages").where("url is not null")
    old = p.where("page_id % 3 = 0").groupBy("url").agg(F.max(F.nullif("sitemap_lastmod", F.lit(""))).alias("sitemap_lastmod")).select("url", F.lit(None).cast("string").alias("published_at"), "sitemap_lastmod", F.lit("done").alias("status"))
    new = p.where("page_id % 2 = 0").groupBy("url").agg(F.concat(F.lit("2024-03-0"), F.max(1 + F.col("page_id") % 9).cast("string")).alias("published_at")).withColumn("sitemap_lastmod", F.lit("x"))
    return crawl.add_pages(old, new)


SITEMAPS = "(SELECT 'https://x/' || (page_id % 40) || '.xml' AS url, CAST(max(page_id % 4) AS INTEGER) AS depth, max(nullif(sitemap_lastmod, '')) AS source_lastmod FROM pages WHERE page_id % 2 = {} GROUP BY 1)"


@query(
    "sitemap_upsert",
    f"""WITH old AS {SITEMAPS.format(0)}, new AS (SELECT url, depth, CASE WHEN depth > 1 THEN source_lastmod END AS source_lastmod FROM (SELECT replace(url, '1.xml', '0.xml') AS url, depth, source_lastmod FROM {SITEMAPS.format(1)})),
j AS (SELECT url, old.depth AS od, old.source_lastmod AS ol, old.url IS NOT NULL AND old.depth IS NOT NULL AS known, new.depth AS nd, new.source_lastmod AS nl FROM old FULL JOIN new USING (url)),
k AS (SELECT *, NOT known OR (nl IS NOT NULL AND nl IS DISTINCT FROM ol) AS again FROM j)
SELECT url, CASE WHEN again THEN nd ELSE od END AS depth, CASE WHEN again THEN nl ELSE ol END AS source_lastmod, CASE WHEN again THEN 'pending' ELSE 'done' END AS status, CASE WHEN again THEN 0 ELSE 7 END AS cursor FROM k""",
)
def sitemap_upsert(spark, d):
    p = table(spark, d, "pages").withColumn("url", F.concat(F.lit("https://x/"), (F.col("page_id") % 40).cast("string"), F.lit(".xml")))
    by = lambda k: p.where(F.col("page_id") % 2 == k).groupBy("url").agg(F.max((F.col("page_id") % 4).cast("int")).alias("depth"), F.max(F.nullif("sitemap_lastmod", F.lit(""))).alias("source_lastmod"))
    old = by(0).select("url", "depth", "source_lastmod", F.lit("done").alias("status"), F.lit(7).alias("cursor"))
    new = by(1).withColumn("url", F.replace("url", F.lit("1.xml"), F.lit("0.xml"))).withColumn("source_lastmod", F.when(F.col("depth") > 1, F.col("source_lastmod")))
    return crawl.upsert_sitemaps(old, new)


ADAPTERS = f"(SELECT {S.host_key('url')} AS domain, selected_method AS method, CASE WHEN page_id % 3 = 0 THEN '' ELSE 's' || page_id % 5 END AS selector, 0.7 AS confidence, 1 AS samples, page_id AS updated_at FROM pages WHERE selected_method IS NOT NULL)"


def _adapters(spark, d):
    p = table(spark, d, "pages").where("selected_method is not null")
    return p.select(U.host_key(F.col("url")).alias("domain"), F.col("selected_method").alias("method"), F.when(F.col("page_id") % 3 == 0, "").otherwise(F.concat(F.lit("s"), (F.col("page_id") % 5).cast("string"))).alias("selector"), F.lit(0.7).alias("confidence"), F.lit(1).alias("samples"), F.col("page_id").alias("updated_at"))


@query("adapters", f"SELECT domain, arg_max(method, updated_at) AS method, arg_max(selector, updated_at) AS selector, CAST(sum(samples) AS BIGINT) AS samples FROM {ADAPTERS} GROUP BY domain")
def adapters(spark, d):
    a = _adapters(spark, d)
    return crawl.upsert_adapters(a.where("updated_at % 2 = 0"), a.where("updated_at % 2 = 1")).select("domain", "method", "selector", "samples")


@query(
    "adapter_matches",
    f"""WITH a AS (SELECT domain, arg_max(method, updated_at) AS m, arg_max(selector, updated_at) AS s FROM {ADAPTERS} GROUP BY domain),
c AS (SELECT c.page_id, candidate_id, method, selector, {S.host_key('url')} AS domain, row_number() OVER (PARTITION BY c.page_id ORDER BY score DESC NULLS LAST, candidate_id) AS rank FROM candidates c JOIN pages p ON c.page_id = p.page_id)
SELECT page_id, arg_min(candidate_id, rank) AS candidate_id FROM c JOIN a USING (domain) WHERE method = m AND (s = '' OR selector = s) GROUP BY page_id""",
)
def adapter_matches(spark, d):
    a = _adapters(spark, d)
    c = table(spark, d, "candidates").join(table(spark, d, "pages").select("page_id", U.host_key(F.col("url")).alias("domain")), "page_id")
    w = Window.partitionBy("page_id").orderBy(F.desc("score"), "candidate_id")
    return crawl.by_adapter(c.withColumn("rank", F.row_number().over(w)), crawl.upsert_adapters(a, a.limit(0)))


@query("settings", "SELECT key, CASE WHEN k % 2 = 0 THEN 'new' ELSE 'old' END AS value FROM (SELECT DISTINCT 'k' || page_id AS key, page_id AS k FROM pages)")
def settings(spark, d):
    p = table(spark, d, "pages").select("page_id").distinct()
    key = F.concat(F.lit("k"), F.col("page_id").cast("string")).alias("key")
    return crawl.put(p.select(key, F.lit("old").alias("value")), p.where("page_id % 2 = 0").select(key, F.lit("new").alias("value")))


@query(
    "shard_cursors",
    """WITH old AS (SELECT 'd' || book_id AS key, book_id % 9 AS l, CASE WHEN book_id % 4 > 0 THEN 1000 END AS s FROM books WHERE book_id % 2 = 0), new AS (SELECT 'd' || book_id AS key, book_id % 9 + 1 AS last_shard, CASE WHEN book_id % 5 = 0 THEN 500 ELSE 1000 END AS shard_size FROM books WHERE book_id % 3 = 0)
SELECT key, CASE WHEN coalesce(s <> shard_size, false) THEN l ELSE coalesce(last_shard, l) END AS last_shard, coalesce(s, shard_size) AS shard_size, coalesce(s <> shard_size, false) AS conflict FROM old FULL JOIN new USING (key)""",
)
def shard_cursors(spark, d):
    b, i = table(spark, d, "books").select("book_id"), F.col("book_id")
    key = F.concat(F.lit("d"), i.cast("string")).alias("key")
    old = b.where(i % 2 == 0).select(key, (i % 9).alias("last_shard"), F.when(i % 4 > 0, 1000).alias("shard_size"))
    return crawl.cursors(old, b.where(i % 3 == 0).select(key, (i % 9 + 1).alias("last_shard"), F.when(i % 5 == 0, 500).otherwise(1000).alias("shard_size")))


@query("next_ids", "SELECT page_id, (SELECT max(page_id) FROM pages WHERE page_id % 2 = 0) + row_number() OVER (ORDER BY page_id) AS dataset_id FROM pages WHERE page_id % 2 = 1")
def next_ids(spark, d):
    p = table(spark, d, "pages").select("page_id")
    return crawl.with_ids(p.where("page_id % 2 = 0").withColumnRenamed("page_id", "dataset_id"), p.where("page_id % 2 = 1"), ["page_id"])


@query("in_flight_items", "SELECT page_id, 'b' || page_id % 7 || '.txt' AS file FROM pages WHERE status = 'done' AND page_id % 7 < 5")
def in_flight_items(spark, d):
    items = table(spark, d, "pages").where("status = 'done'").select("page_id", F.lit("writing").alias("status"), (F.col("page_id") % 7).alias("bundle_id"))
    files = spark.range(5).select(F.col("id").alias("bundle_id"), F.concat(F.lit("b"), F.col("id").cast("string"), F.lit(".txt")).alias("file"))
    return crawl.in_flight(items, files).select("page_id", "file")


@query("bundle_pages", "SELECT page_id, url FROM pages WHERE page_id IN (SELECT page_id FROM candidates WHERE page_id % 7 < 3)")
def bundle_pages(spark, d):
    items = table(spark, d, "candidates").select("page_id", (F.col("page_id") % 7).alias("bundle_id"))
    return crawl.pages_of_bundles(table(spark, d, "pages").select("page_id", "url"), items, spark.range(3).toDF("bundle_id"))


@query("run_counters", "SELECT CAST(count(*) FILTER (kept_blocks > 0) AS BIGINT) AS n_ok, CAST(count(*) FILTER (kept_blocks = 0) AS BIGINT) AS n_skipped, CAST(count(*) FILTER (kept_blocks IS NULL) AS BIGINT) AS n_errors, CAST(coalesce(sum(estimated_tokens) FILTER (kept_blocks > 0), 0) AS BIGINT) AS n_tokens FROM results")
def run_counters(spark, d):
    status = F.when(F.col("kept_blocks") > 0, "ok").when(F.col("kept_blocks") == 0, "skipped").when(F.col("kept_blocks").isNull(), "error")
    return crawl.run_counters(table(spark, d, "results").select(status.alias("status"), F.col("estimated_tokens").alias("tokens")))


@query("ledger_list", LATEST + " SELECT path, category, coalesce(exact_tokens, estimated_tokens) AS tokens FROM now ORDER BY path")
def ledger_list(spark, d):
    return ledger.latest(table(spark, d, "books")).select("path", "category", F.coalesce("exact_tokens", "estimated_tokens").alias("tokens")).orderBy("path")


@query("sorted_paths", "SELECT DISTINCT path FROM documents WHERE path IS NOT NULL AND NOT starts_with(regexp_extract(path, '[^/]*$', 0), '.') ORDER BY path")
def sorted_paths(spark, d):
    return readers.in_order(table(spark, d, "documents").select("path").where("path is not null").distinct())


@query("title_words_left", "SELECT page_id, len(list_filter(list_distinct(regexp_extract_all(lower(title), '\\p{L}+')), lambda w: NOT list_contains(['va', 'bilan', 'uchun'], w))) AS n FROM pages WHERE title IS NOT NULL")
def title_words_left(spark, d):
    w = F.regexp_extract_all(F.lower("title"), F.lit(r"\p{L}+"), F.lit(0))
    return table(spark, d, "pages").where("title is not null").select("page_id", F.size(F.array_except(w, F.array(F.lit("va"), F.lit("bilan"), F.lit("uchun")))).cast("bigint").alias("n"))


@query("ocr_gate", "SELECT path, coalesce(avg(confidence), 0) >= 60 AS good, count(*) FILTER (confidence >= 60) AS good_pages FROM ocr_pages GROUP BY path")
def ocr_gate(spark, d):
    return readers.ocr_gate(table(spark, d, "ocr_pages"), "path")


@query("retention", "SELECT doc_id FROM documents WHERE fetched_at < TIMESTAMP '2024-01-01 00:00:00'")
def retention(spark, d):
    return ledger.expired(table(spark, d, "documents"), "fetched_at", F.lit("2024-01-31").cast("timestamp_ntz"), 30).select("doc_id")


@query("text_column_scan", "SELECT format, count(*) AS n, CAST(sum(length(kept_text)) AS BIGINT) AS chars FROM results GROUP BY format")
def text_column_scan(spark, d):
    return table(spark, d, "results").groupBy("format").agg(F.count("*").alias("n"), F.sum(F.length("kept_text").cast("bigint")).alias("chars"))


@query("stream_dedup", f"SELECT DISTINCT sha1({S.dedup_form('kept_text')}) AS key FROM results WHERE kept_text IS NOT NULL")
def stream_dedup(spark, d):
    """A stream over the files of the table, run until all are read. Which of equal rows comes first is up to the files' order, so
    only the keys are compared."""
    from uuid import uuid4

    from qatlam.runtime import ensure_checkpoint_dir
    from qatlam.streaming.incremental import first_seen, to_table

    schema = table(spark, d, "results").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/results.parquet*").where("kept_text is not null").select(T.content_hash(col("kept_text")).alias("key"))
    folder = f"{ensure_checkpoint_dir(spark)}/stream-{uuid4().hex}"
    return to_table(first_seen(stream, "key"), f"{folder}/out", f"{folder}/state")


@query("download_items", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN CAST(page_id AS VARCHAR) END AS item, CASE WHEN page_id % 3 = 0 THEN 'kitob-' || page_id END AS slug FROM pages")
def download_items(spark, d):
    i = F.col("page_id").cast("string")
    url = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://x.uz/kutubxona?a=1&download="), i, F.lit(":kitob-"), i, F.lit("&b=2"))).otherwise(F.col("url"))
    item, slug = catalogue.download_item(url)
    return table(spark, d, "pages").select("page_id", item.alias("item"), slug.alias("slug"))


@query("robots", f"SELECT page_id, NOT (page_id % 2 = 0 AND starts_with({S.url_part('url', 3)}, '/a')) AS allowed FROM pages WHERE url IS NOT NULL")
def robots(spark, d):
    urls = table(spark, d, "pages").where("url is not null").select("page_id", "url", F.when(F.col("page_id") % 2 == 0, "even").otherwise("odd").alias("host"))
    rules = spark.createDataFrame([("even", "User-agent: *\nDisallow: /a\n")], "host string, rules string")
    return catalogue.allowed(urls, rules).select("page_id", "allowed")


@query("rejected_texts", S.FUNNEL + "SELECT path, page, drop_reason AS reason, b.text FROM funnel f JOIN (SELECT block_id, text FROM blocks) b USING (block_id) WHERE drop_reason IS NOT NULL")
def rejected_texts(spark, d):
    b = table(spark, d, "blocks")
    return files.rejected(clean.cleaned(b).join(b.select("block_id", "text"), "block_id"))
