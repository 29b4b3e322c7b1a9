import pytest
from pyspark.sql import functions as F

from qatlam.operators import crawl, decisions, dedup, ledger, ordered, spelling, web
from qatlam.plans import clean


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: [(x is None, str(x)) for x in r])


def test_shards(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "i int")
    assert rows(ordered.shards(df, ["i"], 2), "i", "shard") == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3)]
    assert rows(ordered.shards(df, ["i"], 2, skip=1, limit=3), "i", "shard") == [(1, 1), (2, 1), (3, 2)]
    assert ordered.shards(df.where("i > 9"), ["i"], 2).count() == 0


def test_budget_keeps_the_row_that_crosses(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 5), ("b", 4, 100), ("b", 5, None)], "c string, i int, n int")
    assert rows(ordered.until_budget(df, ["c"], ["i"], F.col("n"), F.lit(8)), "i") == [(1,), (2,), (4,)]


@pytest.mark.parametrize("parts", ["1", "7"])
def test_keep_first(spark, parts):
    df = spark.createDataFrame([("x", 3, 0), ("x", 1, 0), ("x", 2, 0), (None, 4, 0), (None, 5, 0), ("y", 6, 0)], "k string, i int, z int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert rows(dedup.keep_first(df, "k", ["i"]), "i") == [(1,), (4,), (5,), (6,)]
        assert rows(dedup.duplicate_groups(df.withColumn("path", F.col("i").cast("string")), "k"), "k", "kept", "n_duplicates") == [("x", "1", 2)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def log(spark):
    data = [(1, "p", "books", 100, None, "2024-01-01", None), (2, "p", "books", 110, None, "2024-01-02", None), (3, "q", "books", 1, 110, "2024-01-01", None), (4, "r", "education", 110, None, None, None), (5, "s", "books", 9, 9, "2024-01-01", "duplicate")]
    df = spark.createDataFrame(data, "book_id int, path string, category string, estimated_tokens int, exact_tokens int, t string, dedup_status string")
    return df.withColumn("processed_at", F.col("t").cast("timestamp")).drop("t")


def test_ledger(spark, log):
    now = ledger.latest(log)
    assert rows(ledger.collected(now), "category", "collected_tokens") == [("books", 220), ("education", 110)]
    p = ledger.progress(now, {"books": 440, "web_news": 0})
    assert rows(p, "category", "progress_pct") == [("JAMI", 50.0), ("books", 50.0), ("web_news", 0.0)]
    marked = ledger.mark_duplicates(now, spark.createDataFrame([("q",)], "path string"))
    assert rows(marked.where("dedup_status is not null"), "path") == [("q",), ("s",)]
    assert rows(ledger.removed(now, category="books"), "path") == [("r",)]
    assert ledger.removed(now).count() == 0
    assert rows(ledger.unprocessed(spark.createDataFrame([("p",), ("z",)], "path string"), now), "path") == [("z",)]


def test_insert_or_fill(spark):
    t = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, v string, n int")
    n = spark.createDataFrame([("a", "y", 9), ("c", "z", 3)], "k string, v string, n int")
    assert rows(ledger.insert_or_fill(t, n, "k"), "k", "v", "n") == [("a", "y", 1), ("b", "x", 2), ("c", "z", 3)]


def test_spelling(spark):
    trusted = spark.createDataFrame([("qayta",), ("qaha",), ("kaxa",)], "word string")
    found = spark.createDataFrame([("kayta",), ("kaha",), ("qayta",)], "word string")
    assert rows(spelling.corrections(found, trusted), "word", "correction") == [("kayta", "qayta")]


def test_reachable(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 6)], "source int, target int")
    seeds = spark.createDataFrame([(1,)], "page int")
    assert rows(web.reachable(links, seeds), "page", "depth") == [(1, 0), (2, 1), (3, 2)]


def test_bundles(spark):
    data = [("d", 1, "2024-05-03", 150, 0), ("d", 2, "2024-05-02", 150, 1), ("d", 3, "2024-04-30", 40, 2), ("d", 4, "2024-05-01", 10, 3), ("e", 5, None, 10, 0)]
    df = spark.createDataFrame(data, "domain string, article_id long, day string, size int, seq int")
    assert rows(web.bundled(df, 200), "article_id", "bundle") == [(1, 1), (2, 2), (3, 2), (4, 3), (5, 1)]


def test_within_budget(spark):
    df = spark.createDataFrame([(1, 1, 50), (1, 2, 60), (2, 1, 500)], "k int, i int, n int")
    assert rows(web.within_budget(df, ["k"], ["i"], F.col("n"), 100), "k", "i") == [(1, 1), (2, 1)]


def test_content_blocks(values):
    assert values(web.content_blocks, ["Reklama\nMatn bir.\nmatn, BIR\nFoto: x\nIkki"]) == [["Matn bir.", "Ikki"]]


def test_funnel(spark):
    uz = "Бу китоб ва унинг дафтари билан бирга ўқилади, лекин ҳали тугамаган."
    data = [(1, "a", 0, 9, uz), (2, "a", 1, 9, "The quick brown fox jumps over lazy dogs today"), (3, "a", 2, 9, "va bu"), (4, "b", 0, 9, uz), (5, "b", 1, 9, None)]
    df = spark.createDataFrame(data, "block_id int, path string, block_idx int, page int, text string")
    got = dict(rows(clean.cleaned(df), "block_id", "drop_reason"))
    assert got == {1: None, 2: "til_ozbekcha_emas", 3: "juda_qisqa", 4: "takror", 5: "til_ozbekcha_emas"}
    funnel = clean.cleaned(df).cache()
    assert rows(clean.reports(funnel), "path", "total_blocks", "kept_blocks", "dropped_pct") == [("a", 3, 1, 66.67), ("b", 2, 0, 100.0)]
    assert [(r.path, r.part) for r in clean.documents(funnel).collect()] == [("a", 0)]
    assert clean.cleaned(df.where("block_id > 9")).count() == 0


def test_documents_in_parts(spark):
    rows_ = [("a", i, f"matn {i} " + "x" * 10, None) for i in range(12)] + [("b", 0, "bir", None), ("b", 1, "yo'q", "takror"), ("c", 0, "hech", "takror")]
    b = spark.createDataFrame(rows_, "path string, block_idx int, clean_text string, drop_reason string")
    whole = {r.path: r.kept_text for r in clean.documents(b).collect()}
    assert set(whole) == {"a", "b"} and whole["b"] == "bir"
    parts = clean.documents(b, 40).orderBy("path", "part").collect()
    assert len(parts) > 3 and "\n\n".join(r.kept_text for r in parts if r.path == "a") == whole["a"]
    got = {r.path: r for r in clean.reports(b).collect()}
    assert got["a"].char_count == len(whole["a"]) and got["c"].char_count == 0 and got["b"].dropped_pct == 50.0


def test_spelling_of_lines(spark):
    fixes = spark.createDataFrame([("kalam", "qalam"), ("olmo", "olma")], "word string, correction string")
    t = spark.createDataFrame([(1, "Kalam,  va olmo!\n   \nolmozor"), (2, None), (3, ""), (4, "hech narsa")], "id int, text string")
    assert rows(spelling.corrected_lines(t, "id", fixes), "id", "corrected") == [(1, "Qalam, va olma!\n   \nolmozor"), (3, ""), (4, "hech narsa")]
    assert spelling.corrected_lines(t, "id", fixes.where("false")).count() == 3


def test_crawl_state(spark):
    pages = spark.createDataFrame([("u1", None, "2024", "done"), ("u2", "2023-01-01", None, "done")], "url string, published_at string, sitemap_lastmod string, status string")
    new = spark.createDataFrame([("u1", "2024-05-06", "2025"), ("u2", None, "2025"), ("https://x.uz/2024/3/1/a", None, None), ("u3", None, "s"), ("u3", None, "s"), (None, None, None)], "url string, published_at string, sitemap_lastmod string")
    assert rows(crawl.add_pages(pages, new), "url", "published_at", "sitemap_lastmod", "status") == [
        ("https://x.uz/2024/3/1/a", "2024-03-01T00:00:00+00:00", None, "discovered"), ("u1", "2024-05-06T00:00:00+00:00", "2025", "done"), ("u2", "2023-01-01", None, "done"), ("u3", None, "s", "discovered")]
    cursors = crawl.cursors(spark.createDataFrame([("a", 3, 1000), ("b", 5, None)], "key string, last_shard int, shard_size int"), spark.createDataFrame([("a", 4, 500), ("b", 6, 1000), ("c", 1, 10)], "key string, last_shard int, shard_size int"))
    assert rows(cursors) == [("a", 3, 1000, True), ("b", 6, 1000, False), ("c", 1, 10, False)]
    rank = crawl.places(spark.createDataFrame([("x", i) for i in (5, 3, 9)] + [("y", 1)], "k string, v int"), ["k"], [F.desc("v")])
    assert rows(rank, "k", "v", "place") == [("x", 3, 3), ("x", 5, 2), ("x", 9, 1), ("y", 1, 1)]


def test_decisions_keep_the_rules(spark):
    text = "Bu maqola matnining uzun bir bo'lagi bo'lib unda ancha so'z bor. " * 6
    c = spark.createDataFrame([(i, "c1", "dom", "div.a", [("b1", text), ("b2", "Reklama"), ("b3", "Oxirgi gap.")]) for i in range(8)], "page_id int, candidate_id string, method string, selector string, blocks array<struct<block_id:string,text:string>>")
    good = {"candidate_id": "c1", "confidence": 0.9, "complete": True, "content_block_ids": ["b3", "b1"]}
    answers = {0: good, 1: {**good, "article": False}, 2: {**good, "candidate_id": "c9"}, 3: {**good, "confidence": 0.5}, 4: {**good, "complete": False}, 5: {**good, "content_block_ids": ["b7"]}, 6: {**good, "trash_block_ids": ["b1"]}, 7: None}
    decided = decisions.asked(spark.createDataFrame([(i,) for i in range(8)], "page_id int"), ["page_id"], lambda rs: [answers[r["page_id"]] for r in rs], decisions.DECISION)
    got = {r.page_id: r for r in decisions.selected(decided, c).collect()}
    assert [got[i].status for i in range(8)] == ["accepted", "non_article", "manual_review", "manual_review", "quality_rejected", "manual_review", "manual_review", "ai_pending"]
    assert got[0].blocks == ["Oxirgi gap.", text.strip()] and got[0].selector == "div.a" and got[3].blocks is None
    assert decisions.asked(decided.select("page_id"), ["page_id"], None, decisions.DECISION).where("answer is not null").count() == 0
    t = spark.createDataFrame([("a", "b"), ("c", None)], "title string, text string")
    assert rows(decisions.suggested_category(t, ["books"], lambda rs: [{"category": "books"} if r["_title"] == "a" else "broken" for r in rs]), "title", "suggested") == [("a", "books"), ("c", None)]
    b = spark.createDataFrame([("p", 1, "x", True), ("p", 2, "y", False), ("q", 3, "z", True)], "path string, block_id long, text string, ambiguous boolean")

    def noise(rs):
        return [{"drop_block_ids": ["1", "2", "99"]} for _ in rs]

    assert rows(decisions.dropped_as_noise(b, ["path"], noise), "block_id", "is_noise") == [(1, True), (2, False), (3, False)]
    assert decisions.dropped_as_noise(b, ["path"]).where("is_noise").count() == 0

    def failing(rs):
        raise RuntimeError

    words = spark.createDataFrame([("kitop",), ("kitop",), ("suv",)], "word string")
    assert rows(decisions.asked_corrections(words, lambda rs: ["kitob" if r["word"] == "kitop" else None for r in rs])) == [("kitop", "kitob")]
    assert decisions.asked_corrections(words, failing).count() == decisions.asked_corrections(words).count() == 0
