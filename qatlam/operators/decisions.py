"""Decisions that a language model may take, as injected functions. None is called unless it is given; without one, or where
it fails, every row keeps what the rules say.

A decider maps a list of records to a list of answers and is called once per Arrow batch, on the executors. The rules about its
answers are columns, so they hold whatever answers come.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qatlam.operators.web import STRUCTURED, content_blocks

Decider = Callable[[list[dict]], list[dict | str | None]]
LEAST_CONFIDENCE = 0.65
LEAST_BODY = 250


def asked(rows: DataFrame, columns: list[str], decider: Decider | None, schema: str) -> DataFrame:
    """``rows`` with ``answer``, a struct of ``schema`` made from the decider's JSON or dict; null where none came. The key
    columns stay; a batch whose call raises or gives another number of answers gets nulls."""
    if decider is None:
        return rows.withColumn("answer", F.lit(None).cast(f"struct<{schema}>"))

    @F.pandas_udf("string")
    def ask(records: pd.DataFrame) -> pd.Series:
        try:
            answers = decider(records.to_dict("records"))
        except Exception:  # a decision is optional: no answer is not an error
            answers = []
        if len(answers) != len(records):
            answers = [None] * len(records)
        return pd.Series([a if isinstance(a, str) or a is None else json.dumps(a) for a in answers], dtype=object)

    return rows.withColumn("answer", F.from_json(ask(F.struct(*columns)), f"struct<{schema}>"))


DECISION = "article:boolean,candidate_id:string,confidence:double,complete:boolean,content_block_ids:array<string>,trash_block_ids:array<string>,reason:string"


def selected(decided: DataFrame, candidates: DataFrame) -> DataFrame:
    """(page_id, status, candidate_id, blocks, confidence, selector): what becomes of each page by its ``answer`` (DECISION).
    ``candidates`` hold (page_id, candidate_id, method, selector, blocks array<struct<block_id, text>>). Chosen block ids that the
    candidate does not have send the page to a person; trash ids are taken out of what is left."""
    c = candidates.select("page_id", F.col("candidate_id").alias("_c"), "method", "selector", F.col("blocks").alias("_b"))
    a = F.col("answer")
    j = decided.select("page_id", "answer").join(c, (decided["page_id"] == c["page_id"]) & (a["candidate_id"] == c["_c"]), "left").drop(c["page_id"])
    ids = F.transform("_b", lambda b: b["block_id"])
    wanted, trash = F.coalesce(a["content_block_ids"], F.array().cast("array<string>")), F.coalesce(a["trash_block_ids"], F.array().cast("array<string>"))
    unknown = F.size(F.array_except(wanted, ids)) > 0
    # chosen ids come in the decider's order, else all blocks in theirs
    texts = F.map_from_entries(F.transform("_b", lambda b: F.struct(b["block_id"], b["text"])))
    order = F.when(F.size(wanted) > 0, F.array_distinct(wanted)).otherwise(ids)
    left = F.transform(F.filter(order, lambda i: ~F.array_contains(trash, i)), lambda i: F.try_element_at(texts, i))
    body = content_blocks(F.array_join(left, "\n"))
    j = j.withColumn("_body", body)
    enough = F.length(F.array_join("_body", "\n\n")) >= LEAST_BODY
    status = (
        F.when(a.isNull(), "ai_pending").when(~F.coalesce(a["article"], F.lit(True)), "non_article").when(F.col("_c").isNull(), "manual_review")
        .when(F.coalesce(a["confidence"], F.lit(0.0)) < LEAST_CONFIDENCE, "manual_review").when(~F.coalesce(a["complete"], F.lit(False)), "quality_rejected")
        .when(unknown, "manual_review").when(~enough, "manual_review").otherwise("accepted")
    )
    j = j.withColumn("status", status)
    ok = F.col("status") == "accepted"
    selector = F.when(F.col("method").isin(STRUCTURED), "").otherwise(F.col("selector"))
    return j.select("page_id", "status", F.col("_c").alias("candidate_id"), F.when(ok, F.col("_body")).alias("blocks"), a["confidence"].alias("confidence"), F.when(ok, selector).alias("selector"))


def suggested_category(rows: DataFrame, valid: list[str], decider: Decider | None = None) -> DataFrame:
    """``rows`` (title, text, ...) with ``suggested``: the decider's category where it is a valid one, else null."""
    r = rows.withColumn("_title", F.left("title", F.lit(200))).withColumn("_snippet", F.left("text", F.lit(400)))
    out = asked(r, ["_title", "_snippet"], decider, "category:string")
    return out.withColumn("suggested", F.when(F.col("answer.category").isin(valid), F.col("answer.category"))).drop("answer", "_title", "_snippet")


def dropped_as_noise(blocks: DataFrame, key: list[str], decider: Decider | None = None) -> DataFrame:
    """``blocks`` (key columns, block_id, text, ambiguous) with ``is_noise``: whether the decider drops an ambiguous block of its
    document. It sees the ambiguous blocks only and can drop none but these; no text is changed."""
    doubtful = blocks.where("ambiguous").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("block_id", "text"))).alias("blocks"))
    out = asked(doubtful, ["blocks"], decider, "drop_block_ids:array<string>")
    drop = out.select(*key, F.explode(F.array_intersect("answer.drop_block_ids", F.transform("blocks", lambda b: b["block_id"].cast("string")))).alias("_id")).distinct()
    j = blocks.withColumn("_id", F.col("block_id").cast("string")).join(drop.withColumn("_noise", F.lit(True)), [*key, "_id"], "left")
    return j.withColumn("is_noise", F.coalesce("_noise", F.lit(False)) & F.coalesce("ambiguous", F.lit(False))).drop("_noise", "_id")


def asked_corrections(words: DataFrame, decider: Decider | None = None, batch: int = 100) -> DataFrame:
    """(word, correction) of the distinct words for which the decider knows one; words it answers with null or with themselves
    are left out."""
    if decider is None:
        return words.select("word", F.lit(None).cast("string").alias("correction")).where("false")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[tuple[str, str]] = []
            for i in range(0, len(b), batch):
                part = b["word"].iloc[i : i + batch].tolist()
                try:
                    answers = decider([{"word": w} for w in part])
                except Exception:  # as above
                    answers = [None] * len(part)
                rows.extend((w, a) for w, a in zip(part, answers) if isinstance(a, str) and a and a != w)
            yield pd.DataFrame(rows, columns=["word", "correction"])

    return words.select("word").distinct().mapInPandas(run, "word string, correction string")


def category_of(folder: Column, suggested: Column, default: str = "books") -> Column:
    return F.coalesce(F.nullif(folder, F.lit("uncategorized")), suggested, F.lit(default))
