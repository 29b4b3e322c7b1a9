"""The cleaning funnel: one projection and two aggregations over all blocks, with a reason for every dropped one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qatlam.functions.quality import Thresholds, is_uzbek, language_score, quality_reason, structure_reason
from qatlam.functions.text import content_hash, normalized, repeat_form, strip_garbage, to_latin, token_count
from qatlam.operators.dedup import flag_repeats
from qatlam.operators.ordered import running_total
from qatlam.runtime import cut, fits, widened

#: Running headers (path, hash: some 60 bytes each) up to which they are broadcast.
SHIP_HEADERS = 500_000
#: Characters in a part of a document.
PART_CHARS = 1 << 24


def repeated_texts(blocks: DataFrame, least: int = 3) -> DataFrame:
    """(path, form, n_pages): short texts on several pages of a document. Pages are counted by two map-side combined steps."""
    b = blocks.select("path", "page", repeat_form(F.col("text")).alias("form")).where("form <> '' and length(form) < 100")
    return b.distinct().groupBy("path", "form").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= least)


def structured(blocks: DataFrame, least: int = 3) -> DataFrame:
    """``blocks`` with ``structure_reason``."""
    rep = cut(repeated_texts(blocks, least).select("path", F.xxhash64("form").alias("_form"), F.lit(True).alias("_rep")))
    b = blocks.withColumn("_form", F.xxhash64(repeat_form(F.col("text"))))
    # few texts are running headers: sent to all tasks they spare the shuffle of all texts
    b = b.join(F.broadcast(rep) if fits(rep, SHIP_HEADERS) else rep, ["path", "_form"], "left")
    return b.withColumn("structure_reason", structure_reason(F.col("text"), F.col("page"), F.coalesce("_rep", F.lit(False)))).drop("_rep", "_form")


def cleaned(blocks: DataFrame, t: Thresholds = Thresholds(), least: int = 3) -> DataFrame:
    """(block_id, path, block_idx, page, clean_text, drop_reason): structure, language, quality, normalisation and the first
    of equal paragraphs in the order of path and index. Null texts are too short."""
    # a scan of few files is spread over all cores, as each text costs much work
    b = structured(widened(blocks.select("block_id", "path", "block_idx", "page", F.coalesce("text", F.lit("")).alias("text"))), least)
    # the explode of one element keeps the optimizer from copying this expression into each of its many uses
    b = b.withColumn("latin", F.explode(F.array(strip_garbage(to_latin(F.col("text"))))))
    reason = F.coalesce(
        "structure_reason",
        F.when(~is_uzbek(language_score(F.col("latin")), t=t), "til_ozbekcha_emas"),
        quality_reason(F.col("latin"), t),
    )
    b = b.select("block_id", "path", "block_idx", "page", normalized(F.col("latin")).alias("clean_text"), reason.alias("reason"))
    b = b.withColumn("reason", F.coalesce("reason", F.when(F.col("clean_text") == "", "normalizatsiyadan_song_bosh")))
    b = b.withColumn("key", F.when(F.col("reason").isNull(), content_hash(F.col("clean_text"))))
    # first paragraphs and their rows come from the same table, which is not worked out twice
    b = flag_repeats(cut(b), "key", ["path", "block_idx"])
    return b.select("block_id", "path", "block_idx", "page", "clean_text", F.coalesce("reason", F.when(F.col("is_repeat"), "takror")).alias("drop_reason"))


def reports(blocks: DataFrame, chars_per_token: float = 4.0) -> DataFrame:
    """(path, char_count, estimated_tokens, total_blocks, kept_blocks, dropped_blocks, dropped_pct) of each document: counts
    and sums only, so a path of any size is one row after the map-side combine. ``dropped_pct`` has two places, 0 without blocks."""
    kept = F.col("drop_reason").isNull()
    d = blocks.groupBy("path").agg(F.count("*").alias("total_blocks"), F.count_if(kept).alias("kept_blocks"), F.coalesce(F.sum(F.when(kept, F.length("clean_text").cast("bigint"))), F.lit(0)).alias("_n"))
    # paragraphs are joined by two line breaks
    chars = F.col("_n") + F.greatest(F.col("kept_blocks") - 1, F.lit(0)) * 2
    dropped = F.col("total_blocks") - F.col("kept_blocks")
    return d.select("path", chars.alias("char_count"), token_count(chars, chars_per_token).alias("estimated_tokens"), "total_blocks", "kept_blocks", dropped.alias("dropped_blocks"),
                    F.when(F.col("total_blocks") == 0, 0.0).otherwise(F.round(dropped / F.col("total_blocks") * 100, 2)).alias("dropped_pct"))


def documents(blocks: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(path, part, kept_text): kept paragraphs of each document in order, joined by blank lines, in parts of about
    ``part_chars`` characters, so that no document, however long, is one value; most have one part. Parts are numbered from 0
    and, joined by blank lines, are the document. A document of which nothing is kept has no part."""
    kept = blocks.where("drop_reason is null").select("path", "block_idx", "clean_text")
    sized = running_total(kept, ["path"], ["block_idx"], F.length("clean_text").cast("bigint") + 2)
    part = F.floor(F.col("before") / part_chars).cast("int")
    rows = sized.groupBy("path", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("block_idx", "clean_text"))).alias("_b"))
    return rows.select("path", "part", F.array_join(F.transform("_b", lambda x: x["clean_text"]), "\n\n").alias("kept_text"))
