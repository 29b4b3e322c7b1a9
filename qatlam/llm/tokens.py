"""Tokens per document and per slice (problem 4).

For a vocabulary that is applied by longest match, the counter is a trie whose nodes carry failure links: where no child
fits, the link leads to the node of the rest of the text that is already read, and the tokens that leave on the way are
counted beforehand. Each character is read once, whatever the tokens' lengths. Words recur, so their counts are kept; a
document is the sum of its words. Byte-pair vocabularies, also the public 32k pieces, are counted with their own library,
which applies their merges; the queries use the pieces. Longest match over the same pieces gives other numbers.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folder of the public tokenizers' files.
TOKENIZERS = "/opt/tokenizers"
#: Words whose counts a task keeps at most; beyond it the oldest are dropped, which costs time and changes no count.
KEEP = 1_000_000

_SPLIT = re.compile(r"\S+")


class LongestMatch:
    """Counts the tokens of greedy longest match. A word starts with ``mark``; a character that no token covers counts as
    its UTF-8 bytes, as in vocabularies with byte fallback."""

    def __init__(self, vocabulary: list[str], mark: str = "▁"):
        self.mark = mark
        self.child: list[dict[str, int]] = [{}]
        self.token: list[bool] = [False]
        for t in vocabulary:
            node = 0
            for c in t:
                nxt = self.child[node].get(c)
                if nxt is None:
                    nxt = self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.token.append(False)
                node = nxt
            if node:
                self.token[node] = True
        # link[n]: where to go on when node n has no fitting child; pops[n]: tokens that leave on the way.
        self.link = [-1] * len(self.child)
        self.pops = [0] * len(self.child)
        queue = deque()
        for c, n in self.child[0].items():
            self.link[n], self.pops[n] = 0, 1 if self.token[n] else len(c.encode())
            queue.append((n, c))
        while queue:
            n, text = queue.popleft()
            for c, m in self.child[n].items():
                if self.token[m]:
                    self.link[m], self.pops[m] = 0, 1
                else:
                    at, pops = self.link[n], self.pops[n]
                    while at >= 0 and c not in self.child[at]:
                        pops += self.pops[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[m], self.pops[m] = self.child[at][c], pops
                    else:
                        # c begins no token and stands alone
                        self.link[m], self.pops[m] = 0, pops + len(c.encode())
                queue.append((m, text + c))

    def count(self, word: str) -> int:
        node = total = 0
        for c in word:
            while True:
                nxt = self.child[node].get(c)
                if nxt is not None:
                    node = nxt
                    break
                if node == 0:
                    total += len(c.encode())
                    break
                total += self.pops[node]
                node = self.link[node]
        while node:
            total += self.pops[node]
            node = self.link[node]
        return total

    def text(self, text: str, kept: dict[str, int]) -> int:
        total = 0
        for w in _SPLIT.findall(text):
            n = kept.get(w)
            if n is None:
                if len(kept) >= KEEP:
                    kept.clear()
                n = kept[w] = self.count(self.mark + w)
            total += n
        return total


def piece_vocabulary(folder: str = TOKENIZERS) -> list[str]:
    """The pieces of the public 32k vocabulary, without control and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


#: No piece has a space behind another sign, so no merge goes on over the start of a run of spaces.
_SPACED = re.compile("[ ▁]+[^ ▁]*")


def _piece_counter(folder: str) -> Callable[[str, dict[str, int]], int]:
    """Exact counts of the public 32k pieces, white space included; words with the spaces before them are kept."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")

    def count(text: str, kept: dict[str, int]) -> int:
        total = 0
        # the library puts a space before the text; it also does so before each word given to it, so one is taken off
        for w in _SPACED.findall(" " + text) if text else []:
            n = kept.get(w)
            if n is None:
                if len(kept) >= KEEP:
                    kept.clear()
                n = kept[w] = len(sp.encode(w[1:])) if len(w) > 1 else 1
            total += n
        return total

    return count


def _byte_counter(folder: str) -> Callable[[str, dict[str, int]], int]:
    """Exact counts of the byte-level vocabulary for many languages; pieces of text are kept by the library's pattern."""
    import ast
    import base64

    import regex
    import tiktoken

    # the splitting pattern is a constant of the tokenizers' module, which is read and not run
    with open(f"{folder}/__init__.py", encoding="utf-8") as f:
        constants = {t.id: n.value for n in ast.parse(f.read()).body if isinstance(n, ast.Assign) for t in n.targets if isinstance(t, ast.Name)}
    split_pattern = ast.literal_eval(constants["PATTERN"])
    with open(f"{folder}/byte_bpe_multi_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=split_pattern, mergeable_ranks=ranks, special_tokens={})
    pattern = regex.compile(split_pattern)

    def count(text: str, kept: dict[str, int]) -> int:
        total = 0
        for w in pattern.findall(text):
            n = kept.get(w)
            if n is None:
                if len(kept) >= KEEP:
                    kept.clear()
                n = kept[w] = len(own.encode_ordinary(w))
            total += n
        return total

    return count


def counter(kind: str = "pieces", folder: str = TOKENIZERS) -> Callable[[str, dict[str, int]], int]:
    """``pieces``: the public 32k pieces as their library counts; ``longest``: longest match over them, white space left out;
    ``bytes``: the byte-level vocabulary for many languages."""
    if kind == "longest":
        return LongestMatch(piece_vocabulary(folder)).text
    return {"pieces": _piece_counter, "bytes": _byte_counter}[kind](folder)


def with_tokens(texts: DataFrame, key: str, kind: str = "pieces", folder: str = TOKENIZERS, text: str = "text") -> DataFrame:
    """(key, n_tokens) of each row: 0 for an empty text, null for a null one. The vocabulary is built once per task from the
    public file, which every executor has under ``folder``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(kind, folder)
        kept: dict[str, int] = {}
        for b in batches:
            n = [count(t, kept) if isinstance(t, str) else None for t in b[text]]
            yield pd.DataFrame({key: b[key], "n_tokens": pd.array(n, dtype="Int64")})

    return texts.select(key, text).mapInPandas(run, f"{key} {texts.schema[key].dataType.simpleString()}, n_tokens bigint")


def slice_tokens(documents: DataFrame, kind: str = "pieces", folder: str = TOKENIZERS) -> DataFrame:
    """Documents and tokens by source, normalised language and category, with subtotals for every subset of the three
    (null in a column that is summed over, told apart by ``level``). Null texts count as documents without tokens; labels
    that are only spelled differently are one. Counts are summed before the shuffle, so a source of any size costs little."""
    from qatlam.llm.language import label_code

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(kind, folder)
        kept: dict[str, int] = {}
        for b in batches:
            n = [count(t, kept) if isinstance(t, str) else 0 for t in b["text"]]
            s = pd.DataFrame({"source": b["source"], "lang": b["lang"], "category": b["category"], "n_documents": 1, "n_tokens": n})
            yield s.groupby(["source", "lang", "category"], dropna=False, as_index=False).sum()

    plain = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    d = documents.select(plain("source").alias("source"), label_code(F.col("lang")).alias("lang"), plain("category").alias("category"), "text")
    part = d.mapInPandas(run, "source string, lang string, category string, n_documents bigint, n_tokens bigint")
    return part.cube("source", "lang", "category").agg(F.sum("n_documents").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"), F.grouping_id().cast("int").alias("level"))


def category_code(category: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(category)), F.lit("")), F.lit("uncategorized"))


def ledger_tokens(books: DataFrame, fallback_ratio: float = 4.0) -> DataFrame:
    """Totals by category over the current row of each path that is no duplicate: exact tokens where known, else the
    estimate, else characters by ``fallback_ratio``. The current row is the one processed last, ties broken by ``book_id``;
    negative counts are treated as unknown."""
    r = F.struct(F.coalesce("processed_at", F.lit("0001-01-01").cast("timestamp")).alias("t"), "book_id", "category", "exact_tokens", "estimated_tokens", "char_count", "dedup_status")
    now = books.where("path is not null").groupBy("path").agg(F.max(r).alias("r")).select("r.*").where("dedup_status is null")
    known = lambda c: F.when(F.col(c) >= 0, F.col(c))
    tokens = F.coalesce(known("exact_tokens"), known("estimated_tokens"), F.bround(known("char_count") / fallback_ratio).cast("bigint"), F.lit(0))
    return now.groupBy(category_code(F.col("category")).alias("category")).agg(
        F.count("*").alias("n_books"), F.sum(tokens).alias("n_tokens"), F.count_if(F.col("exact_tokens") >= 0).alias("n_exact"))
