"""Filling containers of fixed capacity with texts (problem 8).

Bounded-space online packing: every task keeps ``OPEN`` windows per container kind, puts each text into the one that it
fills best and, where none has room, closes the fullest and opens a new one. What is left open at the end of the tasks is
few; these windows are merged whole, by best fit in decreasing order, in groups of tasks and then once more. Texts are
read once and never shuffled: only assignments leave the tasks.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qatlam.llm.tokens import TOKENIZERS, counter
from qatlam.runtime import cut

OPEN = 32
#: Open windows of so many tasks are merged in one group of the first round.
TASKS = 64

_OUT = "container_kind string, capacity int, container string, doc_id bigint, piece int, tokens int, used int, open boolean"


class Packer:
    """Open windows of one container kind, kept in order of the room they have."""

    def __init__(self, kind: str, capacity: int, name: str):
        self.kind, self.capacity, self.name = kind, capacity, name
        self.windows: list[tuple[int, int, list[tuple[int, int, int]]]] = []  # (room, number, items)
        self.number = 0

    def put(self, doc: int, piece: int, size: int) -> Iterator[tuple]:
        i = bisect_left(self.windows, (size, -1, []))
        if i < len(self.windows):
            room, number, items = self.windows.pop(i)
        else:
            if len(self.windows) >= OPEN:
                yield from self.close(self.windows.pop(0), False)
            room, number, items = self.capacity, self.number, []
            self.number += 1
        items.append((doc, piece, size))
        if room == size:
            yield from self.close((0, number, items), False)
        else:
            insort(self.windows, (room - size, number, items))

    def close(self, window: tuple, still_open: bool) -> Iterator[tuple]:
        room, number, items = window
        for doc, piece, size in items:
            yield self.kind, self.capacity, f"{self.name}-{number}", doc, piece, size, self.capacity - room, still_open

    def rest(self) -> Iterator[tuple]:
        for w in self.windows:
            yield from self.close(w, True)


def _pack(documents: DataFrame, kinds: list[tuple[str, int]], tokenizer: str, folder: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, kept = counter(tokenizer, folder), {}
        task = TaskContext.get().partitionId()
        packers = [Packer(k, c, f"{k}-{task}") for k, c in kinds]
        names = [c.split()[0] for c in _OUT.split(", ")]
        for b in batches:
            rows: list[tuple] = []
            for doc, text in zip(b["doc_id"], b["text"]):
                size = count(text, kept) if isinstance(text, str) and text.strip() else 0
                if not size:
                    continue
                for p in packers:
                    left, piece = size, 0
                    while left > 0:
                        take = min(left, p.capacity)
                        rows.extend(p.put(doc, piece, take))
                        left, piece = left - take, piece + 1
            yield pd.DataFrame(rows, columns=names)
        yield pd.DataFrame([r for p in packers for r in p.rest()], columns=names)

    return documents.select("doc_id", "text").mapInPandas(run, _OUT)


def _merge(windows: DataFrame, group: list[str]) -> DataFrame:
    """(container_kind, container, target): open windows of a group put together, best fit in decreasing order."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity = int(pdf["capacity"].iloc[0])
        bins: list[tuple[int, str]] = []
        rows = []
        for used, name in sorted(zip(pdf["used"], pdf["container"]), key=lambda x: (-x[0], x[1])):
            i = bisect_left(bins, (used, ""))
            if i < len(bins):
                room, target = bins.pop(i)
            else:
                room, target = capacity, name
            insort(bins, (room - used, target))
            rows.append((pdf["container_kind"].iloc[0], name, target))
        return pd.DataFrame(rows, columns=["container_kind", "container", "target"])

    return windows.groupBy(*group).applyInPandas(run, "container_kind string, container string, target string")


def packed(documents: DataFrame, containers: DataFrame, tokenizer: str = "pieces", folder: str = TOKENIZERS) -> DataFrame:
    """(container_kind, capacity, container, doc_id, piece, tokens): every text that is not blank in one container of each kind,
    or, if longer than a container, in pieces of which all but the last fill one each. Null, empty and blank texts are in none.
    ``containers`` is a short fixed list; kinds without a positive capacity are left out, a kind given twice counts with
    its largest capacity. Tasks pack their own partition of the scan in its order, so a repeated task gives the same result."""
    kinds = [(r["container_kind"], r["c"]) for r in containers.where("container_kind is not null and capacity_tokens > 0").groupBy("container_kind").agg(F.max("capacity_tokens").alias("c")).orderBy("container_kind").collect()]
    rows = cut(_pack(documents, kinds, tokenizer, folder))
    left = rows.where("open").groupBy("container_kind", "capacity", "container").agg(F.max("used").alias("used"))
    task = (F.element_at(F.split("container", "-"), -2).cast("int") / TASKS).cast("int")
    first = cut(_merge(left.withColumn("g", task), ["container_kind", "g"]))
    # of the first round only the windows under half full meet again: at most one a group can be, whatever the data
    sizes = first.join(left, ["container_kind", "container"]).groupBy("container_kind", "capacity", F.col("target").alias("container")).agg(F.sum("used").cast("int").alias("used"))
    half = sizes.where("used * 2 <= capacity")
    second = _merge(half, ["container_kind"]).select("container_kind", F.col("container").alias("target"), F.col("target").alias("final"))
    final = first.join(second, ["container_kind", "target"], "left").select("container_kind", "container", F.coalesce("final", "target").alias("target"))
    return rows.join(final, ["container_kind", "container"], "left").select("container_kind", "capacity", F.coalesce("target", "container").alias("container"), "doc_id", "piece", "tokens")


def fill(assigned: DataFrame) -> DataFrame:
    """Per kind the number of containers, their tokens and the share of their room that is used."""
    c = assigned.groupBy("container_kind", "capacity", "container").agg(F.sum("tokens").alias("used"))
    return c.groupBy("container_kind", "capacity").agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), (F.sum("used") / (F.count("*") * F.max("capacity"))).alias("fill"))
