"""Files of several formats as blocks (path, block_idx, page, text).

Files come from Spark's binary source, so listing and reading are distributed; each is decoded in an Arrow-batched function
by its format's extractor. A file that can't be read has one row with an error and no text.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qatlam.functions import html as H
from qatlam.sources import scanned

ENDINGS = {"pdf": "pdf", "djvu": "djvu", "djv": "djvu", "epub": "epub", "docx": "docx", "pptx": "pptx", "fb2": "fb2", "html": "html", "htm": "html", "txt": "txt"}
Block = tuple[int, str]


def format_of(path: Column) -> Column:
    """Format by file ending, null where it tells nothing."""
    ending = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.coalesce(*[F.when(ending == k, v) for k, v in ENDINGS.items()])


def sniffed(path: str, content: bytes) -> str:
    """Format by ending, else by the first bytes."""
    ending = path.rpartition(".")[2].lower()
    if ending in ENDINGS:
        return ENDINGS[ending]
    if content.startswith(b"%PDF-"):
        return "pdf"
    if content.startswith(b"PK\x03\x04"):
        try:
            names = zipfile.ZipFile(io.BytesIO(content)).namelist()
        except zipfile.BadZipFile:
            return "unknown"
        if "mimetype" in names or any(n.endswith(".opf") for n in names):
            return "epub"
        for start, kind in (("word/", "docx"), ("ppt/", "pptx"), ("[Content_Types].xml", "docx")):
            if any(n.startswith(start) for n in names):
                return kind
        return "unknown"
    return "html" if content[:2048].lstrip().startswith(b"<") else "txt"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def txt(content: bytes) -> list[Block]:
    parts = [p.strip() for p in content.decode("utf-8", "replace").split("\n\n")]
    return list(enumerate(p for p in parts if p))


def docx(content: bytes) -> list[Block]:
    root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
    paragraphs = ["".join(t.text or "" for t in p.iter() if _local(t.tag) == "t").strip() for p in root.iter() if _local(p.tag) == "p"]
    return [(i, p) for i, p in enumerate(paragraphs) if p]


def pptx(content: bytes) -> list[Block]:
    z = zipfile.ZipFile(io.BytesIO(content))
    slides = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
    out = []
    for i, name in enumerate(slides):
        for body in ElementTree.fromstring(z.read(name)).iter():
            if _local(body.tag) == "txBody":
                t = "\n".join("".join(r.text or "" for r in p.iter() if _local(r.tag) == "t") for p in body if _local(p.tag) == "p").strip()
                if t:
                    out.append((i, t))
    return out


def epub(content: bytes) -> list[Block]:
    z = zipfile.ZipFile(io.BytesIO(content))
    opf = next(n for n in z.namelist() if n.endswith(".opf"))
    root, base = ElementTree.fromstring(z.read(opf)), opf.rpartition("/")[0]
    files = {i.get("id"): i.get("href") for i in root.iter() if _local(i.tag) == "item"}
    spine = [files.get(i.get("idref")) for i in root.iter() if _local(i.tag) == "itemref"]
    out: list[Block] = []
    for href in spine:
        name = f"{base}/{href}" if base else href
        if href and name in z.namelist():
            tree = H.parse(z.read(name).decode("utf-8", "replace"))
            for n in tree.walk():
                if n.tag in ("p", "h1", "h2", "h3", "li") and (t := n.text()):
                    out.append((len(out), t))
    return out


def fb2(content: bytes) -> list[Block]:
    root = ElementTree.fromstring(content)
    out = []
    for body in (b for b in root.iter() if _local(b.tag) == "body"):
        for p in body.iter():
            if _local(p.tag) == "p":
                out.append("".join(p.itertext()).strip())
    return [(i, p) for i, p in enumerate(out) if p]


def web_page(content: bytes) -> list[Block]:
    page = content.decode("utf-8", "replace")
    best = max(H.candidates(page), key=lambda c: c[3], default=None)
    parts = best[2].split("\n\n") if best else H.blocks(H.parse(page))
    return list(enumerate(parts))


#: Format -> extractor. Of pdf and djvu the text layers are read; ``register`` adds extractors that do more, such as OCR.
EXTRACTORS: dict[str, Callable[[bytes], list[Block]]] = {"txt": txt, "docx": docx, "pptx": pptx, "epub": epub, "fb2": fb2, "html": web_page, "pdf": scanned.pdf, "djvu": scanned.djvu}


def register(kind: str, extractor: Callable[[bytes], list[Block]]) -> None:
    EXTRACTORS[kind] = extractor


def files(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder as Spark's binary source lists them; hidden ones are left out."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def in_order(files: DataFrame, path: str = "path") -> DataFrame:
    """Files by path, without hidden ones."""
    return files.where(~F.regexp_extract(path, "[^/]*$", 0).startswith(".")).orderBy(path)


def ocr_gate(words: DataFrame, *key: str, least: float = 60.0) -> DataFrame:
    """Whether the mean confidence of each file or page, 0 if unknown, is enough, and how many of its rows are good."""
    return words.groupBy(*key).agg((F.coalesce(F.avg("confidence"), F.lit(0.0)) >= least).alias("good"), F.count_if(F.col("confidence") >= least).alias("good_pages"))


def file_blocks(binary: DataFrame) -> DataFrame:
    """(path, format, block_idx, page, text, error) of (path, content)."""
    extractors = dict(EXTRACTORS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                kind = sniffed(path, content)
                try:
                    rows.extend((path, kind, k, page, t, None) for k, (page, t) in enumerate(extractors[kind](content)))
                except Exception as e:  # one broken file must not end the task
                    rows.append((path, kind, None, None, None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(rows, columns=["path", "format", "block_idx", "page", "text", "error"]).astype({"block_idx": "Int64", "page": "Int64"})

    return binary.select("path", "content").mapInPandas(run, "path string, format string, block_idx int, page int, text string, error string")


def parquet_texts(spark: SparkSession, folder: str, split: str, column: str = "text") -> DataFrame:
    """(file_no, row_index, text) of a dataset's split, whose files are named like train-00000-of-00042.parquet. Only the
    text column is read."""
    d = spark.read.option("pathGlobFilter", f"{split}-*-of-*.parquet").parquet(folder)
    number = F.regexp_extract("_metadata.file_name", r"-(\d+)-of-\d+\.parquet$", 1).cast("int")
    return d.select(number.alias("file_no"), F.col("_metadata.row_index").alias("row_index"), F.col(column).alias("text"))


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(loc, lastmod) of a sitemap's entries, the newest first."""
    import gzip

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for content in b["content"]:
                raw = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                for e in ElementTree.fromstring(raw).iter():
                    if _local(e.tag) in ("url", "sitemap"):
                        one = lambda names, e=e: next(((x.text or "").strip() for x in e.iter() if _local(x.tag) in names), None)
                        rows.append((one({"loc"}), one({"lastmod", "publication_date"}), _local(e.tag) == "sitemap"))
            yield pd.DataFrame(rows, columns=["loc", "lastmod", "is_index"])

    d = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "loc string, lastmod string, is_index boolean")
    return d.where("loc is not null").orderBy(F.coalesce("lastmod", F.lit("")).desc(), "loc")
