"""Readers of sheets, feeds and documents, writers of reports, and copies between stores."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import dedup, retrieval
from lectern.sources.stores import TableStore, cell

# ---------------------------------------------------------------- sheets


def read_any_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sheets saved as CSV with a header, all cells as text with marks of emptiness as "", and the file's name. Files of one folder share their header."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return raw.select(*[cell(F.col(f"`{c}`")).alias(c.strip()) for c in raw.columns], F.col("_metadata.file_name").alias("file"))


def link_column(sheet: DataFrame) -> str | None:
    """The column whose cells most often are web addresses (of equals the first); None if none has any."""
    columns = [c for c in sheet.columns if c != "file"]
    if not columns:
        return None
    counts = sheet.agg(*[F.count_if(F.col(f"`{c}`").rlike(r"^https?://\S+$")).alias(str(n)) for n, c in enumerate(columns)]).first()
    best = max(range(len(columns)), key=lambda n: (counts[n], -n))
    return columns[best] if counts[best] else None


def with_links(sheet: DataFrame) -> DataFrame:
    """The rows of a sheet that have a link, with it as ``url``; no rows for a sheet without links."""
    found = link_column(sheet)
    return sheet.limit(0).withColumn("url", F.lit("")) if found is None else sheet.withColumn("url", F.col(f"`{found}`")).where("url <> ''")


def normalised_columns(sheet: DataFrame, columns: dict[str, Sequence[str]]) -> DataFrame:
    """The columns by any of their names, case and blanks aside; of several the first that isn't empty; missing ones ""."""
    there = {re.sub(r"\W+", "", c).lower(): c for c in sheet.columns}
    picked = []
    for out, tries in columns.items():
        found = [there[k] for t in [out, *tries] if (k := re.sub(r"\W+", "", t).lower()) in there]
        picked.append(F.coalesce(*[F.nullif(cell(F.col(f"`{c}`")), F.lit("")) for c in found], F.lit("")).alias(out))
    return sheet.select(*picked)


def ids_of(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The different ids of a column of a CSV file."""
    return read_any_sheet(spark, path).select(F.col(f"`{column}`").alias("id")).where("id <> ''").distinct()


def header_errors(sheet: DataFrame, expected: Sequence[str]) -> list[str]:
    """What a sheet's header lacks or has besides."""
    there = [c for c in sheet.columns if c != "file"]
    return [f"missing:{c}" for c in expected if c not in there] + [f"unexpected:{c}" for c in there if c not in expected]


def write_report(rows: DataFrame, path: str, kind: str = "csv") -> None:
    """A report as CSV with header, JSON lines or parquet."""
    if kind == "csv":
        rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif kind in ("json", "parquet"):
        getattr(rows.write.mode("overwrite"), kind)(path)
    else:
        raise ValueError(f"no such kind of report: {kind}")


def written_back(rows: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` with those columns taken from ``updates`` where it has the key and a value. ``updates`` has one row a key."""
    new = updates.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = rows.join(new, key, "left")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])


# ---------------------------------------------------------------- registries and trees


def snapshot(log: DataFrame, key: str, order: Sequence[str], path: str) -> DataFrame:
    """The latest row of each key of a log, written as one table and read back."""
    dedup.latest_by(log, [key], list(order)).write.mode("overwrite").parquet(path)
    return log.sparkSession.read.parquet(path)


def write_by_key(rows: DataFrame, path: str, key: str) -> None:
    """JSON records in a folder for each key."""
    rows.write.mode("overwrite").partitionBy(key).json(path)


def discovered(spark: SparkSession, stages: dict[str, str]) -> DataFrame:
    """(key, a flag for each stage): which files each key has; the key is a file's folder. Folders are listed, files aren't read."""
    found = None
    for name, path in stages.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.element_at(F.split("path", "/"), -2).alias("key"), F.lit(name).alias("stage")).distinct()
        found = files if found is None else found.unionByName(files)
    return found.groupBy("key").agg(*[F.bool_or(F.col("stage") == n).alias(n) for n in stages])


# ---------------------------------------------------------------- feeds and documents


def read_feed(spark: SparkSession, path: str, row: str = "item") -> DataFrame:
    """(title, summary, url, source, published_at) of the items of feeds, each link once, the first title of it."""
    raw = spark.read.format("xml").option("rowTag", row).schema("title string, description string, link string, source string, pubDate string").load(path)
    return raw.where("link is not null").groupBy(F.trim("link").alias("url")).agg(F.min(F.struct(F.trim("title").alias("title"), F.trim("description").alias("summary"), F.trim("source").alias("source"), F.col("pubDate").alias("published_at"))).alias("r")).select("r.title", "r.summary", "url", "r.source", "r.published_at")


def document_kind(content: Column) -> Column:
    """What a file is by its first bytes: pdf, docx (any zip), doc, rtf, html, or text."""
    head = F.hex(F.substring(content, 1, 8))
    low = F.lower(F.decode(F.substring(content, 1, 200), "ISO-8859-1"))
    return (
        F.when(head.startswith("25504446"), "pdf").when(head.startswith("504B0304"), "docx").when(head.startswith("D0CF11E0"), "doc").when(head.startswith("7B5C727466"), "rtf").when(low.rlike(r"^\s*<(?:!doctype html|html|head|body)"), "html").otherwise("text")
    )


def decoded(raw: bytes | None) -> str | None:
    """Text of bytes: by its mark of order, as UTF-8, else as Windows' Latin letters with what that lacks as Latin-1."""
    if raw is None:
        return None
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if raw.startswith(mark):
            return raw.decode(name, "replace")
    for name in ("utf-8", "cp1252"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


def docx_text(raw: bytes) -> str:
    """The paragraphs of a word processor's zipped document."""
    try:
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            xml = z.read("word/document.xml").decode("utf-8", "replace")
    except (zipfile.BadZipFile, KeyError):
        return ""
    lines = ["".join(re.findall(r"<w:t(?:\s[^>]*)?>([^<]*)</w:t>", p)) for p in re.findall(r"(?s)<w:p[ >].*?</w:p>", xml)]
    return "\n".join(s.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&") for s in lines if s.strip())


_SHOWN = re.compile(rb"\((?:[^()\\]|\\.)*\)\s*(?:Tj|'|\")|\[(?:[^\]\\]|\\.)*\]\s*TJ|T\*|\bTd\b|\bTD\b|\bET\b", re.S)
_PART = re.compile(rb"\(((?:[^()\\]|\\.)*)\)", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"(": b"(", b")": b")", b"\\": b"\\"}


def pdf_text(raw: bytes) -> str:
    """The text that a PDF's content streams show in simple fonts, a line for each move; encoded glyphs of embedded fonts aren't mapped."""
    out: list[str] = []
    for m in re.finditer(rb"stream\r?\n(.*?)\r?\nendstream", raw, re.S):
        body = m.group(1)
        try:
            body = zlib.decompressobj().decompress(body)
        except zlib.error:
            pass
        if b"BT" not in body:
            continue
        line = b""
        for t in _SHOWN.finditer(body):
            if t.group()[:1] in (b"(", b"["):
                line += b"".join(re.sub(rb"\\(.)", lambda e: _ESCAPES.get(e.group(1), e.group(1)), p, flags=re.S) for p in _PART.findall(t.group()))
            elif line:
                out.append(line.decode("latin-1"))
                line = b""
        if line:
            out.append(line.decode("latin-1"))
    return "\n".join(s.strip() for s in out if s.strip())


def read_documents_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, kind, text) of files: PDF, zipped word documents, rich text without its commands, and text of any encoding; null for old binary documents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", document_kind(F.col("content")).alias("kind"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for kind, raw in zip(b["kind"], b["content"], strict=True):
                raw = bytes(raw)
                if kind == "rtf":
                    out.append(re.sub(r"\s+", " ", re.sub(r"\\[a-z]+-?\d* ?|[{}]|\\'[0-9a-f]{2}", "", decoded(raw))).strip())
                else:
                    out.append({"pdf": pdf_text, "docx": docx_text, "doc": lambda _: None}.get(kind, decoded)(raw))
            yield pd.DataFrame({"path": b["path"], "kind": b["kind"], "text": out})

    return files.mapInPandas(run, "path string, kind string, text string")


# ---------------------------------------------------------------- stores


def upsert_vectors(store: TableStore, rows: DataFrame, vector: str, size: int, order: Sequence[str] = ()) -> int:
    """Put valid vectors into a store; the number of rows left out because theirs isn't."""
    good = F.coalesce(retrieval.valid_vector(F.col(vector), size), F.lit(False))
    bad = rows.where(~good).count()
    store.upsert(rows.where(good), order)
    return bad


def with_prefix(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    """Rows whose key begins with ``prefix``: bounds that reach the scan."""
    return rows.where(F.col(key).startswith(prefix))


def fetched(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of stated ids."""
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def copy_store(source: TableStore, target: TableStore, size: int, after=None, pages: int | None = None):
    """Copy a store in pages by key, from the one after ``after``; the last key copied, from which a broken-off copy goes on.

    Each page is an upsert, so a page that is copied twice changes nothing.
    """
    done = 0
    while pages is None or done < pages:
        page = source.page(after, size)
        last = page.agg(F.max(source.key).alias("k")).first().k
        if last is None:
            break
        target.upsert(page)
        after, done = last, done + 1
    return after


def deleted_everywhere(tables: dict[str, DataFrame], keys: DataFrame, key: str) -> dict[str, DataFrame]:
    """Each table without the rows of the keys."""
    return {n: dedup.delete(t, keys, key) for n, t in tables.items()}
