"""File listing, zip expansion and text extraction.

Inputs have the columns of Spark's ``binaryFile`` source (path, content), so
Spark lists, splits and schedules the files; one file is one row.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import html_text


def read_files(spark: SparkSession, root: str, pattern: str = "*.{pdf,docx}") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)


def resume_listing(files: DataFrame, extensions: tuple[str, ...] = ("pdf", "docx")) -> DataFrame:
    """Job id, resume id and file name of every ``…/resumes/<job>/<resume>_<file>``
    with a wanted extension."""
    ext = F.lower(F.substring_index("path", ".", -1))
    rel = F.regexp_extract("path", r"(resumes/.*)$", 1)
    blob = F.substring_index(rel, "/", -1)
    return (
        files.filter(ext.isin(*extensions))
        .withColumn("job_id", F.split_part(rel, F.lit("/"), F.lit(2)))
        .withColumn("resume_id", F.substring_index(blob, "_", 1))
        .withColumn("filename", F.regexp_replace(blob, "^[^_]*_", ""))
        .withColumn("extension", ext)
    )


def _skipped(name: str, wanted: tuple[str, ...]) -> bool:
    system = name.endswith("/") or name.startswith("__MACOSX") or name.endswith(".DS_Store")
    return system or not name.lower().endswith(wanted)


def expand_zips(archives: DataFrame, wanted: tuple[str, ...] = (".pdf",), chunk_bytes: int = 8 << 20) -> DataFrame:
    """One row per archive member; skipped members keep their name and lose
    their bytes. Archives are taken from a batch one at a time and rows handed over in
    chunks of some megabytes, so neither a batch nor an archive sits unpacked in memory as a whole."""
    kinds = {"archive": pa.string(), "member": pa.string(), "skipped": pa.bool_(), "content": pa.binary()}

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(*batch.columns):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as z:
                    for member in z.infolist():
                        skip = _skipped(member.filename, wanted)
                        yield path.as_py(), member.filename, skip, None if skip else z.read(member)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_chunks(members(batches), kinds, chunk_bytes)

    return archives.select("path", "content").mapInArrow(unpack, "archive string, member string, skipped boolean, content binary")


def in_chunks(rows: Iterator[tuple], kinds: dict[str, pa.DataType], chunk_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of some megabytes; the last column, bytes or none, settles their size."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds.values())], list(kinds))

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"") + 100
        if size >= chunk_bytes:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def docx_text(data: bytes) -> str:
    """Paragraph texts of a docx file, one per line."""
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter(f"{ns}t")) for p in root.iter(f"{ns}p"))


def plain_text(data: bytes) -> str:
    return data.decode("utf-8")


READERS: dict[str, Callable[[bytes], str]] = {"txt": plain_text, "docx": docx_text}


def extract_text(files: DataFrame, name: str = "path", readers: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """Text of binary files by extension. Unknown extensions and unreadable files
    keep their row with a null text and the reason; a PDF reader can be added
    through ``readers``."""
    table = {**READERS, **(readers or {})}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, problems = [], []
            for path, content in zip(batch[name], batch["content"]):
                reader = table.get(re.sub(r".*\.", "", path).lower())
                text, problem = None, None
                if reader is None:
                    problem = "unsupported extension"
                else:
                    try:
                        text = reader(bytes(content))
                    except Exception as e:  # one bad file must not fail the job
                        problem = f"{type(e).__name__}: {e}"
                texts.append(text)
                problems.append(problem)
            yield pd.DataFrame({name: batch[name], "text": texts, "problem": problems})

    return files.select(name, "content").mapInPandas(read, f"{name} string, text string, problem string")


def page_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Readable text of HTML pages, by expressions alone."""
    return pages.withColumn("text", html_text(F.col(html))).drop(html)


def file_prefix(path: Column) -> Column:
    """Name of a file before its last underscore; null where it has none."""
    return F.nullif(F.regexp_extract(F.substring_index(path, "/", -1), "^(.+)_[^_]*$", 1), F.lit(""))


def latest_snapshots(files: DataFrame, prefix: Column) -> DataFrame:
    """(prefix, path, modified) of the newest file of every prefix, in one pass;
    input columns path and modified. Ties go to the last path; files without a
    prefix are of no snapshot."""
    named = files.select(prefix.alias("prefix"), "path", "modified").filter("prefix is not null")
    newest = named.groupBy("prefix").agg(F.max(F.struct("modified", "path")).alias("newest"))
    return newest.select("prefix", "newest.path", "newest.modified")


def latest_snapshot(files: DataFrame, prefix: str) -> DataFrame:
    """The newest file by modification time among those whose name starts with
    ``prefix``; input columns path and modified."""
    mine = F.when(F.substring_index("path", "/", -1).startswith(prefix), F.lit(prefix))
    return latest_snapshots(files, mine).select("path", "modified")


def require_snapshot(files: DataFrame, prefix: str) -> str:
    """Path of the newest snapshot, or an error that names the prefix."""
    row = latest_snapshot(files, prefix).first()
    if row is None:
        raise FileNotFoundError(f"no snapshot starts with {prefix!r}")
    return row["path"]
