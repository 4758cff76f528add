"""Documents: which belong to a product, their bytes, their text; providers are injected and work offline by default."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.functions.text import needs_ocr

_DOCS = "array<struct<s3_path: string, doc_type: string, document_type: string>>"


def selected_documents(json_text: Column, source_url: Column, country: Column, second_type: str = "PIL", second_country: str = "United Kingdom") -> Column:
    """array<struct(path, doc_type)>: the primary document and, for one country, the first other one of a second type.

    No second one where the primary is of that type already; the primary's type is that of the entry with its path.
    """
    docs = F.coalesce(F.from_json(F.get_json_object(json_text, "$.documents"), _DOCS), F.array().cast(_DOCS))
    docs = F.filter(docs, lambda d: d.isNotNull())
    kind = F.try_element_at(F.filter(docs, lambda d: d["s3_path"] == source_url), F.lit(1))["doc_type"]
    primary = F.struct(source_url.alias("path"), kind.alias("doc_type"))
    others = F.transform(F.filter(docs, lambda d: (d["doc_type"] == second_type) & (F.coalesce(d["s3_path"], F.lit("")) != "") & ~d["s3_path"].eqNullSafe(source_url)), lambda d: F.struct(d["s3_path"].alias("path"), d["doc_type"].alias("doc_type")))
    wants = (country == second_country) & ~kind.eqNullSafe(F.lit(second_type))
    return F.concat(F.array(primary), F.when(F.coalesce(wants, F.lit(False)), F.slice(others, 1, 1)).otherwise(F.slice(others, 1, 0)))


def read_binary(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, content) of the files under a folder, read by tasks."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "content")


class TextLayer(Protocol):
    def read(self, content: bytes, path: str) -> tuple[str, int, int, str]: ...


class PlainTextLayer:
    """Text layer of files that are text: (text, pages, pages that need recognition, kind). Pages end at form feeds."""

    def read(self, content: bytes, path: str) -> tuple[str, int, int, str]:
        try:
            text = content.decode("utf-8")
        except UnicodeDecodeError:
            return "", 1, 1, "scanned"
        return text, text.count("\f") + 1, 0, "text_based"


class Recognizer(Protocol):
    def pages(self, content: bytes, path: str) -> list[dict]: ...


class OfflineRecognizer:
    """Stands in for an optical recognizer: printable runs of the bytes, a page for each form feed."""

    def pages(self, content: bytes, path: str) -> list[dict]:
        return [{"markdown": " ".join(re.findall(r"[ -~]{4,}", part.decode("latin-1"))), "tables": []} for part in content.split(b"\f")]


def inline_tables(text: str, pages: list[dict]) -> str:
    """Markdown with its references to tables (`[x](id.md)`) replaced by the tables of all pages."""
    known = {t["id"].removesuffix(".md"): t.get("content", "") for p in pages for t in p.get("tables", []) if t.get("id")}
    return re.sub(r"\[[^\]]*\]\(([^)]+)\.md\)", lambda m: known.get(m.group(1), m.group(0)), text)


def page_groups(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """(first, end) of groups of consecutive pages: a group closes with the page that brings it to the limit."""
    groups, first, size = [], 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= limit or i == len(sizes) - 1:
            groups.append((first, i + 1))
            first, size = i + 1, 0
    return groups


READ = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("text", T.StringType()), T.StructField("pages", T.IntegerType()), T.StructField("method", T.StringType()), T.StructField("error", T.StringType())]
)


def read_documents(files: DataFrame, layer: Callable[[], TextLayer] = PlainTextLayer, recognizer: Callable[[], Recognizer] = OfflineRecognizer) -> DataFrame:
    """(path, text, pages, method, error) of files (path, content): the text layer, or recognition where it is too thin.

    A file that cannot be read is a row with an error; no file fails a task.
    """
    layered = T.StructType([*READ[:3], T.StructField("pages_needing_ocr", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("error", T.StringType()), T.StructField("content", T.BinaryType())])

    def layers(source: Iterator[tuple]) -> Iterator[tuple]:
        reader = layer()
        for path, content in source:
            try:
                text, pages, need, kind = reader.read(content, path)
                yield path, text, pages, need, kind, None, content
            except Exception as e:  # noqa: BLE001 - an unreadable file is data
                yield path, None, 0, 0, None, str(e)[:2000], content

    def recognized(source: Iterator[tuple]) -> Iterator[tuple]:
        engine = recognizer()
        for path, text, pages, error, content, thin in source:
            if error or not thin:
                yield path, text, pages, "text" if not error else None, error
                continue
            try:
                found = engine.pages(content, path)
                yield path, "\n\n".join(inline_tables(p.get("markdown", ""), found) for p in found), len(found), "ocr", None
            except Exception as e:  # noqa: BLE001
                yield path, None, pages, "ocr", str(e)[:2000]

    first = map_rows(files.select("path", "content"), layered, layers, batch=16)
    thin = needs_ocr(F.col("kind"), F.col("pages_needing_ocr"), F.col("text"), F.col("pages"))
    return map_rows(first.select("path", "text", "pages", "error", "content", thin.alias("thin")), READ, recognized, batch=16)
