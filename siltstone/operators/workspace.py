"""Tools over a document workspace: documents (path, text, created_at, updated_at) and an index of their chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import retrieval


def documents(files: DataFrame, root: str) -> DataFrame:
    """doc_id (12 hex digits of the relative path's MD5), title and path."""
    relative = F.regexp_replace("path", f"^{root.rstrip('/')}/", "")
    title = F.regexp_replace(F.element_at(F.split(relative, "/"), -1), r"\.[^.]*$", "")
    return files.select(F.substring(F.md5(relative), 1, 12).alias("doc_id"), title.alias("title"), relative.alias("path"), "text")


def list_documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "title", "path").orderBy("path")


def get_document(docs: DataFrame, doc_id: str | None = None, title: str | None = None) -> DataFrame:
    """By id, else by title, letter case aside; the first of several by path."""
    wanted = F.col("doc_id") == doc_id if doc_id else F.lower("title") == (title or "").lower()
    return docs.where(wanted).orderBy("path").limit(1)


def search(index: DataFrame, query: str, k: int = 5, least: float = 0.0, dim: int = 64) -> DataFrame:
    """The k best chunks of an index (chunk_id, text, embedding) for a query, then those under ``least`` left out."""
    spark = index.sparkSession
    asked = retrieval.embed(spark.createDataFrame([(0, query)], "id int, q string"), "id", "q", dim).first()
    if asked is None:
        return index.limit(0).select("chunk_id", "text", F.lit(0.0).alias("score"))
    vector = F.array(*[F.lit(float(x)) for x in asked.embedding])
    scored = index.select("chunk_id", "text", F.round(retrieval.dot(F.col("embedding"), vector), 4).alias("score"))
    return scored.orderBy(F.desc("score"), "chunk_id").limit(k).where(F.col("score") >= least)


def summarize(docs: DataFrame, doc_id: str, most: int = 500) -> DataFrame:
    return get_document(docs, doc_id).select("doc_id", T.extractive_summary(F.col("text"), most).alias("summary"))


TOOLS: dict[str, Callable[..., DataFrame]] = {"list": list_documents, "get": get_document, "search": search, "summarize": summarize}


def call(name: str, *args, **kwargs) -> DataFrame:
    if name not in TOOLS:
        raise ValueError(f"unknown tool {name}; there are {', '.join(sorted(TOOLS))}")
    return TOOLS[name](*args, **kwargs)
