"""Readers. Each returns a DataFrame; files are read by Spark's own sources, so any store that Spark reads will do."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import convert, text

_NAME = r"([^/]+)$"


def directory(spark: SparkSession, path: str, extensions: list[str] | None = None, least: int = 0, most: int = 1 << 40) -> DataFrame:
    """Files under a folder: path, filename, format, size_bytes, modified_time and content (binary)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("length").between(least, most))
    out = files.select("path", F.regexp_extract("path", _NAME, 1).alias("filename"), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("format"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_time"), "content")
    return out.where(F.col("format").isin(*[e.lower().lstrip(".") for e in extensions])) if extensions else out


def documents(spark: SparkSession, path: str, extensions: list[str] | None = None) -> DataFrame:
    """Files converted to text by their format, with the converter's status."""
    raw = directory(spark, path, extensions).withColumn("raw", F.decode("content", "utf-8"))
    out = raw.withColumn("c", convert.to_text(F.col("raw"), F.col("path")))
    return out.select("path", "filename", "format", "size_bytes", "modified_time", F.col("c.text").alias("text"), F.col("c.status").alias("status"))


def glob_to_regex(pattern: str) -> str:
    """A path glob (** over folders) as a regular expression over relative paths."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        else:
            c = pattern[i]
            out, i = out + {"*": "[^/]*", "?": "[^/]"}.get(c, "\\" + c if c in ".+()[]{}^$|\\" else c), i + 1
    return f"^{out}$"


def path_reason(path: Column, include: list[str], exclude: list[str]) -> Column:
    """kept, excluded or not_included for a relative path. A pattern without a slash is matched with the file's name."""

    def any_of(patterns: list[str]) -> Column:
        hit = F.lit(False)
        for p in patterns:
            hit = hit | (path if "/" in p else F.regexp_extract(path, _NAME, 1)).rlike(glob_to_regex(p))
        return hit

    return F.when(~any_of(include), "not_included").when(any_of(exclude), "excluded").otherwise("kept")


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a given schema; lines that can't be read are kept apart in ``_corrupt_record``."""
    return spark.read.schema(f"{schema}, _corrupt_record string").json(path, mode="PERMISSIVE")


def lines(spark: SparkSession, path: str, split_tabs: bool = False) -> DataFrame:
    """source (file) and line; tab fields become lines of their own, empty ones dropped."""
    out = spark.read.text(path).select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("line"))
    return out.select("source", F.explode(F.split("line", "\t")).alias("line")).where(F.trim("line") != "") if split_tabs else out


def named_sources(spark: SparkSession, specs: list[str]) -> DataFrame:
    """Lines of sources given as ``NAME:path,path``; each path may be a glob."""
    parts = []
    for spec in specs:
        name, _, paths = spec.partition(":")
        parts.append(lines(spark, [p for p in paths.split(",") if p]).withColumn("name", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def marked_shards(spark: SparkSession, path: str) -> DataFrame:
    """Documents of text shards with start and end marks; a shard without marks is one document."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("shard"), F.col("value").alias("v"))
    pattern = r"(?s)==== DOC START ====\s*\n(.*?)==== DOC END ===="
    found = F.regexp_extract_all("v", F.lit(pattern), 1)
    docs = whole.select("shard", F.explode(F.when(F.size(found) > 0, found).otherwise(F.array("v"))).alias("d"))
    head = r"(?d)\ASOURCE: (\S+)(?: \| (?:PATH|ID): (.*))?\n====\n"
    return docs.select("shard", F.regexp_extract("d", head, 1).alias("source"), F.regexp_extract("d", head, 2).alias("path"), F.regexp_replace(F.regexp_replace("d", head, ""), r"\n\z", "").alias("text"))


def delimited(spark: SparkSession, path: str, mark: str = "<|endoftext|>", most: int = 1 << 30) -> DataFrame:
    """Records between marks, empty and too long ones dropped."""
    out = spark.read.option("lineSep", mark).text(path).select(F.trim(F.regexp_replace("value", r"\A\s+|\s+\z", "")).alias("text"))
    return out.where((F.col("text") != "") & (F.length("text") <= most))


def translation_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(id, ordinal, text) of blocks headed ``=== id ===`` whose messages a separator divides."""
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.regexp_extract_all("value", F.lit(r"(?s)(=== [^\n]+? ===\n.*?)(?=\n=== [^\n]+? ===\n|\z)"), 1)).alias("b"))
    body = F.regexp_replace("b", r"\A=== [^\n]+? ===\n", "")
    return whole.select(F.regexp_extract("b", r"\A=== ([^\n]+?) ===", 1).alias("id"), F.posexplode(F.split(body, "<<<MSG_SEP>>>")).alias("ordinal", "t")).select("id", "ordinal", F.regexp_replace("t", r"\A\s+|\s+\z", "").alias("text"))


def token_shards(spark: SparkSession, path: str, dtype: str = "<u4") -> DataFrame:
    """shard and tokens (array) of flat binary token files."""

    @F.pandas_udf("array<int>")
    def ids(content: pd.Series) -> pd.Series:
        return content.map(lambda b: np.frombuffer(b, dtype).astype(np.int32))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_extract("path", _NAME, 1).alias("shard"), ids("content").alias("tokens"))


def episode_shards(spark: SparkSession, folder: str) -> DataFrame:
    """episode, tokens and mask of an episode-indexed folder: tokens.bin, mask.bin and episodes.idx of (start, length)."""

    def raw(name: str) -> DataFrame:
        return spark.read.format("binaryFile").load(f"{folder}/{name}").select(F.col("content").alias(name.partition(".")[0]))

    @F.pandas_udf("array<struct<episode:int,tokens:array<int>,mask:array<int>>>")
    def cut(tokens: pd.Series, mask: pd.Series, index: pd.Series) -> pd.Series:
        rows = []
        for t, m, x in zip(tokens, mask, index, strict=True):
            t, m = np.frombuffer(t, "<u4").astype(np.int32), np.frombuffer(m, np.uint8).astype(np.int32)
            rows.append([{"episode": i, "tokens": t[a : a + n], "mask": m[a : a + n]} for i, (a, n) in enumerate(np.frombuffer(x, "<u8").reshape(-1, 2).astype(int).tolist())])
        return pd.Series(rows)

    one = raw("tokens.bin").join(raw("mask.bin")).join(raw("episodes.idx"))  # a file each
    return one.select(F.explode(cut("tokens", "mask", "episodes")).alias("e")).select("e.*")


def is_episode_indexed(spark: SparkSession, folder: str) -> bool:
    """Whether a folder, or its train or val folder, holds an episode index."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(fs.exists(path(f"{folder}/{sub}episodes.idx")) for sub in ("", "train/", "val/"))


def audit_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of daily audit files with the category and date of their names; files named otherwise are skipped."""
    out = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
    out = out.select("file", F.regexp_extract("file", r"^(\w+?)[-_]\d{4}-\d{2}-\d{2}\.log$", 1).alias("category"), F.expr(r"try_to_date(regexp_extract(file, '(\\d{4}-\\d{2}-\\d{2})\\.log$', 1))").alias("date"), "line")
    return out.where("date is not null")


def law_versions(paths: DataFrame) -> DataFrame:
    """kind, number, version date and language of each path ``.../kind/number/yyyymmdd/language/...``; newest kept, ties too."""
    p = r"/(\w+)/([\w.]+)/(\d{8})/(\w\w)/"
    rows = paths.select("path", *[F.regexp_extract("path", p, i + 1).alias(n) for i, n in enumerate(("kind", "number", "version", "lang"))]).where("version <> ''")
    newest = rows.groupBy("lang", "number").agg(F.max("version").alias("newest"))
    return rows.join(newest, ["lang", "number"]).where("version = newest").drop("newest")


def not_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been written yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def dialogues(spark: SparkSession, path: str, kind: str, field: str = "content") -> DataFrame:
    """Texts of dialogue records (JSON lines, also gzipped), cleaned by kind: comment, qa, thread or long_qa."""
    clean = {"comment": text.clean_comment, "qa": text.clean_qa, "thread": text.clean_thread, "long_qa": text.clean_long_qa}[kind]
    return jsonl(spark, path, f"{field} string").select(clean(F.col(field)).alias("text")).where("text is not null")


def subtitles(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned subtitle lines with their file, in no order; windows over them need a line number of the source."""
    out = spark.read.text(path).select(F.col("_metadata.file_path").alias("source"), text.subtitle_line(F.col("value")).alias("line"))
    return out.where("line is not null")


def code_files(spark: SparkSession, path: str, extensions: list[str]) -> DataFrame:
    """Source files of 100 to 100,000 bytes."""
    files = directory(spark, path, extensions, 100, 100_000)
    return files.select("path", "filename", F.decode("content", "utf-8").alias("text"))
