"""Queries of converters, parsers, generators and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bpe, convert
from ..operators import parsers, shards
from ..registry import query, table


@query()
def html_to_text(spark, sf_dir):
    """Pages as text with underlined headings, numbered lists and marked code."""
    return table(spark, sf_dir, "pages").select("page_id", convert.to_text(F.col("html"), F.lit("page.html")).alias("c")).select("page_id", "c.text", "c.status")


@query("SELECT conv_id, 'chat' AS source, count(*)::INT AS messages FROM conversations WHERE role IN ('user', 'assistant') AND regexp_matches(text, '\\S') GROUP BY conv_id")
def parse_chat(spark, sf_dir):
    """Chat layout to episodes."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    shaped = F.filter(F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.trim(m["content"]).alias("content"))), lambda m: m["role"].isin("user", "assistant") & (m["content"] != ""))
    return rows.select("conv_id", F.lit("chat").alias("source"), F.size(shaped).alias("messages"))


@query(
    """WITH c AS (SELECT n_nationkey, n_name, i, row_number() OVER (PARTITION BY n_nationkey ORDER BY md5('1|' || n_name || '|' || i), i) AS r FROM nation, (SELECT unnest(range(3)) AS i))
SELECT n_name, i::INT AS template, CASE i WHEN 0 THEN 'Where is ' || n_name || '?' WHEN 1 THEN 'Repeat: ' || n_name ELSE 'Quote ' || n_name || '.' END AS question FROM c WHERE r <= 2"""
)
def generate_episodes(spark, sf_dir):
    """Two of three templates for every nation."""
    templates = [("Where is {x}?", "I don't know."), ("Repeat: {x}", "{x}"), ("Quote {x}.", '"{x}"')]
    out = parsers.generate(table(spark, sf_dir, "nation").select("n_name"), "n_name", templates, 2, 1)
    return out.select("n_name", "template", F.get("messages", 0)["content"].alias("question"))


@query(
    """WITH RECURSIVE e AS (SELECT doc_id, coalesce(len(string_split(text, ' ')), 0)::BIGINT AS n, doc_id % 4 AS part, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) AS i FROM documents),
f AS (SELECT part, i, doc_id, n, 0::BIGINT AS block, 0::BIGINT AS start FROM e WHERE i = 1
UNION ALL SELECT e.part, e.i, e.doc_id, e.n, CASE WHEN f.start + f.n + e.n > 20000 THEN f.block + 1 ELSE f.block END, CASE WHEN f.start + f.n + e.n > 20000 THEN 0 ELSE f.start + f.n END FROM f JOIN e ON e.part = f.part AND e.i = f.i + 1),
p AS (SELECT part, coalesce(sum(max(block) + 1) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM f GROUP BY part)
SELECT (first + block)::BIGINT AS shard, doc_id, start, n AS tokens FROM f JOIN p ON f.part = p.part"""
)
def episode_shard_plan(spark, sf_dir):
    """The shard and place of each document, an episode of its blank-separated pieces, in four streams."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", " "))).alias("tokens"))
    return shards.shard_plan(docs, 20_000, parts=4).select("shard", F.col("id").alias("doc_id"), "start", "tokens")


@query("SELECT doc_id, coalesce(text, '') || '<|end|><|endless|>x<unk_tok_60000>' AS decoded FROM documents")
def bpe_round_trip(spark, sf_dir):
    """Whole texts with two special tokens through encoding, an id beyond the vocabulary added, and decoding."""
    from public_tokenizers import path

    args = path("byte_bpe_50k.json"), {"<|end|>": 50_257, "<|endless|>": 50_258}
    marked = F.concat(F.coalesce("text", F.lit("")), F.lit("<|end|><|endless|>x"))
    ids = table(spark, sf_dir, "documents").select("doc_id", F.concat(bpe.encoder(*args)(marked), F.array(F.lit(60_000))).alias("ids"))
    return ids.select("doc_id", bpe.decoder(*args)("ids").alias("decoded"))
