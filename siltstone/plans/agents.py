"""Queries of tool conversations, prompts, sources, sampling and episode stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import agent as A
from ..operators import sampling as S
from ..registry import query, table
from .serving import _KNN, _knn
from .text import _sql_strip, _sql_words


def _tool_messages(spark, sf_dir):
    """Conversations as tool conversations: every third assistant turn is a call, every fifth user turn has a context."""
    role = F.when((F.col("role") == "assistant") & (F.col("turn") % 3 == 0), "assistant_toolcall").otherwise(F.col("role"))
    extra = lambda when, value: F.when(when, value).otherwise(F.lit(""))
    m = F.struct(
        "turn", role.alias("role"), F.col("text").alias("content"), F.lit("search").alias("name"), F.concat(F.lit('{"k": '), "turn", F.lit("}")).alias("arguments"),
        extra(F.col("turn") % 5 == 0, F.lit("ctx")).alias("context"), extra(F.col("turn") % 4 == 1, F.lit("hm")).alias("think"), extra(F.col("turn") % 2 == 1, F.lit("[1]")).alias("cite"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", m.alias("m")).groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("all"))
    system = F.get(F.filter("all", lambda x: x["role"] == "system"), 0)["content"]
    return rows.select("conv_id", F.coalesce(system, F.lit("")).alias("system"), F.filter("all", lambda x: x["role"] != "system").alias("messages"))


_THINK = "CASE WHEN turn % 4 = 1 THEN '<think>hm</think>' ELSE '' END"
_BLOCK = f"""CASE WHEN role = 'user' THEN '<user>' || CASE WHEN turn % 5 = 0 THEN '<user_context>ctx</user_context>' ELSE '' END || text || '</user>'
 WHEN turn % 3 = 0 THEN '<assistant>' || {_THINK} || '<toolcall>{{"name": "search", "k": ' || turn || '}}</toolcall></assistant>'
 ELSE '<assistant>' || {_THINK} || text || CASE WHEN turn % 2 = 1 THEN '<cite>[1]</cite>' ELSE '' END || '</assistant>' END || chr(10)"""


@query(
    f"""WITH s AS (SELECT conv_id, coalesce(arg_min(text, turn) FILTER (role = 'system'), '') AS sys FROM conversations GROUP BY conv_id),
b AS (SELECT conv_id, turn, role, {_BLOCK} AS b FROM conversations WHERE role IN ('user', 'assistant')),
j AS (SELECT conv_id, string_agg(b, '' ORDER BY turn) AS t, string_agg(repeat(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, length(b)), '' ORDER BY turn) AS m FROM b GROUP BY conv_id),
h AS (SELECT s.conv_id, CASE WHEN sys <> '' THEN '<system>' || sys || '</system>' || chr(10) ELSE '' END AS head, coalesce(t, '') AS t, coalesce(m, '') AS m FROM s LEFT JOIN j ON s.conv_id = j.conv_id)
SELECT conv_id, md5(head || t || '<eot>' || chr(10)) AS text_md5, md5(repeat('0', length(head)) || m || '111110') AS mask_md5 FROM h"""
)
def serialize_tool_chat(spark, sf_dir):
    """Tool conversations as text with their character mask."""
    rows = _tool_messages(spark, sf_dir).select("conv_id", A.serialize(F.col("messages"), F.col("system")).alias("s"))
    return rows.select("conv_id", F.md5("s.text").alias("text_md5"), F.md5("s.mask").alias("mask_md5"))


@query(
    f"""SELECT conv_id, count(*) FILTER (role = 'assistant' AND turn % 3 <> 0) > 0 AND count(*) FILTER (role = 'assistant' AND turn % 3 <> 0 AND {_sql_strip('text')} = '') = 0 AND count(*) FILTER (role = 'assistant' AND turn % 3 = 0 AND conv_id % 7 = 0) = 0 AS valid FROM conversations GROUP BY conv_id"""
)
def tool_episode_valid(spark, sf_dir):
    """Whether tool conversations are valid; those of every seventh conversation call a tool that isn't known."""
    name = F.when(F.col("conv_id") % 7 == 0, "rm").otherwise("search")
    shaped = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), name.alias("name"), m["arguments"].alias("arguments"), m["content"].alias("content")))
    return _tool_messages(spark, sf_dir).select("conv_id", A.valid_tool_episode(shaped, ["search", "get"]).alias("valid"))


@query(
    """WITH l AS (SELECT conv_id, string_agg('<' || role || '>' || text || '</' || role || '>', chr(10) ORDER BY turn) AS t, bool_or(role = 'system') AS has FROM conversations GROUP BY conv_id)
SELECT conv_id, md5(CASE WHEN has THEN '' ELSE '<system>Be brief.</system>' || chr(10) END || t || chr(10) || '<assistant>') AS prompt_md5 FROM l"""
)
def chat_prompt(spark, sf_dir):
    """The prompt of each conversation's history, with a system text where it has none."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return rows.select("conv_id", F.md5(A.prompt(F.col("m"), "Be brief.")).alias("prompt_md5"))


@query(
    """WITH d AS (SELECT conv_id, turn, CASE WHEN length(text) > 60 THEN left(text, 57) || '...' ELSE text END AS t FROM conversations),
c AS (SELECT *, sum(length(t) + 20) OVER (PARTITION BY conv_id ORDER BY turn) AS used FROM d)
SELECT conv_id, md5(coalesce(string_agg(t, '|' ORDER BY turn) FILTER (used <= 200), '')) AS kept_md5, (count(*) FILTER (used > 200))::INT AS remaining FROM c GROUP BY conv_id"""
)
def truncate_results(spark, sf_dir):
    """Turns as the documents of a tool result, cut to 60 characters and to a budget of 300."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("id"), "text"))).alias("d"))
    cut = rows.select("conv_id", A.truncate_documents(F.col("d"), 300, 60).alias("r"))
    return cut.select("conv_id", F.md5(F.array_join(F.transform("r.documents", lambda d: d["text"]), "|")).alias("kept_md5"), "r.remaining")


@query("SELECT doc_id FROM documents WHERE contains(source, 'rc1') OR source = 'src2'")
def chunks_of_source(spark, sf_dir):
    """Rows of the index whose file holds a name, or whose filename is another."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("file"), F.col("source").alias("filename"))
    return A.of_source(d, "rc1").unionByName(A.of_source(d.withColumn("file", F.lit("")), "src2")).select("doc_id").distinct()


@query(f"WITH {_KNN} SELECT q, count(*) AS num_sources, string_agg(id || ':' || CASE WHEN id % 2 = 0 THEN repeat('x', 200) || '...' ELSE 'short' END, ',' ORDER BY rank) AS sources FROM r WHERE rank <= 3 GROUP BY q")
def answer_sources(spark, sf_dir):
    """The sources of each answer, long texts as a preview of 200 characters."""
    text = F.when(F.col("id") % 2 == 0, F.repeat(F.lit("x"), F.lit(300))).otherwise(F.lit("short"))
    hits = _knn(spark, sf_dir, 3).select("q", "rank", F.col("id").cast("string").alias("filename"), "score", text.alias("text"))
    return A.sources(hits).select("q", "num_sources", F.array_join(F.transform("sources", lambda s: F.concat(s["filename"], F.lit(":"), s["text_preview"])), ",").alias("sources"))


@query(f"WITH {_KNN}, h AS (SELECT q, avg(score) AS m FROM r WHERE rank <= 5 AND score >= 0.35 GROUP BY q) SELECT v.vec_id AS q, round(coalesce(m, 0), 5) AS mean FROM embeddings v LEFT JOIN h ON h.q = v.vec_id WHERE v.vec_id % 100 = 0")
def retrieval_average(spark, sf_dir):
    """The mean score of each query's hits over a threshold, 0 where there are none."""
    asked = table(spark, sf_dir, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("q"))
    return A.average_score(asked, _knn(spark, sf_dir, 5).where("score >= 0.35")).select("q", F.round("mean", 5).alias("mean"))


@query("SELECT coalesce(json_extract_string(CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END, '$.k'), '_ungrouped') AS field, count(*) AS n FROM events GROUP BY 1")
def nested_group(spark, sf_dir):
    """Events by a field inside a JSON column; those without it form a group of their own."""
    field = F.get_json_object(F.when(F.col("event_id") % 3 != 0, F.col("props")), "$.k")
    return table(spark, sf_dir, "events").groupBy(F.coalesce(field, F.lit("_ungrouped")).alias("field")).agg(F.count("*").alias("n"))


@query(
    f"""WITH w AS (SELECT doc_id, list_transform({_sql_words('text')}, lambda x: length(x)) AS t FROM documents), p AS (SELECT doc_id, t, len(t) - 33 AS most, unnest(range(3)) AS draw FROM w WHERE len(t) > 33),
s AS (SELECT *, CASE WHEN most >= 3 THEN floor(('0x' || left(md5('5|' || doc_id || '|' || draw), 13))::BIGINT / 4503599627370496.0 * most) ELSE draw END AS start FROM p WHERE most >= 3 OR draw < most)
SELECT doc_id, draw::INT AS draw, start::INT AS start, md5(array_to_string(t[(start + 1)::INT : (start + 32)::INT], ' ')) AS x_md5, md5(array_to_string(t[(start + 2)::INT : (start + 33)::INT], ' ')) AS y_md5 FROM s"""
)
def random_windows(spark, sf_dir):
    """Three windows of 32 tokens of every document, as of a shard; a word's length stands in for its id."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.transform(T.words(F.col("text")), lambda w: F.length(w)).alias("tokens"))
    join = lambda c: F.md5(F.array_join(F.transform(c, lambda i: i.cast("string")), " "))
    return S.random_windows(d, 32, 3, 5, "doc_id").select("doc_id", "draw", "start", join("x").alias("x_md5"), join("y").alias("y_md5"))


@query("SELECT p_partkey, (floor(least(floor(p_retailprice * 0.25 / (1 - 0.25)), p_size * 20) / 16) * 16)::BIGINT AS tokens FROM part")
def general_mix(spark, sf_dir):
    """General tokens beside each amount of episode tokens for a quarter of the mix, in chunks of 16."""
    return table(spark, sf_dir, "part").select("p_partkey", S.general_tokens(F.col("p_retailprice"), F.col("p_size") * 20, 0.25, 16).cast("long").alias("tokens"))


@query(
    """WITH n AS (SELECT count(*) AS n FROM documents), d AS (SELECT doc_id, row_number() OVER (ORDER BY md5('9|' || doc_id), doc_id) - 1 AS rank FROM documents),
s AS (SELECT slot, floor(('0x' || left(md5('9|' || slot), 13))::BIGINT / 4503599627370496.0 * n)::BIGINT AS rank FROM n, (SELECT unnest(range((SELECT count(*) + 50 - count(*) FROM documents))) AS slot))
SELECT 'aug_' || lpad(slot::VARCHAR, 5, '0') AS id, doc_id FROM s JOIN d USING (rank)"""
)
def augment_to_target(spark, sf_dir):
    """The rows that fifty new ones are drawn from."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return S.augment(d, d.count() + 50, 9, "doc_id")


@query(
    rf"""WITH g AS (SELECT doc_id, source, {_sql_strip('text')} AS t FROM documents), k AS (SELECT * FROM g WHERE length(t) >= 20 AND length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) / length(t) >= 0.3),
w AS (SELECT source, round(40 * count(*) / sum(count(*)) OVER ()) AS quota FROM documents GROUP BY source), r AS (SELECT k.doc_id, k.source, quota, row_number() OVER (PARTITION BY k.source ORDER BY md5('4|' || doc_id), doc_id) - 1 AS rank FROM k JOIN w USING (source))
SELECT doc_id, source, rank FROM r WHERE rank < quota"""
)
def replay_sample(spark, sf_dir):
    """Forty passages, sources weighted by their rows."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return S.replay(d, d.groupBy("source").agg(F.count("*").alias("weight")), 40, 4).select("doc_id", "source", F.col("rank").cast("long").alias("rank"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 50 > 0 THEN round((50 - o_orderkey % 50) * o_totalprice / (o_orderkey % 50) / 60) END AS minutes FROM orders")
def eta(spark, sf_dir):
    """Minutes left at the pace so far."""
    done = F.col("o_orderkey") % 50
    return table(spark, sf_dir, "orders").select("o_orderkey", S.eta_minutes(done, 50 - done, F.col("o_totalprice")).alias("minutes"))


@query("SELECT event_type AS kind, count(*) AS n, round(avg(value), 6) AS mean, round(sum(value) / (SELECT sum(value) FROM events), 6) AS share FROM events GROUP BY event_type")
def loss_by_class(spark, sf_dir):
    """Mean loss of each class of tokens; events stand in for tokens."""
    out = S.loss_by_class(table(spark, sf_dir, "events"), F.col("event_type"), "value")
    return out.select("kind", "n", F.round("mean", 6).alias("mean"), F.round("share", 6).alias("share"))


@query(
    f"""SELECT conv_id, count(*) FILTER (role = 'user') AS user_messages, count(*) FILTER (role = 'assistant') AS assistant_messages, count(*) FILTER (role = 'user' AND turn % 5 = 0) AS with_context,
 count(*) FILTER (role = 'assistant' AND turn % 4 = 1) AS with_think, count(*) FILTER (role = 'assistant' AND turn % 2 = 1) AS with_cite FROM conversations GROUP BY conv_id"""
)
def optional_fields(spark, sf_dir):
    """How often optional fields of messages are present."""
    m = _tool_messages(spark, sf_dir)
    n = lambda test: F.size(F.filter("messages", test)).cast("long")
    bot = lambda x: x["role"].startswith("assistant")
    return m.select(
        "conv_id", n(lambda x: x["role"] == "user").alias("user_messages"), n(bot).alias("assistant_messages"), n(lambda x: (x["role"] == "user") & (F.trim(x["context"]) != "")).alias("with_context"),
        n(lambda x: bot(x) & (F.trim(x["think"]) != "")).alias("with_think"), n(lambda x: bot(x) & (F.trim(x["cite"]) != "")).alias("with_cite"),
    )
