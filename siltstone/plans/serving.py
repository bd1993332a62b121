"""Queries of tokens, packing, retrieval, audit and evaluation."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit as A
from ..operators import episodes as E
from ..operators import evaluation as V
from ..operators import packing as P
from ..operators import retrieval as R
from ..registry import query, table
from .text import _sql_strip, _sql_words

# ---- tokens and packing


@query("SELECT row_number() OVER (ORDER BY unicode(ch)) - 1 AS id, ch FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''")
def char_vocab(spark, sf_dir):
    """Sorted distinct characters; the vocabulary is a few thousand rows at most."""
    chars = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "")).alias("ch")).where("ch <> ''").distinct()
    return chars.select((F.row_number().over(W.orderBy("ch")) - 1).cast("long").alias("id"), "ch")


@query(
    """WITH v AS (SELECT row_number() OVER (ORDER BY unicode(ch)) - 1 AS id, ch FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''),
p AS (SELECT doc_id, i, cs[i] AS ch FROM (SELECT doc_id, cs, unnest(range(1, len(cs) + 1)) AS i FROM (SELECT doc_id, string_split(text, '') AS cs FROM documents)))
SELECT doc_id, md5(string_agg(v.id::VARCHAR, ' ' ORDER BY i)) AS ids_md5, count(*) AS n FROM p JOIN v ON p.ch = v.ch GROUP BY doc_id"""
)
def char_encode(spark, sf_dir):
    """Character ids of every text, looked up where the text lies. The vocabulary is bounded by the number of characters
    that exist, so it is a literal."""
    vocab = char_vocab(spark, sf_dir).collect()
    if not vocab:
        return spark.createDataFrame([], "doc_id long, ids_md5 string, n long")
    ids = F.map_from_arrays(F.lit([r.ch for r in vocab]), F.lit([r.id for r in vocab]))
    d = table(spark, sf_dir, "documents").where("text <> ''").select("doc_id", F.transform(F.split("text", ""), lambda c: F.element_at(ids, c)).alias("ids"))
    return d.select("doc_id", F.md5(F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")).alias("ids_md5"), F.size("ids").cast("long").alias("n"))


@query(f"SELECT doc_id, floor(length(text) / 4)::BIGINT AS by_chars, floor(len({_sql_words('text')}) / 0.75)::BIGINT AS by_words FROM documents")
def approx_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.floor(F.length("text") / 4).alias("by_chars"), F.floor(T.word_count(F.col("text")) / 0.75).cast("long").alias("by_words"))


@query(
    f"""WITH w AS (SELECT doc_id, list_transform({_sql_words('text')}, lambda x: length(x)) AS s FROM documents), k AS (SELECT doc_id, len(s) AS n, list_concat(CASE WHEN len(s) > 65 THEN s[len(s) - 64 : len(s)] ELSE s END, list_transform(range(greatest(65 - len(s), 0)::INT), lambda i: -1)) AS s FROM w)
SELECT doc_id, md5(array_to_string(s[1:64], ' ')) AS x_md5, md5(array_to_string(s[2:65], ' ')) AS y_md5 FROM k"""
)
def xy_windows(spark, sf_dir):
    """Inputs and shifted targets of 64 tokens; a word's length stands in for its id."""
    d = table(spark, sf_dir, "documents").select("doc_id", P.xy_windows(F.transform(T.words(F.col("text")), lambda w: F.length(w)), 64, -1).alias("p"))
    join = lambda c: F.md5(F.array_join(F.transform(c, lambda i: i.cast("string")), " "))
    return d.select("doc_id", join("p.x").alias("x_md5"), join("p.y").alias("y_md5"))


def _episodes(spark, sf_dir):
    n = T.word_count(F.col("text"))
    return table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.sum(n + 2).alias("tokens"))


_NEW = "r.\"offset\" + r.tokens + e.n > 1024 OR r.segment >= 255"


@query(
    f"""WITH RECURSIVE t AS (SELECT conv_id AS id, conv_id % 4 AS part, least(sum(len({_sql_words('text')}) + 2), 1024)::BIGINT AS n FROM conversations GROUP BY conv_id), e AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY id) AS rn FROM t),
r AS (SELECT part, rn, id, 0::BIGINT AS block, 1::BIGINT AS segment, 0::BIGINT AS "offset", n AS tokens FROM e WHERE rn = 1 UNION ALL
 SELECT e.part, e.rn, e.id, CASE WHEN {_NEW} THEN r.block + 1 ELSE r.block END, CASE WHEN {_NEW} THEN 1 ELSE r.segment + 1 END, CASE WHEN {_NEW} THEN 0 ELSE r."offset" + r.tokens END, e.n FROM r JOIN e ON e.part = r.part AND e.rn = r.rn + 1)
SELECT part, block, id, segment, "offset", tokens FROM r"""
)
def next_fit_pack(spark, sf_dir):
    return P.next_fit(_episodes(spark, sf_dir), 1024, parts=4)


@query()
def best_fit_pack(spark, sf_dir):
    return P.best_fit(_episodes(spark, sf_dir), 1024, parts=4)


@query()
def mega_episodes(spark, sf_dir):
    """Documents joined in order to blocks of 4,096 words."""
    n = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), T.word_count(F.col("text")).alias("tokens"))
    return P.mega_episodes(n, 4096, parts=4)


@query()
def packing_stats(spark, sf_dir):
    return P.packing_stats(best_fit_pack(spark, sf_dir), 1024)


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS pos FROM conversations")
def segment_positions(spark, sf_dir):
    """Position within a segment of a block: conversations stand in for blocks, roles for segments."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.row_number().over(W.partitionBy("conv_id", "role").orderBy("turn")) - 1).cast("long").alias("pos"))


# ---- episodes

_SER = "string_agg('<' || role || '>' || text || '</' || role || '>', '' ORDER BY turn) || '<eot>'"


@query(
    f"""SELECT conv_id, md5({_SER}) AS text_md5,
 md5(string_agg(CASE WHEN role = 'assistant' THEN repeat('0', 11) || repeat('1', length(text) + 12) ELSE repeat('0', length(text) + 2 * length(role) + 5) END, '' ORDER BY turn) || '00000') AS mask_md5 FROM conversations GROUP BY conv_id"""
)
def serialize_chat(spark, sf_dir):
    """Text with role tags and its character mask: 1 on assistant bodies and their closing tags."""
    opened, closed = F.concat(F.lit("<"), "role", F.lit(">")), F.concat(F.lit("</"), "role", F.lit(">"))
    mask = F.when(F.col("role") == "assistant", F.concat(F.repeat(F.lit("0"), F.length(opened)), F.repeat(F.lit("1"), F.length("text") + F.length(closed)))).otherwise(F.repeat(F.lit("0"), F.length(opened) + F.length("text") + F.length(closed)))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", F.concat(opened, "text", closed).alias("s"), mask.alias("m")).alias("x"))
    e = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    join = lambda f, end: F.md5(F.concat(F.array_join(F.transform("x", lambda p: p[f]), ""), F.lit(end)))
    return e.select("conv_id", join("s", "<eot>").alias("text_md5"), join("m", "00000").alias("mask_md5"))


def _token_mask(spark, sf_dir):
    """Tokens are words and tags; the mask is a fold over them: 0 at the opening tag, 1 to the closing one, 1 at the end."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", F.concat(F.array(F.concat(F.lit("<"), "role", F.lit(">"))), T.words(F.col("text")), F.array(F.concat(F.lit("</"), "role", F.lit(">")))).alias("t")).alias("x"))
    e = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    tokens = F.concat(F.flatten(F.transform("x", lambda p: p["t"])), F.array(F.lit("<eot>")))
    start = F.struct(F.array().cast("array<int>").alias("m"), F.lit(False).alias("on"))

    def step(s, t):
        bit = F.when(t == "<assistant>", 0).when((t == "</assistant>") | (t == "<eot>") | s["on"], 1).otherwise(0)
        return F.struct(F.array_append(s["m"], bit).alias("m"), F.when(t == "<assistant>", True).when(t == "</assistant>", False).otherwise(s["on"]).alias("on"))

    return e.select("conv_id", tokens.alias("tokens")).withColumn("mask", F.aggregate("tokens", start, step, lambda s: s["m"]))


@query(
    f"""WITH n AS (SELECT conv_id, sum(len({_sql_words('text')}) + 2) + 1 AS n_tokens, coalesce(sum(len({_sql_words('text')}) + 1) FILTER (role = 'assistant'), 0) + 1 AS n_on, count(*) FILTER (role = 'assistant') AS a FROM conversations GROUP BY conv_id)
SELECT conv_id, n_tokens::BIGINT AS n_tokens, n_on::BIGINT AS n_on, (n_on + a + 1)::BIGINT AS weight FROM n"""
)
def loss_mask(spark, sf_dir):
    """Masked tokens, and the weight when closing tags and the end count twice."""
    m = _token_mask(spark, sf_dir)
    pairs = F.arrays_zip("tokens", "mask")
    stops = F.size(F.filter(pairs, lambda p: p["tokens"].isin("</assistant>", "<eot>")))
    on = F.size(F.filter("mask", lambda x: x == 1))
    return m.select("conv_id", F.size("tokens").cast("long").alias("n_tokens"), on.cast("long").alias("n_on"), (on + stops).cast("long").alias("weight"))


@query(
    """WITH a AS (SELECT conv_id, bool_or(role = 'assistant') AS has FROM conversations GROUP BY conv_id)
SELECT conv_id, unnest(CASE WHEN conv_id % 5 = 0 THEN ['eot_off'] ELSE [] END || CASE WHEN conv_id % 7 = 0 AND has THEN ['early_mask', 'open_on'] ELSE [] END) AS issue FROM a WHERE conv_id % 5 = 0 OR (conv_id % 7 = 0 AND has)"""
)
def mask_validate(spark, sf_dir):
    """Faults of masks. Every fifth mask has its end switched off and every seventh its opening tags switched on."""
    m = _token_mask(spark, sf_dir)
    pairs = F.transform(F.arrays_zip("tokens", "mask"), lambda p: F.struct(p["tokens"].alias("t"), F.when((p["tokens"] == "<eot>") & (F.col("conv_id") % 5 == 0), 0).when((p["tokens"] == "<assistant>") & (F.col("conv_id") % 7 == 0), 1).otherwise(p["mask"]).alias("m")))
    m = m.select("conv_id", pairs.alias("p"))
    has = lambda t, v: F.exists("p", lambda x: (x["t"] == t) & (x["m"] == v))
    first_on = F.array_position(F.transform("p", lambda x: x["m"]), 1)
    first_open = F.array_position(F.transform("p", lambda x: x["t"]), "<assistant>")
    issues = F.array(F.when(has("<assistant>", 1), "open_on"), F.when(has("</assistant>", 0), "close_off"), F.when(has("<eot>", 0), "eot_off"), F.when((first_open > 0) & (first_on > 0) & (first_on <= first_open), "early_mask"))
    return m.select("conv_id", F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("issue"))


@query("SELECT conv_id, md5(coalesce(arg_min(text, turn) FILTER (role = 'system'), '')) AS system_md5, (count(*) FILTER (role <> 'system'))::INT AS messages FROM conversations GROUP BY conv_id")
def hoist_system(spark, sf_dir):
    return E.episodes(table(spark, sf_dir, "conversations")).select("conv_id", F.md5("system").alias("system_md5"), F.size("messages").alias("messages"))


@query(
    rf"""WITH l AS (SELECT conv_id, arg_max(text, turn) AS t, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY conv_id), c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT l.conv_id, floor(len({_sql_words('t')}) / 0.75)::BIGINT AS tokens FROM l JOIN c ON l.conv_id = c.conv_id WHERE c.n >= 2 AND floor(len({_sql_words('t')}) / 0.75) BETWEEN 5 AND 800 AND length(regexp_replace(t, '[\x00-\x1f\x7f-\x9f]', '', 'g')) / greatest(length(t), 1) >= 0.9"""
)
def episode_quality(spark, sf_dir):
    """Conversations whose last reply is neither too short, too long nor garbled."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.max_by(F.when(F.col("role") == "assistant", F.col("text")), F.when(F.col("role") == "assistant", F.col("turn"))).alias("t"))
    tokens = F.floor(T.word_count(F.col("t")) / 0.75)
    ok = (F.col("n") >= 2) & tokens.between(5, 800) & (T.printable_ratio(F.col("t")) >= 0.9)
    return c.where(F.col("t").isNotNull() & ok).select("conv_id", tokens.alias("tokens"))


@query(
    """WITH d AS (SELECT doc_id, (doc_id % 4)::INT AS bucket, least(len(string_split(text, chr(10))), 9) AS n FROM documents)
SELECT doc_id, bucket, (CASE bucket WHEN 0 THEN 0 WHEN 1 THEN n // 3 WHEN 2 THEN 2 * n // 3 ELSE n END)::INT AS place, (n + 1)::INT AS passages FROM d"""
)
def position_bucket(spark, sf_dir):
    """Where the answer's passage goes among up to nine distractors: start, a third, two thirds or end, in turn."""
    n = F.least(F.size(F.split("text", "\n")), F.lit(9))
    bucket = (F.col("doc_id") % 4).cast("int")
    at = F.when(bucket == 0, 0).when(bucket == 1, F.floor(n / 3)).when(bucket == 2, F.floor(n * 2 / 3)).otherwise(n).cast("int")
    gold = F.concat(F.slice(F.split("text", "\n"), 1, at), F.array(F.lit("gold")), F.slice(F.split("text", "\n"), at + 1, n - at))
    return table(spark, sf_dir, "documents").select("doc_id", bucket.alias("bucket"), (F.array_position(gold, "gold") - 1).cast("int").alias("place"), F.size(gold).alias("passages"))


@query(
    """WITH RECURSIVE t AS (SELECT conv_id * 100 + turn AS id, CASE WHEN turn > 0 THEN conv_id * 100 + (turn - 1) // 2 END AS parent, CASE WHEN turn % 5 = 4 THEN NULL ELSE turn % 3 END AS rank FROM conversations),
k AS (SELECT parent, arg_max(id, coalesce(rank, 999) * 100000000 - id) AS kid FROM t WHERE parent IS NOT NULL GROUP BY parent),
p AS (SELECT id AS root, 0 AS depth, id FROM t WHERE parent IS NULL UNION ALL SELECT p.root, p.depth + 1, k.kid FROM p JOIN k ON k.parent = p.id)
SELECT root, depth, id FROM p"""
)
def conversation_path(spark, sf_dir):
    """The path from each root to a leaf, at every level through the child of the largest rank (null counts as 999; of
    equal ranks the smallest id). Turns stand in for a message tree."""
    t = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.when(F.col("turn") > 0, F.col("conv_id") * 100 + F.floor((F.col("turn") - 1) / 2)).alias("parent"), F.when(F.col("turn") % 5 != 4, F.col("turn") % 3).alias("rank"))
    t.createOrReplaceTempView("siltstone_tree")
    t.where("parent is not null").groupBy("parent").agg(F.max_by("id", F.struct(F.coalesce("rank", F.lit(999)), -F.col("id"))).alias("kid")).createOrReplaceTempView("siltstone_kids")
    return spark.sql(
        """WITH RECURSIVE p AS (SELECT id AS root, 0 AS depth, id FROM siltstone_tree WHERE parent IS NULL UNION ALL
        SELECT p.root, p.depth + 1, k.kid FROM p JOIN siltstone_kids k ON k.parent = p.id) SELECT root, depth, id FROM p"""
    )


@query(
    """WITH o AS (SELECT unnest(['COPY', 'WRAP', 'EXTRACT']) AS op), t AS (SELECT unnest(range(6)) AS tpl), c AS (SELECT p_partkey, op, tpl, row_number() OVER (PARTITION BY p_partkey, op ORDER BY md5('3|' || p_partkey || '|' || op || '|' || tpl), tpl) AS r FROM part, o, t)
SELECT p_partkey, op, tpl::INT AS tpl FROM c WHERE r <= 2"""
)
def operator_cross(spark, sf_dir):
    """Every payload in all three operators with two of six templates each; both lists are literals, so rows only explode."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array(*map(F.lit, ("COPY", "WRAP", "EXTRACT")))).alias("op"))
    key = lambda i: F.md5(F.concat_ws("|", F.lit("3"), F.col("p_partkey").cast("string"), "op", i.cast("string")))
    ranked = F.slice(F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.struct(key(i).alias("k"), i.alias("tpl")))), 1, 2)
    return parts.select("p_partkey", "op", F.explode(ranked).alias("x")).select("p_partkey", "op", F.col("x.tpl").alias("tpl"))


# ---- retrieval

_BREAK = "coalesce(" + ", ".join(f"CASE WHEN contains(g, {s}) THEN lo + length(g) - strpos(reverse(g), reverse({s})) + 1 END" for s in ("chr(10) || chr(10)", "chr(10)", "'. '", "'! '", "'? '", "'.' || chr(10)", "'!' || chr(10)", "'?' || chr(10)", "' '")) + ", s + 1200)"


@query(
    rf"""WITH a AS (SELECT doc_id, text AS t, length(text) AS n, unnest(CASE WHEN length(text) < 50 THEN [0] ELSE range(0, length(text), 1000) END) AS s FROM documents WHERE length(text) > 0),
b AS (SELECT *, greatest(s + 1100, 0) AS lo, substr(t, (s + 1101)::BIGINT, least(150, greatest(n - s - 1100, 0))::BIGINT) AS g FROM a), c AS (SELECT *, CASE WHEN n < 50 OR s + 1200 >= n THEN n ELSE {_BREAK} END AS e FROM b)
SELECT doc_id, s::INT AS start_char, e::INT AS end_char, md5(CASE WHEN n < 50 THEN t ELSE {_sql_strip('substr(t, (s + 1)::BIGINT, (e - s)::BIGINT)')} END) AS text_md5, (length(left(t, s::BIGINT)) - length(replace(left(t, s::BIGINT), chr(10), '')) + 1)::INT AS start_line FROM c WHERE n < 50 OR e - s >= 50 OR e >= n"""
)
def chunk_documents(spark, sf_dir):
    c = table(spark, sf_dir, "documents").select("doc_id", F.explode(R.chunks(F.col("text"))).alias("c"))
    return c.select("doc_id", "c.start_char", "c.end_char", F.md5("c.text").alias("text_md5"), "c.start_line")


@query(
    """WITH t AS (SELECT doc_id, lower(text) AS t FROM documents), g AS (SELECT doc_id, n, unnest(list_transform(range(1, length(t) - n + 2), lambda i: substr(t, i, n))) AS g FROM t, (SELECT unnest([2, 3, 4, 5]) AS n)),
b AS (SELECT doc_id, ('0x' || left(md5('seed' || g), 2))::INT AS bucket, count(*)::DOUBLE AS c FROM g GROUP BY ALL), s AS (SELECT doc_id, sqrt(sum(c * c)) AS norm, max(c) AS top, count(*) AS buckets FROM b GROUP BY doc_id)
SELECT doc_id, buckets, round(top / norm, 5) AS peak FROM s"""
)
def embed_text(spark, sf_dir):
    """Number of filled buckets and the largest component of each text's hashed embedding."""
    e = R.embed(table(spark, sf_dir, "documents"), "doc_id", "text")
    return e.select("doc_id", F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("buckets"), F.round(F.array_max("embedding").cast("double"), 5).alias("peak"))


_KNN = "s AS (SELECT q.vec_id AS q, v.vec_id AS id, round(list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, id) AS rank FROM s)"


def _knn(spark, sf_dir, k):
    v = table(spark, sf_dir, "embeddings")
    return R.nearest(v, v.where("vec_id % 100 = 0"), k)


@query(f"WITH {_KNN} SELECT q, id, score, rank::INT AS rank FROM r WHERE rank <= 10")
def knn_join(spark, sf_dir):
    """The ten nearest vectors of every hundredth one."""
    return _knn(spark, sf_dir, 10)


@query(f"WITH {_KNN} SELECT id, score FROM r WHERE q = 0 ORDER BY rank LIMIT 5")
def retrieve_topk(spark, sf_dir):
    """The five best hits of one query vector."""
    v = table(spark, sf_dir, "embeddings")
    return R.nearest(v, v.where("vec_id = 0"), 5).select("id", "score")


@query(f"WITH {_KNN} SELECT q, id, score FROM r WHERE rank <= 10 AND score >= 0.3")
def retrieve_threshold(spark, sf_dir):
    """Hits over a score, taken after the ten best are chosen."""
    return _knn(spark, sf_dir, 10).where("score >= 0.3").select("q", "id", "score")


@query("SELECT a.label, round(list_cosine_similarity(a.e, b.e), 6) AS cosine FROM (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS e FROM embeddings GROUP BY label) a JOIN (SELECT label, arg_max(embedding, vec_id)::DOUBLE[] AS e FROM embeddings GROUP BY label) b ON a.label = b.label")
def cosine_pairs(spark, sf_dir):
    """Cosine of the first and the last vector of each label."""
    p = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("a"), F.max_by("embedding", "vec_id").alias("b"))
    return p.select("label", F.round(R.dot(F.col("a"), F.col("b")) / F.sqrt(R.dot(F.col("a"), F.col("a")) * R.dot(F.col("b"), F.col("b"))), 6).alias("cosine"))


@query(
    """WITH l AS (SELECT vec_id, i - 1 AS token, exp(embedding[i] * 10) AS x FROM (SELECT vec_id, embedding::DOUBLE[] AS embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)),
p AS (SELECT vec_id, token, x / sum(x) OVER (PARTITION BY vec_id) AS p FROM l), c AS (SELECT *, sum(p) OVER (PARTITION BY vec_id ORDER BY p DESC, token ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM p)
SELECT vec_id, token::INT AS token, round(p, 6) AS p FROM c WHERE coalesce(before, 0) < 0.9"""
)
def nucleus_filter(spark, sf_dir):
    """The tokens of a nucleus of 0.9: components of a vector stand in for logits."""
    x = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("token", "e")).withColumn("x", F.exp(F.col("e").cast("double") * 10))
    p = x.withColumn("p", F.col("x") / F.sum("x").over(W.partitionBy("vec_id")))
    before = F.sum("p").over(W.partitionBy("vec_id").orderBy(F.desc("p"), "token").rowsBetween(W.unboundedPreceding, -1))
    return p.withColumn("before", F.coalesce(before, F.lit(0.0))).where("before < 0.9").select("vec_id", "token", F.round("p", 6).alias("p"))


@query(
    """WITH u AS (SELECT conv_id, arg_min(text, turn) AS q FROM conversations WHERE role = 'user' GROUP BY conv_id), h AS (SELECT u.conv_id, q, d.doc_id, d.source AS file, d.text AS t, row_number() OVER (PARTITION BY u.conv_id ORDER BY d.doc_id) AS i FROM u JOIN documents d ON d.doc_id // 3 = u.conv_id)
SELECT conv_id, md5('<context>' || string_agg('[' || i || '] (' || file || ') ' || t, chr(10) ORDER BY i) || '</context>' || chr(10) || '<user>' || any_value(q) || '</user>' || chr(10) || '<assistant>') AS prompt_md5 FROM h GROUP BY conv_id"""
)
def rag_prompt(spark, sf_dir):
    """A prompt for each conversation from three documents by number."""
    hits = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 3).alias("conv_id"), F.struct("doc_id", F.col("source").alias("file"), F.col("text")).alias("h"))
    hits = hits.groupBy("conv_id").agg(F.array_sort(F.collect_list("h")).alias("hits"))
    return E.first_user(table(spark, sf_dir, "conversations")).join(hits, "conv_id").select("conv_id", F.md5(R.rag_prompt(F.col("user_msg"), F.col("hits"))).alias("prompt_md5"))


@query(
    """WITH t AS (SELECT conv_id, turn, text || '<toolcall>{"name": "t' || turn || '", "k": ' || conv_id || '}</toolcall> x <toolcall>{bad</toolcall>' || CASE WHEN turn % 2 = 0 THEN '<toolcall>{"k": 1}</toolcall>' ELSE '<toolcall>{"name": "z"}</toolcall>' END AS t FROM conversations)
SELECT conv_id, turn, unnest(CASE WHEN turn % 2 = 0 THEN ['t' || turn] ELSE ['t' || turn, 'z'] END) AS name FROM t"""
)
def tool_calls(spark, sf_dir):
    """Names of the well-formed calls in texts that also hold a broken one and one without a name."""
    call = F.concat(F.col("text"), F.lit('<toolcall>{"name": "t'), F.col("turn"), F.lit('", "k": '), F.col("conv_id"), F.lit("}</toolcall> x <toolcall>{bad</toolcall>"), F.when(F.col("turn") % 2 == 0, '<toolcall>{"k": 1}</toolcall>').otherwise('<toolcall>{"name": "z"}</toolcall>'))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(R.tool_calls(call)).alias("c")).select("conv_id", "turn", "c.name")


@query(
    f"""WITH n AS (SELECT conv_id, turn, role, len({_sql_words('text')})::BIGINT AS n FROM conversations), s AS (SELECT conv_id, max(CASE WHEN role = 'system' THEN n ELSE 0 END) AS sys, max((role = 'system')::INT) AS has FROM n GROUP BY conv_id),
r AS (SELECT n.*, sys, has, sum(CASE WHEN role <> 'system' THEN n ELSE 0 END) OVER (PARTITION BY n.conv_id ORDER BY turn DESC) AS later, count(CASE WHEN role <> 'system' THEN 1 END) OVER (PARTITION BY n.conv_id ORDER BY turn DESC) AS newer FROM n JOIN s ON n.conv_id = s.conv_id)
SELECT conv_id, turn, role, n FROM r WHERE role = 'system' OR later + sys <= 200 OR newer <= 2 - has"""
)
def trim_history(spark, sf_dir):
    return R.trim_history(table(spark, sf_dir, "conversations"), 200)


@query()
def build_index(spark, sf_dir):
    """Chunks of all documents with their embeddings, each of its own text; those under two characters have none and are
    left out."""
    c = table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(R.chunks(F.col("text"), lines=False)).alias("pos", "c"))
    c = c.select(F.concat_ws(":", "doc_id", "pos").alias("chunk_id"), "doc_id", "source", F.col("c.text").alias("text"))
    return R.embed_rows(c, "text", dim=64)


# ---- audit and evaluation

def _lines(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", A.line(F.col("ts"), F.upper("event_type"), F.lit("INFO"), {"user": F.col("user_id").cast("string"), "action": F.col("event_type")}, {"props": F.concat(F.col("props"), F.lit("|"))}, F.concat(F.lit('v "='), F.floor("value").cast("string"))).alias("line"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') || 'Z | ' || upper(event_type) || ' | INFO | user=' || user_id || ' | action=' || event_type || ' | props="' || replace(props || '\\|', '"', '\\"') || '"' || coalesce(' | details="v "=' || floor(value)::BIGINT || '"', '') AS line FROM events"""
)
def audit_format(spark, sf_dir):
    return _lines(spark, sf_dir)


@query("SELECT event_id, date_trunc('milliseconds', ts) AS ts, upper(event_type) AS category, event_type AS action, user_id::VARCHAR AS user, props || '|' AS props, 'v \"=' || floor(value)::BIGINT AS details FROM events")
def audit_parse(spark, sf_dir):
    """Fields read back from formatted lines."""
    p = _lines(spark, sf_dir).select("event_id", A.parse(F.col("line")).alias("p"))
    return p.select("event_id", "p.ts", "p.category", F.col("p.fields.action").alias("action"), F.col("p.fields.user").alias("user"), F.col("p.fields.props").alias("props"), "p.details")


@query("SELECT event_id FROM events WHERE event_type IN ('click', 'purchase', 'error') AND NOT (event_type = 'click' AND value < 1)")
def audit_category_filter(spark, sf_dir):
    """Events of enabled categories; one that the configuration doesn't know is off."""
    config = spark.createDataFrame([("click", True), ("purchase", True), ("error", True), ("view", False)], "event_type string, enabled boolean")
    return table(spark, sf_dir, "events").join(F.broadcast(config), "event_type").where("enabled and not (event_type = 'click' and value < 1)").select("event_id")


@query("SELECT date_trunc('day', ts)::DATE AS day, count(*) AS n FROM events WHERE date_trunc('day', ts) < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 14 DAYS GROUP BY 1")
def retention_expired(spark, sf_dir):
    """Daily logs older than 14 days at a fixed noon."""
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    return e.where(A.expired(F.col("day"), now, 14)).groupBy("day").agg(F.count("*").alias("n"))


@query("SELECT event_type AS category, count(*) AS files, sum(length(props))::BIGINT AS bytes, min(ts) AS oldest, max(ts) AS newest FROM events GROUP BY 1")
def retention_status(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("category")).agg(F.count("*").alias("files"), F.sum(F.length("props")).alias("bytes"), F.min("ts").alias("oldest"), F.max("ts").alias("newest"))


_SERIES = "s AS (SELECT (date_trunc('day', ts)::DATE - DATE '2024-01-01')::INT AS step, avg(CASE WHEN event_type = 'click' THEN value END) / 100 AS train, avg(CASE WHEN event_type = 'view' THEN value END) / 100 AS val FROM events GROUP BY 1)"


def _series(spark, sf_dir):
    """A training log: one evaluation a day, from the means of two kinds of events."""
    mean = lambda kind: F.avg(F.when(F.col("event_type") == kind, F.col("value"))) / 100
    return table(spark, sf_dir, "events").groupBy(F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("step")).agg(mean("click").alias("train"), mean("view").alias("val"))


@query(
    f"""WITH {_SERIES}, g AS (SELECT step, (train - lag(train, 4) OVER w) / 4 AS tg, (val - lag(val, 4) OVER w) / 4 AS vg, (train - val) - lag(train - val, 4) OVER w AS gg FROM s WINDOW w AS (ORDER BY step))
SELECT step, round(tg, 6) AS train_gain, round(vg, 6) AS val_gain, round(gg, 6) AS gap_growth, tg < 0.001 AND vg < 0.001 AS plateau, vg < 0.001 AND tg > 0.001 AND gg > 0 AS memorization, gg > 0.05 AS widening FROM g WHERE tg IS NOT NULL"""
)
def saturation(spark, sf_dir):
    return V.saturation(_series(spark, sf_dir), "step", "train", "val")


@query(f"WITH {_SERIES}, b AS (SELECT step, val, min(val) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM s) SELECT step, round(val, 6) AS val, round(m, 6) AS best_before, m IS NULL OR val < m AS is_best FROM b")
def best_so_far(spark, sf_dir):
    return V.best_so_far(_series(spark, sf_dir), "step", "val").select("step", F.round("val", 6).alias("val"), F.round("best_before", 6).alias("best_before"), "is_best")


@query(f"WITH {_SERIES}, b AS (SELECT step, val, first_value(val) OVER (ORDER BY step) AS f FROM s) SELECT step, round((val - f) / f, 6) AS change, (val - f) / f > 0.05 AS regressed FROM b")
def eval_regression(spark, sf_dir):
    return V.regression(_series(spark, sf_dir), "step", "val")


@query()
def gold_selection(spark, sf_dir):
    return V.gold(_series(spark, sf_dir), "step", "train", "val")


@query(f"WITH {_SERIES} SELECT step, CASE WHEN step >= 20 THEN 'anneal' WHEN step >= 5 THEN 'main' ELSE 'warmup' END AS phase FROM s")
def phase_at_step(spark, sf_dir):
    schedule = spark.createDataFrame([(0, "warmup"), (5, "main"), (20, "anneal")], "start int, phase string")
    return V.phase_at(_series(spark, sf_dir).select("step"), schedule, "step")


@query(
    rf"""WITH a AS (SELECT conv_id, turn, {_sql_strip('text')} AS r FROM conversations WHERE role = 'assistant'), e AS (SELECT *, left(r, 12) AS x FROM a)
SELECT conv_id, turn, starts_with(lower(regexp_replace({_sql_strip("r")}, '[.!?,;:]+$', '')), lower(regexp_replace(x, '[.!?,;:]+$', ''))) AS echo, NOT regexp_matches(r, '`|\*\*|__') AND r = x AS exact, NOT contains(lower(r), 'the') AS clean,
 contains(lower(r), 'unknown') OR contains(lower(r), 'not enough information') OR contains(lower(r), 'cannot determine') OR contains(lower(r), 'have enough information') AS abstains FROM e"""
)
def response_checks(spark, sf_dir):
    """Checks of replies, closed by a tag, against their own first twelve characters."""
    a = table(spark, sf_dir, "conversations").where("role = 'assistant'").withColumn("g", F.concat("text", F.lit("</assistant> rest <eot>"))).withColumn("x", F.substring(T.strip(F.col("text")), 1, 12))
    return a.select("conv_id", "turn", V.echo(F.col("g"), F.col("x")).alias("echo"), V.exact_only(F.col("g"), F.col("x")).alias("exact"), V.lacks(F.col("g"), F.lit("the")).alias("clean"), V.abstains(F.col("g")).alias("abstains"))


@query("SELECT o_orderkey, CASE WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN printf('%.1f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576) ELSE printf('%.2f GB', b / 1073741824) END AS size FROM (SELECT o_orderkey, floor(o_totalprice * (o_orderkey % 1000) * 7)::BIGINT AS b FROM orders)")
def format_size(spark, sf_dir):
    b = F.floor(F.col("o_totalprice") * (F.col("o_orderkey") % 1000) * 7)
    return table(spark, sf_dir, "orders").select("o_orderkey", V.human_size(b).alias("size"))


@query()
def lineage_flatten(spark, sf_dir):
    """Shares of the leaves of a mixed dataset; regions, nations and customers stand in for its inputs."""
    nations = table(spark, sf_dir, "nation")
    per = nations.groupBy("n_regionkey").count()
    edges = per.select(F.lit("mix").alias("dataset"), F.concat(F.lit("r"), "n_regionkey").alias("input"), (F.col("count") / F.sum("count").over(W.partitionBy(F.lit(1)))).alias("ratio"))
    inner = nations.join(per, "n_regionkey").select(F.concat(F.lit("r"), "n_regionkey").alias("dataset"), F.concat(F.lit("n"), "n_nationkey").alias("input"), (1 / F.col("count")).alias("ratio"))
    return A.flatten_lineage(edges.unionByName(inner), "mix").select("node", F.round("share", 6).alias("share"))


@query(
    "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text)) WHERE b.text <> ''"
)
def eval_leak(spark, sf_dir):
    """Documents that quote a benchmark item word for word: an equi-join on three words inside it, then the whole text.

    An item's first and last word may be parts of longer ones in a document, so the key is taken from between them; items
    with no three words between them are few by nature and compared with all documents.
    """
    key = lambda w: F.xxhash64(F.array_join(w, " "))
    w = F.split(F.lower("text"), "[ \n]")
    items = table(spark, sf_dir, "benchmark").where("text <> ''").select("item_id", F.lower("text").alias("b"), F.slice(w, 2, 3).alias("k"), F.size(w).alias("n"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t"))
    grams = F.transform(F.array(F.split("t", "[ \n]")), lambda x: F.array_distinct(F.transform(F.slice(x, 1, F.greatest(F.size(x) - 2, F.lit(0))), lambda y, i: F.xxhash64(F.concat_ws(" ", y, F.get(x, i + 1), F.get(x, i + 2))))))[0]
    hits = d.select("doc_id", F.explode(grams).alias("k")).join(items.where("n >= 5").select("item_id", key(F.col("k")).alias("k")), "k").select("doc_id", "item_id").distinct()
    found = hits.join(d, "doc_id").join(items.select("item_id", "b"), "item_id").where(F.contains("t", "b")).select("doc_id", "item_id")
    short = items.where("n < 5").select("item_id", "b")
    return found.unionByName(d.join(short, F.contains("t", "b")).select("doc_id", "item_id"))
