"""Queries of deduplication and of the joins that stand beside it."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import dedup as D
from ..operators import episodes as E
from ..registry import query, table
from .text import _sql_strip


@query("SELECT sha256(text) AS sha, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def exact_dedup(spark, sf_dir):
    return D.exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("key", "sha")


@query(
    rf"""WITH l AS (SELECT doc_id, i - 1 AS line_no, {_sql_strip(r'''regexp_replace(lower(ls[i]), '\s+', ' ', 'g')''')} AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
g AS (SELECT md5(line) AS line_md5, min((doc_id, line_no)) AS r, count(*) AS copies FROM l WHERE length(line) BETWEEN 20 AND 2000 AND length(line) - length(replace(line, ' ', '')) >= 3 GROUP BY 1)
SELECT line_md5, r[1] AS doc_id, r[2] AS line_no, copies FROM g"""
)
def line_dedup(spark, sf_dir):
    return D.line_dedup(table(spark, sf_dir, "documents"))


_SIMHASH = r"""w AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^a-z0-9\s]', '', 'g'), '\s+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g FROM w),
m AS (SELECT doc_id, ('0x' || substr(md5(g), 17, 16))::UBIGINT AS m FROM g),
b AS (SELECT doc_id, pos, sum(CASE WHEN (m >> pos::UBIGINT) & 1 = 1 THEN 1 ELSE -1 END) AS s FROM m, (SELECT unnest(range(64)) AS pos) GROUP BY doc_id, pos),
f AS (SELECT doc_id, bit_or(CASE WHEN s > 0 THEN 1::UBIGINT << pos::UBIGINT ELSE 0::UBIGINT END) AS u FROM b GROUP BY doc_id),
fp AS (SELECT doc_id, CASE WHEN u >= 9223372036854775808 THEN (u::HUGEINT - 18446744073709551616)::BIGINT ELSE u::BIGINT END AS fingerprint, u FROM f)"""


@query(f"WITH {_SIMHASH} SELECT doc_id, fingerprint FROM fp")
def simhash(spark, sf_dir):
    return D.simhash(table(spark, sf_dir, "documents"))


@query(
    f"""WITH {_SIMHASH}, r AS (SELECT u, min(doc_id) AS rep FROM fp GROUP BY u)
SELECT a.rep AS a, b.rep AS b, bit_count(xor(a.u, b.u))::INT AS distance FROM r a JOIN r b ON a.rep < b.rep AND bit_count(xor(a.u, b.u)) <= 4"""
)
def near_dup_pairs(spark, sf_dir):
    return D.near_pairs(D.simhash(table(spark, sf_dir, "documents")))


@query()
def near_dedup(spark, sf_dir):
    return D.greedy_near_dedup(D.simhash(table(spark, sf_dir, "documents")))


@query(
    """WITH s AS (SELECT conv_id, md5(string_agg(role || ':' || text, '||' ORDER BY turn)) AS signature FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id)
SELECT signature, min(conv_id) AS conv_id, count(*) AS copies FROM s GROUP BY signature"""
)
def episode_dedup(spark, sf_dir):
    return D.first_by(E.episode_signature(table(spark, sf_dir, "conversations")), F.col("signature"), "conv_id").withColumnRenamed("key", "signature")


@query(
    """WITH u AS (SELECT conv_id, arg_min(text, turn) AS m FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT md5(m) AS user_md5, min(conv_id) AS conv_id, count(*) AS copies FROM u GROUP BY m"""
)
def user_msg_dedup(spark, sf_dir):
    return D.first_by(E.first_user(table(spark, sf_dir, "conversations")), F.md5("user_msg"), "conv_id").withColumnRenamed("key", "user_md5")


@query(
    """WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x, i: {'x': x, 'i': i}) AS ls FROM documents)
SELECT doc_id, len(list_filter(ls, lambda a: len(list_filter(ls, lambda b: contains(b.x, a.x) AND (length(b.x) > length(a.x) OR (b.x = a.x AND b.i < a.i)))) = 0))::INT AS kept, len(ls)::INT AS lines FROM l"""
)
def substring_dedup(spark, sf_dir):
    """Lines of each document that no other of its lines contains."""
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(D.drop_contained(lines)).alias("kept"), F.size(lines).alias("lines"))


_SIGS = rf"""u AS (SELECT conv_id, arg_min(text, turn) AS m FROM conversations WHERE role = 'user' GROUP BY conv_id),
p AS (SELECT conv_id, m, CASE WHEN regexp_extract(m, '"([^"]+)"', 1) <> '' THEN regexp_extract(m, '"([^"]+)"', 1) WHEN regexp_extract(m, ':\s*(.+)$', 1) <> '' THEN {_sql_strip(r"regexp_extract(m, ':\s*(.+)$', 1)")} END AS payload FROM u),
s AS (SELECT conv_id, payload, {_sql_strip(r'''regexp_replace(CASE WHEN payload <> '' AND contains(m, payload) THEN replace(replace(m, '"' || payload || '"', '"{PAYLOAD}"'), payload, '{PAYLOAD}') ELSE m END, '\s+', ' ', 'g')''')} AS template,
 CASE WHEN payload <> '' THEN CASE WHEN conv_id % 2 = 0 THEN 'COPY' ELSE 'WRAP' END || '::' || payload END AS pair FROM p),
t AS (SELECT * FROM s WHERE conv_id % 3 <> 0),
c AS (SELECT conv_id, CASE WHEN payload <> '' AND payload IN (SELECT payload FROM t WHERE payload <> '') THEN 'payload' WHEN template IN (SELECT template FROM t WHERE template <> '') THEN 'template'
 WHEN pair IN (SELECT pair FROM t WHERE pair <> '') THEN 'pair' END AS blocked_by FROM s WHERE conv_id % 3 = 0)"""


def _signatures(spark, sf_dir):
    return E.signatures(table(spark, sf_dir, "conversations"), F.when(F.col("conv_id") % 2 == 0, "COPY").otherwise("WRAP"))


def _blocked(spark, sf_dir):
    """Every third conversation is a candidate, the rest are training data."""
    sigs = _signatures(spark, sf_dir)
    return E.blocked_by(sigs.where("conv_id % 3 = 0"), sigs.where("conv_id % 3 <> 0"))


@query(f"WITH {_SIGS} SELECT conv_id, payload, template FROM s")
def template_signature(spark, sf_dir):
    return _signatures(spark, sf_dir).select("conv_id", "payload", "template")


@query(f"WITH {_SIGS} SELECT conv_id FROM c WHERE blocked_by IS NULL")
def disjoint_filter(spark, sf_dir):
    return _blocked(spark, sf_dir).where("blocked_by is null").select("conv_id")


@query(f"WITH {_SIGS} SELECT coalesce(blocked_by, 'kept') AS outcome, count(*) AS n FROM c GROUP BY 1")
def disjoint_filter_stats(spark, sf_dir):
    return _blocked(spark, sf_dir).groupBy(F.coalesce("blocked_by", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


@query(f"WITH {_SIGS} SELECT conv_id FROM c WHERE blocked_by IS NULL ORDER BY md5('7|' || conv_id), conv_id LIMIT 10")
def take_disjoint(spark, sf_dir):
    """Ten disjoint candidates in a seeded order."""
    kept = _blocked(spark, sf_dir).where("blocked_by is null").select("conv_id")
    return kept.orderBy(F.md5(F.concat(F.lit("7|"), F.col("conv_id").cast("string"))), "conv_id").limit(10)


@query(f"WITH {_SIGS} SELECT 'payload' AS what, count(*) AS n FROM (SELECT payload FROM s WHERE conv_id % 3 = 0 AND payload <> '' INTERSECT SELECT payload FROM t) UNION ALL SELECT 'template', count(*) FROM (SELECT template FROM s WHERE conv_id % 3 = 0 INTERSECT SELECT template FROM t)")
def train_val_overlap(spark, sf_dir):
    sigs = _signatures(spark, sf_dir)
    train, val = sigs.where("conv_id % 3 <> 0"), sigs.where("conv_id % 3 = 0")
    count = lambda k: val.where(f"{k} <> ''").select(k).intersect(train.select(k)).agg(F.count("*").alias("n")).select(F.lit(k).alias("what"), "n")
    return count("payload").unionByName(count("template"))


@query(
    """WITH o AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k, text FROM conversations WHERE role <> 'system'),
t AS (SELECT conv_id + 1 AS conv_id, role, k, reverse(text) AS text FROM o WHERE k = 1)
SELECT coalesce(o.conv_id, t.conv_id) AS conv_id, coalesce(o.role, t.role) AS role, coalesce(o.k, t.k) AS k, md5(coalesce(t.text, o.text)) AS text_md5,
 CASE WHEN o.conv_id IS NULL THEN 'new' WHEN t.conv_id IS NULL THEN 'original' ELSE 'translated' END AS origin FROM o FULL JOIN t ON o.conv_id = t.conv_id AND o.role = t.role AND o.k = t.k"""
)
def recombine_messages(spark, sf_dir):
    """Messages with their translations by (conversation, role, ordinal); translations of unknown messages are added."""
    turns = table(spark, sf_dir, "conversations").where("role <> 'system'")
    o = turns.select("conv_id", "role", F.row_number().over(W.partitionBy("conv_id", "role").orderBy("turn")).cast("long").alias("k"), "text")
    t = o.where("k = 1").select((F.col("conv_id") + 1).alias("conv_id"), "role", "k", F.reverse("text").alias("new"), F.lit(True).alias("t"))
    both = o.withColumn("o", F.lit(True)).join(t, ["conv_id", "role", "k"], "full_outer")
    origin = F.when(F.col("o").isNull(), "new").when(F.col("t").isNull(), "original").otherwise("translated")
    return both.select("conv_id", "role", "k", F.md5(F.coalesce("new", "text")).alias("text_md5"), origin.alias("origin"))


@query(
    """WITH l AS (SELECT doc_id, i - 1 AS line_no, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))
SELECT a.doc_id, a.line_no, md5(a.line) AS a, md5(b.line) AS b FROM l a JOIN l b ON b.doc_id = a.doc_id + 1 AND b.line_no = a.line_no WHERE a.doc_id % 2 = 0 AND length(trim(a.line)) >= 3 AND length(trim(b.line)) >= 3"""
)
def parallel_zip(spark, sf_dir):
    """Line pairs of an even document and its successor, by line number; the shorter one ends the pairing."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).withColumn("line_no", F.col("n").cast("long")).where(F.length(F.trim("line")) >= 3)
    a, b = lines.where("doc_id % 2 = 0").alias("a"), lines.where("doc_id % 2 = 1").select((F.col("doc_id") - 1).alias("doc_id"), "line_no", F.col("line").alias("other"))
    return a.join(b, ["doc_id", "line_no"]).select("doc_id", "line_no", F.md5("line").alias("a"), F.md5("other").alias("b"))


@query("SELECT conv_id, turn, (SELECT min(n.turn) FROM conversations n WHERE n.conv_id = c.conv_id AND n.turn > c.turn AND n.role = 'assistant') AS reply_turn FROM conversations c WHERE role = 'user'")
def next_assistant(spark, sf_dir):
    return E.next_assistant(table(spark, sf_dir, "conversations"))
