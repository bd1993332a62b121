"""Queries of sampling, mixing, budgets, ordered windows and epochs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import mixing as M
from ..operators.ordered import rank_within, running_total, shuffled_rank
from ..registry import query, table
from .text import _sql_words

_TOK = f"len({_sql_words('text')})"
# Weights of the sources: their number plus one.
_COUNTS = f"c AS (SELECT source AS name, sum({_TOK})::BIGINT AS tokens, (substr(source, 4)::INT + 1) AS w FROM documents GROUP BY source), k AS (SELECT name, tokens, w / sum(w) OVER () AS weight FROM c)"


def _counts(spark, sf_dir):
    c = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("name")).agg(F.sum(T.word_count(F.col("text"))).alias("tokens"))
    return M.normalized_weights(c.withColumn("weight", (F.substring("name", 4, 9).cast("int") + 1).cast("double")))


@query(
    f"""WITH {_COUNTS}, i AS (SELECT *, least(tokens, round_even(weight * 100000, 0)::BIGINT) AS clipped FROM k),
s AS (SELECT *, sum(clipped) OVER () AS total, name = max(name) OVER () AS last FROM i),
v AS (SELECT *, CASE WHEN total < 100000 THEN clipped ELSE least(round_even(clipped * 100000 / total, 0)::BIGINT, clipped) END AS v FROM s)
SELECT name, tokens, (CASE WHEN total >= 100000 AND last THEN least(100000 - (sum(v) OVER () - v), clipped) ELSE v END)::BIGINT AS target, 1::BIGINT AS repeats FROM v"""
)
def target_tokens_clip(spark, sf_dir):
    return M.target_tokens(_counts(spark, sf_dir), 100_000)


@query(f"WITH {_COUNTS}, i AS (SELECT *, round_even(weight * 3000000, 0)::BIGINT AS t FROM k) SELECT name, tokens, t AS target, CASE WHEN tokens >= t THEN 1 ELSE ceil(t / tokens) END::BIGINT AS repeats FROM i")
def target_tokens_repeat(spark, sf_dir):
    return M.target_tokens(_counts(spark, sf_dir), 3_000_000, repeat=True)


@query(
    f"""WITH n AS (SELECT source, doc_id, {_TOK}::BIGINT AS n FROM documents), r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM n)
SELECT source, doc_id, n, before, least(n, 8000 - before)::BIGINT AS take FROM r WHERE before < 8000"""
)
def budget_cut(spark, sf_dir):
    return M.budget_cut(table(spark, sf_dir, "documents").select("source", "doc_id", "text"), "source", "doc_id", T.word_count(F.col("text")), 8000)


@query("WITH r AS (SELECT doc_id, length(text) AS n, coalesce(sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM documents) SELECT * FROM r WHERE before < 500000")
def char_budget(spark, sf_dir):
    return M.char_budget(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", F.length("text").cast("long"), 500_000)


@query(
    f"""WITH n AS (SELECT doc_id, {_TOK}::BIGINT AS n FROM documents WHERE text <> ''), r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM n WHERE n > 0),
s AS (SELECT *, unnest(range(b // 10000, (b + n - 1) // 10000 + 1)) AS shard FROM r)
SELECT doc_id, shard, greatest(shard * 10000 - b, 0)::BIGINT AS first, (least((shard + 1) * 10000, b + n) - greatest(shard * 10000, b))::BIGINT AS tokens FROM s"""
)
def token_shards(spark, sf_dir):
    """Shards of exactly 10,000 tokens over all documents in order; a document may lie in several."""
    n = table(spark, sf_dir, "documents").select("doc_id", T.word_count(F.col("text")).alias("n")).where("n > 0")
    r = running_total(n, ["doc_id"], F.col("n"), "b")
    s = r.withColumn("shard", F.explode(F.sequence(F.floor(F.col("b") / 10000), F.floor((F.col("b") + F.col("n") - 1) / 10000))))
    return s.select("doc_id", "shard", F.greatest(F.col("shard") * 10000 - F.col("b"), F.lit(0)).alias("first"), (F.least((F.col("shard") + 1) * 10000, F.col("b") + F.col("n")) - F.greatest(F.col("shard") * 10000, F.col("b"))).alias("tokens"))


@query(
    f"""WITH n AS (SELECT doc_id, {_TOK}::BIGINT AS n FROM documents), r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM n WHERE n > 0), t AS (SELECT sum(n) // 512 AS blocks FROM n),
s AS (SELECT *, unnest(range(b // 512, (b + n - 1) // 512 + 1)) AS block FROM r)
SELECT block, count(*) AS parts, min(doc_id) AS first_doc, sum(least((block + 1) * 512, b + n) - greatest(block * 512, b))::BIGINT AS tokens FROM s, t WHERE block < blocks GROUP BY block"""
)
def fixed_blocks(spark, sf_dir):
    """Blocks of 512 tokens over the whole stream, the tail dropped."""
    n = table(spark, sf_dir, "documents").select("doc_id", T.word_count(F.col("text")).alias("n")).where("n > 0")
    r = running_total(n, ["doc_id"], F.col("n"), "b")
    s = r.withColumn("block", F.explode(F.sequence(F.floor(F.col("b") / 512), F.floor((F.col("b") + F.col("n") - 1) / 512))))
    held = F.least((F.col("block") + 1) * 512, F.col("b") + F.col("n")) - F.greatest(F.col("block") * 512, F.col("b"))
    return s.groupBy("block").agg(F.count("*").alias("parts"), F.min("doc_id").alias("first_doc"), F.sum(held).alias("tokens")).where("tokens = 512")


@query("SELECT epoch, doc_id, row_number() OVER (PARTITION BY epoch ORDER BY md5((42 + epoch) || '|' || doc_id), doc_id) - 1 AS pos FROM documents, (SELECT unnest([0, 1]) AS epoch)")
def epoch_order(spark, sf_dir):
    """Two epochs, each a permutation seeded by its number."""
    ids = table(spark, sf_dir, "documents").select("doc_id")
    parts = [shuffled_rank(ids, 42 + e, "doc_id", "pos").withColumn("epoch", F.lit(e)) for e in (0, 1)]
    return parts[0].unionByName(parts[1]).select("epoch", "doc_id", "pos")


@query(
    """WITH e AS (SELECT epoch, doc_id, row_number() OVER (PARTITION BY epoch ORDER BY md5((42 + epoch) || '|' || doc_id), doc_id) - 1 AS pos FROM documents, (SELECT unnest([0, 1]) AS epoch)), n AS (SELECT count(*) AS n FROM documents)
SELECT epoch, doc_id, (epoch * n + pos) // 48 AS batch, (epoch * n + pos) % 48 AS slot FROM e, n"""
)
def epoch_batches(spark, sf_dir):
    """Batches of 48 through both epochs; a batch may span them."""
    order = epoch_order(spark, sf_dir)
    n = table(spark, sf_dir, "documents").count()
    step = F.col("epoch") * n + F.col("pos")
    return order.select("epoch", "doc_id", F.floor(step / 48).alias("batch"), (step % 48).alias("slot"))


@query("WITH s AS (SELECT lang, source, doc_id, n_chars, rank() OVER (PARTITION BY lang, source ORDER BY n_chars DESC) AS r FROM documents) SELECT lang, source, doc_id, n_chars FROM s WHERE r = 1")
def latest_version(spark, sf_dir):
    """The newest version (here: the longest document) of each key, ties kept."""
    d = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", "n_chars")
    best = d.groupBy("lang", "source").agg(F.max("n_chars").alias("n_chars"))
    return d.join(best, ["lang", "source", "n_chars"]).select("lang", "source", "doc_id", "n_chars")


@query(
    rf"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]+>', '', 'g'), '^[- ]+|[- ]+$', '', 'g'))), lambda x: len({_sql_words('x')}) >= 2) AS ls FROM documents),
w AS (SELECT doc_id, ls, len(ls) AS n, CASE WHEN len(ls) >= 20 THEN (len(ls) - 20) // 10 + 1 ELSE 0 END AS k FROM l), s AS (SELECT *, unnest(range(0, k + 1)) AS i FROM w)
SELECT doc_id, i::BIGINT AS window_no, len(ls[i * 10 + 1 : least(i * 10 + 20, n)])::BIGINT AS lines, md5(array_to_string(ls[i * 10 + 1 : least(i * 10 + 20, n)], chr(10))) AS text_md5 FROM s WHERE i < k OR n - k * 10 >= 5"""
)
def dialogue_windows(spark, sf_dir):
    """Windows of 20 lines, every 10 lines; the rest, overlap included, if it has 5."""
    clean = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", ""), r"\A[- ]+|[- ]+\z", ""))
    lines = F.filter(F.transform(F.split("text", "\n"), clean), lambda x: F.size(T.words(x)) >= 2)

    def cut(ls):
        n = F.size(ls)
        k = F.when(n >= 20, F.floor((n - 20) / 10) + 1).otherwise(0).cast("int")
        all_ = F.transform(F.sequence(F.lit(0), k), lambda i: F.struct(i.cast("long").alias("window_no"), F.slice(ls, i * 10 + 1, 20).alias("x"), (i < k).alias("full")))
        return F.filter(all_, lambda w: w["full"] | (F.size(w["x"]) >= 5))

    w = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.transform(F.array(lines), cut)[0]).alias("w"))
    return w.select("doc_id", "w.window_no", F.size("w.x").cast("long").alias("lines"), F.md5(F.array_join("w.x", "\n")).alias("text_md5"))


_SHARDS = "s AS (SELECT source AS name, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS shard FROM documents)"


def _shards(spark, sf_dir):
    """Every document stands for one shard of its source."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("name"), "doc_id")
    return rank_within(d, ["name"], ["doc_id"], "shard").select("name", "shard")


@query(f"WITH {_SHARDS}, n AS (SELECT *, count(*) OVER (PARTITION BY name) AS n, row_number() OVER (PARTITION BY name ORDER BY shard DESC) AS r FROM s) SELECT name, shard, CASE WHEN r <= least(greatest(1, round_even(n * 0.1, 0)), n - 1) THEN 'val' ELSE 'train' END AS split FROM n")
def shard_split(spark, sf_dir):
    return M.shard_split(_shards(spark, sf_dir), 0.1)


@query(f"WITH {_SHARDS}, r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY shard DESC) AS r FROM s) SELECT name, shard, r <= 3 AS held FROM r")
def holdback(spark, sf_dir):
    """The last three shards of each source are held back for evaluation."""
    ranked = rank_within(_shards(spark, sf_dir), ["name"], ["shard"])
    return ranked.select("name", "shard", (F.col("size") - F.col("rank") <= 3).alias("held"))


_PLAN = f"""{_SHARDS}, c AS (SELECT name, count(*) AS n FROM s GROUP BY name), p AS (SELECT name, (substr(name, 4)::INT + 1) * 2000 AS target, n - 3 AS train, 3 AS val FROM c),
q AS (SELECT name, target::BIGINT AS target, train::BIGINT AS train, val::BIGINT AS val, greatest(1, floor(floor(target * 0.95) / 500))::BIGINT AS train_needed, least(greatest(1, floor(floor(target * 0.05) / 500)), val)::BIGINT AS val_needed FROM p)"""


def _plan(spark, sf_dir):
    c = _shards(spark, sf_dir).groupBy("name").count()
    target = ((F.substring("name", 4, 9).cast("int") + 1) * 2000).cast("long")
    return M.shard_plan(c.select("name", target.alias("target"), (F.col("count") - 3).alias("train"), F.lit(3).cast("long").alias("val")), 500)


@query(f"WITH {_PLAN} SELECT *, CASE WHEN train_needed < train THEN 'subsample' WHEN train_needed = train THEN 'use_all' ELSE 'upsample' END AS method FROM q")
def shard_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@query(
    f"""WITH {_PLAN}, r AS (SELECT s.name, shard, row_number() OVER (PARTITION BY s.name ORDER BY md5('5|' || s.name || '|' || shard), shard) - 1 AS rank, train, train_needed FROM s JOIN q ON s.name = q.name WHERE shard < train),
m AS (SELECT *, train_needed // train + CASE WHEN rank < train_needed % train THEN 1 ELSE 0 END AS copies FROM r)
SELECT name, shard, unnest(range(copies))::INT AS copy FROM m"""
)
def shard_plan_rows(spark, sf_dir):
    plan = _plan(spark, sf_dir)
    shards = _shards(spark, sf_dir).join(plan.select("name", "train"), "name").where("shard < train").select("name", "shard")
    return M.shard_plan_rows(shards, plan, 5)


@query(
    """WITH t AS (SELECT count(*) FILTER (source <> 'src0') AS d, count(*) FILTER (source = 'src0') AS r FROM documents), n AS (SELECT d, r, least(greatest(1, floor(floor(d * 1000 * 0.2 / 0.8) / 1000)), r)::BIGINT AS s FROM t)
SELECT d * 1000 AS domain_tokens, s AS replay_shards, s * 1000 AS replay_tokens, round(s / (d + s), 6)::DOUBLE AS replay_ratio FROM n"""
)
def replay_mix(spark, sf_dir):
    """Replay shards for a share of 20 % of the whole; every document is a shard of 1,000 tokens, src0 the replay source."""
    t = table(spark, sf_dir, "documents").agg(F.count_if(F.col("source") != "src0").alias("d"), F.count_if(F.col("source") == "src0").alias("r"))
    s = F.least(F.greatest(F.lit(1), F.floor(F.floor(F.col("d") * 1000 * 0.2 / 0.8) / 1000)), F.col("r")).cast("long")
    return t.withColumn("s", s).select((F.col("d") * 1000).alias("domain_tokens"), F.col("s").alias("replay_shards"), (F.col("s") * 1000).alias("replay_tokens"), F.round(F.col("s") / (F.col("d") + F.col("s")), 6).alias("replay_ratio"))


def _ranked(seed: int) -> str:
    return f"r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('{seed}|' || doc_id), doc_id) - 1 AS rank, count(*) OVER () AS n FROM documents)"


@query(f"WITH {_ranked(3)}, c AS (SELECT doc_id, 2 + CASE WHEN rank < floor(n * 0.5) THEN 1 ELSE 0 END AS k FROM r) SELECT doc_id, unnest(range(k))::INT AS copy FROM c")
def ratio_sample(spark, sf_dir):
    """Ratio 2.5: two copies of every document and half of them once more."""
    return M.ratio_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 2.5, 3).select("doc_id", "copy")


@query(f"WITH {_ranked(4)}, c AS (SELECT doc_id, ((1500 - rank - 1) // n + 1) AS k FROM r WHERE rank < 1500) SELECT doc_id, unnest(range(k))::INT AS copy FROM c")
def exact_sample(spark, sf_dir):
    """Exactly 1,500 rows, more than the smallest tables have."""
    return M.exact_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 1500, 4).select("doc_id", "copy")


@query(
    """WITH c AS (SELECT source AS name, count(*)::DOUBLE * (substr(source, 4)::INT + 1) AS weight FROM documents GROUP BY source), r AS (SELECT name, 1000 * weight / sum(weight) OVER () AS raw FROM c),
d AS (SELECT name, raw, floor(raw) AS base, 1000 - sum(floor(raw)) OVER () AS drift FROM r) SELECT name, (base + CASE WHEN row_number() OVER (ORDER BY round(raw - base, 9) DESC, name) <= drift THEN 1 ELSE 0 END)::BIGINT AS rows FROM d"""
)
def largest_remainder(spark, sf_dir):
    c = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("name")).count()
    return M.largest_remainder(c.select("name", (F.col("count").cast("double") * (F.substring("name", 4, 9).cast("int") + 1)).alias("weight")), 1000)


@query(
    """WITH n AS (SELECT count(*) AS n FROM documents), q AS (SELECT n, round_even(n * 0.2, 0) AS a, round_even(n * 0.15, 0) AS b, round_even(n * 0.3, 0) AS cap FROM n)
SELECT unnest(['operators', 'grounded', 'open', 'precision']) AS part, unnest([a, b, least(cap, n - a - b), n - a - b - least(cap, n - a - b)])::BIGINT AS rows FROM q"""
)
def composition_quota(spark, sf_dir):
    """Fixed quotas of 20 % and 15 %, an open part of at most 30 %, the rest to precision."""
    n = table(spark, sf_dir, "documents").agg(F.count("*").alias("n"))
    q = n.select("n", F.bround(F.col("n") * 0.2, 0).cast("long").alias("a"), F.bround(F.col("n") * 0.15, 0).cast("long").alias("b"), F.bround(F.col("n") * 0.3, 0).cast("long").alias("cap"))
    left = F.col("n") - F.col("a") - F.col("b")
    parts = {"operators": F.col("a"), "grounded": F.col("b"), "open": F.least("cap", left), "precision": left - F.least("cap", left)}
    return q.select(F.explode(F.array(*[F.struct(F.lit(k).alias("part"), v.alias("rows")) for k, v in parts.items()])).alias("p")).select("p.*")


@query(
    """WITH c AS (SELECT conv_id, count(*) FILTER (role = 'assistant') > 1 AS multi FROM conversations GROUP BY conv_id), n AS (SELECT floor(count(*) * 0.3) AS cap FROM c),
r AS (SELECT conv_id, multi, row_number() OVER (PARTITION BY multi ORDER BY md5('9|' || conv_id), conv_id) - 1 AS rank FROM c) SELECT conv_id, multi FROM r, n WHERE NOT multi OR rank < cap"""
)
def turn_cap(spark, sf_dir):
    """Multi-turn conversations, at most 30 % of all."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "assistant").alias("k"))
    return M.turn_cap(c, "conv_id", F.col("k") > 1, 0.3, 9).select("conv_id", "multi")


@query(f"WITH {_ranked(11)} SELECT doc_id, CASE WHEN rank < floor(n * 0.1) THEN 'val' ELSE 'train' END AS split FROM r")
def episode_split(spark, sf_dir):
    return M.split_by_order(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.1, 11).select("doc_id", "split")


@query(f"WITH t AS (SELECT sum({_TOK}) AS n FROM documents) SELECT n::BIGINT AS tokens, 8 * 512 AS tokens_per_step, round(1000 * 8 * 512 / n, 6)::DOUBLE AS coverage, floor(2.0 * n / 4096)::BIGINT AS least_steps, floor(5.0 * n / 4096)::BIGINT AS most_steps FROM t")
def coverage(spark, sf_dir):
    """How often 1,000 steps of 8 sequences of 512 tokens see the corpus, and the steps that would see it 2 to 5 times."""
    t = table(spark, sf_dir, "documents").agg(F.sum(T.word_count(F.col("text"))).alias("tokens"))
    return t.select("tokens", F.lit(8 * 512).alias("tokens_per_step"), F.round(F.lit(1000 * 8 * 512) / F.col("tokens"), 6).alias("coverage"), F.floor(F.col("tokens") * 2.0 / 4096).alias("least_steps"), F.floor(F.col("tokens") * 5.0 / 4096).alias("most_steps"))


@query(
    f"""WITH b AS (SELECT doc_id, {_TOK} AS n FROM documents), k AS (SELECT doc_id, CASE WHEN n <= 128 THEN 'short' WHEN n >= 1024 THEN 'long' ELSE 'medium' END AS bucket FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id) AS round FROM k)
SELECT doc_id, bucket, row_number() OVER (ORDER BY round, CASE bucket WHEN 'short' THEN 0 WHEN 'long' THEN 1 ELSE 2 END) - 1 AS pos FROM r"""
)
def interleave(spark, sf_dir):
    """Round-robin over short, long and medium documents."""
    n = T.word_count(F.col("text"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(n <= 128, 0).when(n >= 1024, 1).otherwise(2).alias("b"))
    rounds = rank_within(d, ["b"], ["doc_id"], "round")
    out = running_total(rounds.select("doc_id", "b", "round"), ["round", "b"], F.lit(1), "pos")
    return out.select("doc_id", F.when(F.col("b") == 0, "short").when(F.col("b") == 1, "long").otherwise("medium").alias("bucket"), "pos")


@query("SELECT text AS t, 'documents' AS mix_source, lang FROM documents UNION ALL SELECT text, 'conversations', NULL FROM conversations")
def mix_union(spark, sf_dir):
    """Union of two sources by column name; a column that one lacks is null."""
    a = table(spark, sf_dir, "documents").select(F.col("text").alias("t"), F.lit("documents").alias("mix_source"), "lang")
    return a.unionByName(table(spark, sf_dir, "conversations").select(F.col("text").alias("t"), F.lit("conversations").alias("mix_source")), allowMissingColumns=True)


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def new_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").subtract(table(spark, sf_dir, "labels").select("doc_id"))
