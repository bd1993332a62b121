"""Queries of episode, source and evaluation statistics."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import episodes as E
from ..operators import stats as S
from ..registry import query, table
from .text import _sql_strip, _sql_words

_FEATURES = rf"""f AS (SELECT conv_id, count(*) FILTER (role = 'user') AS user_turns, count(*) FILTER (role = 'assistant') AS assistant_turns,
 coalesce(bool_or(role = 'system' AND regexp_matches(text, '\S')), false) AS has_system, bool_and(role IN ('user', 'assistant', 'assistant_context', 'system')) AS roles_ok,
 coalesce(bool_or(role = 'user' AND regexp_matches(text, '{E.CHECKABLE}')), false) AS checkable, coalesce(bool_or(role = 'user' AND regexp_matches(text, '{E.CONFLICT}')), false) AS conflict,
 coalesce(bool_or(role = 'assistant' AND regexp_matches(text, '{E.ABSTAIN.replace("'", "''")}')), false) AS abstain, coalesce(bool_or(role = 'user' AND regexp_matches(text, '{E.STRICT}')), false) AS strict_fmt,
 bool_or(role = 'user' AND regexp_matches(text, '".+?"') AND regexp_matches(text, '(?i)\b(what|mean|real word)\b')) AS anti_echo,
 bool_or(role = 'assistant' AND regexp_matches({_sql_strip('text')}, '^\[.*\]$|^<.*>$|^''.*''$|^".*"$')) AS operators FROM conversations GROUP BY conv_id),
e AS (SELECT conv_id, has_system AND roles_ok AND user_turns > 0 AND assistant_turns > 0 AS schema_ok, user_turns, assistant_turns,
 CASE WHEN assistant_turns <= 1 THEN '2turn_or_less' WHEN assistant_turns <= 2 THEN '3to4_turn_dialogue' ELSE '5plus_turn_dialogue' END AS turn_class, checkable, conflict, abstain, strict_fmt, anti_echo, operators FROM f)"""
_FLAGS = ["schema_ok", "checkable", "conflict", "abstain", "strict_fmt", "anti_echo", "operators"]


@query(f"WITH {_FEATURES} SELECT * FROM e")
def episode_features(spark, sf_dir):
    return E.features(table(spark, sf_dir, "conversations"))


@query(
    f"""WITH {_FEATURES}, s AS (SELECT *, 'part' || (conv_id % 4) AS source FROM e)
SELECT coalesce(source, 'ALL') AS source, count(*) AS episodes, sum(assistant_turns)::BIGINT AS assistant_turns, {', '.join(f'count(*) FILTER ({c}) AS {c}, round(count(*) FILTER ({c}) * 100.0 / count(*), 2)::DOUBLE AS {c}_rate' for c in _FLAGS)}
FROM s GROUP BY GROUPING SETS ((source), ())"""
)
def episode_audit(spark, sf_dir):
    return S.audit(table(spark, sf_dir, "conversations"), F.concat(F.lit("part"), F.col("conv_id") % 4))


@query(
    r"""WITH p AS (SELECT conv_id, count(*) FILTER (role = 'user') AS u, count(*) FILTER (role = 'assistant') AS a, count(*) FILTER (role NOT IN ('system', 'user', 'assistant', 'assistant_context') OR role IS NULL) AS r,
 count(*) FILTER (NOT regexp_matches(coalesce(text, ''), '\S')) AS e, arg_max(role, turn) AS l, arg_min(role, turn) AS h FROM conversations GROUP BY conv_id),
i AS (SELECT unnest(list_filter([CASE WHEN u = 0 THEN 'no_user' END, CASE WHEN a = 0 THEN 'no_assistant' END, CASE WHEN r > 0 THEN 'bad_role' END, CASE WHEN e > 0 THEN 'empty_content' END,
 CASE WHEN l <> 'assistant' THEN 'last_not_assistant' END, CASE WHEN h = 'assistant' THEN 'starts_with_assistant' END], lambda x: x IS NOT NULL)) AS issue FROM p)
SELECT issue, count(*) AS n FROM i GROUP BY issue"""
)
def schema_validation(spark, sf_dir):
    return E.schema_issues(table(spark, sf_dir, "conversations")).groupBy("issue").agg(F.count("*").alias("n"))


_LENGTHS = rf"""n AS (SELECT conv_id, sum(CASE WHEN role = 'user' THEN len({_sql_words('text')}) ELSE 0 END)::BIGINT AS u, sum(CASE WHEN role = 'assistant' THEN len({_sql_words('text')}) ELSE 0 END)::BIGINT AS a FROM conversations GROUP BY conv_id),
x AS (SELECT 'user' AS what, u AS v FROM n UNION ALL SELECT 'assistant', a FROM n UNION ALL SELECT 'total', u + a FROM n)"""


@query(f"WITH {_LENGTHS} SELECT what, min(v) AS least, max(v) AS most, round(avg(v), 4) AS mean, list_sort(list(v))[count(*) // 2 + 1] AS median FROM x GROUP BY what")
def length_stats(spark, sf_dir):
    lengths = S.episode_lengths(table(spark, sf_dir, "conversations"))
    parts = []
    for c in ("user", "assistant", "total"):
        base = lengths.agg(F.min(c).alias("least"), F.max(c).alias("most"), F.round(F.avg(c), 4).alias("mean"))
        parts.append(base.join(F.broadcast(S.median_by_count(lengths.select(c), c))).select(F.lit(c).alias("what"), "least", "most", "mean", "median"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    rf"""WITH u AS (SELECT {_sql_strip('lower(arg_min(text, turn))')} AS m FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT CASE WHEN contains(m, '?') THEN 'question' WHEN {' OR '.join(f"starts_with(m, '{w}')" for w in S.IMPERATIVE)} THEN 'imperative' WHEN ({_sql_words('m')})[1] IN {tuple(S.QUESTION)} THEN 'question' ELSE 'other' END AS kind, count(*) AS n FROM u GROUP BY 1"""
)
def instruction_types(spark, sf_dir):
    return E.first_user(table(spark, sf_dir, "conversations")).groupBy(S.instruction_type(F.col("user_msg")).alias("kind")).agg(F.count("*").alias("n"))


_TASKS = "[" + ", ".join(f"CASE WHEN {' OR '.join(f'contains(m, {k!r})' for k in keys)} THEN '{name}' END" for name, keys in S.TASKS.items()) + "]"


@query(
    f"""WITH u AS (SELECT lower(arg_max(text, turn)) AS m FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT task, count(*) AS n FROM (SELECT unnest({_TASKS}) AS task FROM u) WHERE task IS NOT NULL GROUP BY task"""
)
def task_types(spark, sf_dir):
    """Task labels of each conversation's last user message; one message may have several."""
    last = table(spark, sf_dir, "conversations").where("role = 'user'").groupBy("conv_id").agg(F.max_by("text", "turn").alias("m"))
    return last.select(F.explode(S.task_labels(F.col("m"))).alias("task")).groupBy("task").agg(F.count("*").alias("n"))


# RE2's word boundary knows ASCII only, so the oracle splits at what is no word character and keeps pure a-z words
_WORDS = r"(SELECT role, word FROM (SELECT role, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM conversations WHERE role IN ('user', 'assistant')) WHERE regexp_full_match(word, '[a-z]+'))"


@query(f"SELECT role, count(*) AS words, count(DISTINCT word) AS vocabulary, round(count(DISTINCT word) / count(*), 6) AS ttr FROM {_WORDS} GROUP BY role")
def vocab_ttr(spark, sf_dir):
    counts = S.role_words(table(spark, sf_dir, "conversations")).groupBy("role", "word").count()
    out = counts.groupBy("role").agg(F.sum("count").alias("words"), F.count("*").alias("vocabulary"))
    return out.select("role", "words", "vocabulary", F.round(F.col("vocabulary") / F.col("words"), 6).alias("ttr"))


@query(f"SELECT word, count(*) AS n FROM {_WORDS} WHERE role = 'user' AND length(word) > 3 AND word NOT IN {tuple(S.STOPWORDS)} GROUP BY word ORDER BY n DESC, word LIMIT 30")
def top_keywords(spark, sf_dir):
    words = S.role_words(table(spark, sf_dir, "conversations")).where((F.col("role") == "user") & (F.length("word") > 3) & ~F.col("word").isin(*S.STOPWORDS))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(30)


_LADDER = """SELECT (CASE WHEN episodes >= 200 THEN 20 WHEN episodes >= 150 THEN 15 ELSE 10 END + CASE WHEN tasks >= 5 THEN 20 WHEN tasks >= 3 THEN 15 ELSE 10 END
 + CASE WHEN ttr >= 0.15 THEN 15 WHEN ttr >= 0.10 THEN 10 ELSE 5 END + CASE WHEN mean BETWEEN 100 AND 400 THEN 15 WHEN mean BETWEEN 50 AND 500 THEN 10 ELSE 5 END
 + CASE WHEN questions * 100.0 / episodes BETWEEN 30 AND 70 AND imperatives * 100.0 / episodes BETWEEN 20 AND 60 THEN 15 ELSE 10 END
 + CASE WHEN multi * 100.0 / episodes BETWEEN 10 AND 40 THEN 15 ELSE 10 END) AS score"""


@query(
    rf"""WITH {_LENGTHS}, u AS (SELECT conv_id, {_sql_strip('lower(arg_min(text, turn))')} AS m, lower(arg_max(text, turn)) AS l FROM conversations WHERE role = 'user' GROUP BY conv_id),
k AS (SELECT CASE WHEN contains(m, '?') THEN 'question' WHEN {' OR '.join(f"starts_with(m, '{w}')" for w in S.IMPERATIVE)} THEN 'imperative' WHEN ({_sql_words('m')})[1] IN {tuple(S.QUESTION)} THEN 'question' ELSE 'other' END AS kind FROM u),
t AS (SELECT task, count(*) AS n FROM (SELECT unnest({_TASKS.replace('(m,', '(l,')}) AS task FROM u) WHERE task IS NOT NULL GROUP BY task),
c AS (SELECT conv_id, count(*) FILTER (role IN ('user', 'assistant')) AS k FROM conversations GROUP BY conv_id),
s AS (SELECT (SELECT count(*) FROM c) AS episodes, (SELECT count(*) FROM t WHERE n / (SELECT count(*) FROM c) >= 0.1) AS tasks, (SELECT count(DISTINCT word) / count(*) FROM {_WORDS} WHERE role = 'user') AS ttr,
 (SELECT avg(v) FROM x WHERE what = 'total') AS mean, (SELECT count(*) FROM k WHERE kind = 'question') AS questions, (SELECT count(*) FROM k WHERE kind = 'imperative') AS imperatives, (SELECT count(*) FROM c WHERE k > 2) AS multi)
SELECT score::DOUBLE AS score FROM ({_LADDER} FROM s)"""
)
def diversity_score(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    per = turns.groupBy("conv_id").agg(F.count_if(F.col("role").isin("user", "assistant")).alias("k"))
    base = per.agg(F.count("*").alias("episodes"), F.count_if(F.col("k") > 2).alias("multi"))
    kinds = instruction_types(spark, sf_dir).agg(F.sum(F.when(F.col("kind") == "question", F.col("n"))).alias("questions"), F.sum(F.when(F.col("kind") == "imperative", F.col("n"))).alias("imperatives")).fillna(0)
    mean = S.episode_lengths(turns).agg(F.avg("total").alias("mean"))
    ttr = vocab_ttr(spark, sf_dir).where("role = 'user'").agg(F.first(F.col("vocabulary") / F.col("words")).alias("ttr"))
    tasks = task_types(spark, sf_dir).join(F.broadcast(base)).agg(F.count_if(F.col("n") / F.col("episodes") >= 0.1).alias("tasks"))
    one = base.join(kinds).join(mean).join(ttr).join(tasks)  # one-row tables
    return one.selectExpr("cast(" + " ".join(_LADDER[len("SELECT "):].rsplit(" AS score", 1)[0].split()) + " as double) AS score")


@query(
    """WITH c AS (SELECT conv_id, 'lang' || conv_id % 3 AS language, 'cat' || conv_id % 5 AS category, count(*) FILTER (role <> 'system') AS n FROM conversations GROUP BY conv_id),
s AS (SELECT language, category, CASE WHEN n <= 2 THEN 'short' WHEN n <= 5 THEN 'medium' ELSE 'long' END AS length FROM c)
SELECT CASE WHEN language IS NOT NULL THEN 'language' WHEN category IS NOT NULL THEN 'category' ELSE 'length' END AS what, coalesce(language, category, length) AS value, count(*) AS n FROM s GROUP BY GROUPING SETS ((language), (category), (length))"""
)
def composition(spark, sf_dir):
    """Counts by language, category and length class in one pass. Conversations have neither language nor category; both are derived from the id."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") != "system").alias("n"))
    s = c.select(F.concat(F.lit("lang"), F.col("conv_id") % 3).alias("language"), F.concat(F.lit("cat"), F.col("conv_id") % 5).alias("category"), F.when(F.col("n") <= 2, "short").when(F.col("n") <= 5, "medium").otherwise("long").alias("length"))
    out = s.groupingSets([["language"], ["category"], ["length"]], "language", "category", "length").agg(F.count("*").alias("n"))
    return out.select(F.when(F.col("language").isNotNull(), "language").when(F.col("category").isNotNull(), "category").otherwise("length").alias("what"), F.coalesce("language", "category", "length").alias("value"), "n")


@query(f"SELECT source, sum(len({_sql_words('text')}))::BIGINT AS tokens, count(*) AS docs FROM documents GROUP BY source")
def token_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(T.word_count(F.col("text"))).alias("tokens"), F.count("*").alias("docs"))


_RESULTS = "(SELECT d.lang AS bucket, l.quality = 1 AND l.toxic = 0 AS ok FROM labels l JOIN documents d USING (doc_id))"


def _results(spark, sf_dir):
    """An evaluation stand-in: labelled documents by language, passed if good and not toxic."""
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id").withColumn("ok", F.expr("quality = 1 and toxic = 0"))


@query(f"SELECT coalesce(bucket, 'OVERALL') AS bucket, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed, count(*) AS total, round(count(*) FILTER (ok) * 100.0 / count(*), 2)::DOUBLE AS pass_rate FROM {_RESULTS} GROUP BY GROUPING SETS ((bucket), ())")
def eval_summary(spark, sf_dir):
    return S.pass_rates(_results(spark, sf_dir), "lang", "ok")


@query("SELECT d.source AS operator, least(d.n_chars // 1000, 5)::BIGINT AS size, count(*) AS total, round(avg((l.quality = 1 AND l.toxic = 0)::INT), 6) AS accuracy FROM labels l JOIN documents d USING (doc_id) GROUP BY 1, 2")
def operator_accuracy(spark, sf_dir):
    size = F.least(F.floor(F.col("n_chars") / 1000), F.lit(5)).alias("size")
    return _results(spark, sf_dir).groupBy(F.col("source").alias("operator"), size).agg(F.count("*").alias("total"), F.round(F.avg(F.col("ok").cast("int")), 6).alias("accuracy"))


@query(
    f"""WITH r AS (SELECT bucket, count(*) FILTER (ok) * 100.0 / count(*) AS rate, count(*) AS n FROM {_RESULTS} GROUP BY bucket),
q AS (SELECT * FROM (VALUES ('en', 70.0), ('fr', 95.0), ('de', 50.0), ('it', 10.0)) AS t(bucket, least))
SELECT q.bucket, q.least::DOUBLE AS least, round(coalesce(rate, 0), 2)::DOUBLE AS rate, CASE WHEN r.bucket IS NULL THEN 'MISSING' WHEN rate >= least THEN 'PASS' ELSE 'FAIL' END AS status FROM q LEFT JOIN r ON q.bucket = r.bucket"""
)
def regression_gate(spark, sf_dir):
    """Required pass rates against measured ones; a bucket that wasn't measured is missing."""
    rates = S.pass_rates(_results(spark, sf_dir), "lang", "ok").select("bucket", (F.col("passed") * 100.0 / F.col("total")).alias("rate"))
    need = spark.createDataFrame([("en", 70.0), ("fr", 95.0), ("de", 50.0), ("it", 10.0)], "bucket string, least double")
    status = F.when(F.col("rate").isNull(), "MISSING").when(F.col("rate") >= F.col("least"), "PASS").otherwise("FAIL")
    return need.join(rates, "bucket", "left").select("bucket", "least", F.round(F.coalesce("rate", F.lit(0.0)), 2).alias("rate"), status.alias("status"))


@query(
    f"""WITH r AS (SELECT bucket, count(*) FILTER (ok) * 100.0 / count(*) AS rate FROM {_RESULTS} GROUP BY bucket)
SELECT round(avg(rate), 4)::DOUBLE AS mean_rate, bool_and(rate >= CASE WHEN bucket = 'en' THEN 70 ELSE 60 END) AS passed FROM r"""
)
def bridge_gate(spark, sf_dir):
    """Passes if every hard bucket reaches its rate; also the mean rate."""
    rates = S.pass_rates(_results(spark, sf_dir), "lang", "ok").where("bucket <> 'OVERALL'").select("bucket", (F.col("passed") * 100.0 / F.col("total")).alias("rate"))
    return rates.agg(F.round(F.avg("rate"), 4).alias("mean_rate"), F.bool_and(F.col("rate") >= F.when(F.col("bucket") == "en", 70).otherwise(60)).alias("passed"))


@query(
    f"""WITH t AS (SELECT source, sum(len({_sql_words('text')})) AS n FROM documents GROUP BY source) SELECT source AS origin, n::BIGINT AS effective_rows, round(n * 100.0 / sum(n) OVER (), 6)::DOUBLE AS effective_percent FROM t"""
)
def lineage_percent(spark, sf_dir):
    t = token_counts(spark, sf_dir)
    total = W.partitionBy(F.lit(1))
    return t.select(F.col("source").alias("origin"), F.col("tokens").alias("effective_rows"), F.round(F.col("tokens") * 100.0 / F.sum("tokens").over(total), 6).alias("effective_percent"))


@query(f"WITH n AS (SELECT len({_sql_words('text')}) AS n FROM documents) SELECT CASE WHEN n < 64 THEN '0-63' WHEN n < 256 THEN '64-255' WHEN n < 1024 THEN '256-1023' WHEN n < 4096 THEN '1024-4095' ELSE '4096+' END AS bucket, count(*) AS docs FROM n GROUP BY 1")
def length_histogram(spark, sf_dir):
    n = T.word_count(F.col("text"))
    bucket = F.when(n < 64, "0-63").when(n < 256, "64-255").when(n < 1024, "256-1023").when(n < 4096, "1024-4095").otherwise("4096+")
    return table(spark, sf_dir, "documents").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("docs"))


@query("SELECT count(*) FILTER (l_returnflag = 'N') AS masked, count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS correct, round(count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') / nullif(count(*) FILTER (l_returnflag = 'N'), 0), 6) AS accuracy FROM lineitem")
def masked_accuracy(spark, sf_dir):
    """Accuracy where the mask is set; line items stand in for tokens."""
    t = table(spark, sf_dir, "lineitem").select((F.col("l_returnflag") == "N").alias("mask"), (F.col("l_linestatus") == "O").alias("ok"))
    out = t.agg(F.count_if("mask").alias("masked"), F.count_if(F.col("mask") & F.col("ok")).alias("correct"))
    return out.select("masked", "correct", F.round(F.col("correct") / F.nullif("masked", F.lit(0)), 6).alias("accuracy"))


@query("SELECT count(DISTINCT left(lower(text), 20)) AS variants, count(*) AS responses, count(DISTINCT left(lower(text), 20)) * 10 < count(*) AS collapsed FROM conversations WHERE role = 'assistant'")
def mode_collapse(spark, sf_dir):
    a = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    out = a.agg(F.count_distinct(F.substring(F.lower("text"), 1, 20)).alias("variants"), F.count("*").alias("responses"))
    return out.withColumn("collapsed", F.col("variants") * 10 < F.col("responses"))


@query()
def rag_field_stats(spark, sf_dir):
    """Message counters over all and per source. A message's context is its bracketed part, its citation its quoted part."""
    turns = table(spark, sf_dir, "conversations").withColumn("source", F.concat(F.lit("part"), F.col("conv_id") % 4))
    turns = turns.withColumn("cited", F.col("text").contains('"')).withColumn("context", (F.col("role") == "user") & F.col("text").contains(":"))
    replies = E.next_assistant(turns).join(turns.select("conv_id", F.col("turn").alias("reply_turn"), F.col("cited").alias("reply_cited")), ["conv_id", "reply_turn"], "left").select("conv_id", "turn", "reply_turn", "reply_cited")
    t = turns.join(replies, ["conv_id", "turn"], "left")
    sums = [F.count("*").alias("messages"), F.count_if(F.col("role") == "user").alias("user"), F.count_if(F.col("role") == "assistant").alias("assistant"), F.count_if("context").alias("with_context"), F.count_if(F.col("context") & F.col("reply_turn").isNotNull()).alias("context_turns"), F.count_if(F.col("context") & F.col("reply_cited")).alias("context_with_cite")]
    return t.rollup("source").agg(*sums).select(F.coalesce("source", F.lit("ALL")).alias("source"), *[c.split("#")[0] for c in ("messages", "user", "assistant", "with_context", "context_turns", "context_with_cite")])
