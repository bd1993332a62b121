"""Chat episodes: from turns to episodes, payloads and templates, validation, features, serialisation and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def first_user(turns: DataFrame) -> DataFrame:
    """conv_id and its first user message; conversations without one have no row."""
    return turns.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("user_msg"))


def episodes(turns: DataFrame) -> DataFrame:
    """One row per conversation: messages in order, the system text hoisted out of them."""
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("all"))
    system = F.get(F.filter("all", lambda m: m["role"] == "system"), 0)["text"]
    return rows.select("conv_id", F.coalesce(system, F.lit("")).alias("system"), F.filter("all", lambda m: m["role"] != "system").alias("messages"))


def payload(message: Column) -> Column:
    """Quoted text, else what follows the first colon of the last line."""
    quoted = F.regexp_extract(message, '"([^"]+)"', 1)
    after = F.regexp_extract(message, r"(?d):\s*(.+)\z", 1)
    return F.when(quoted != "", quoted).when(after != "", T.strip(after))


def template(message: Column, found: Column) -> Column:
    quoted = F.concat(F.lit('"'), found, F.lit('"'))
    sig = F.replace(F.replace(message, quoted, F.lit('"{PAYLOAD}"')), found, F.lit("{PAYLOAD}"))
    use = F.when(found.isNotNull() & (found != "") & F.contains(message, found), sig).otherwise(message)
    return T.strip(F.regexp_replace(use, r"(?U)\s+", " "))


def signatures(turns: DataFrame, operator: Column) -> DataFrame:
    """conv_id, payload, template and operator::payload pair of each conversation's first user message."""
    rows = first_user(turns).withColumn("payload", payload(F.col("user_msg")))
    pair = F.when((F.col("payload") != "") & (F.upper(operator) != ""), F.concat_ws("::", F.upper(operator), F.col("payload")))
    return rows.select("conv_id", "payload", template(F.col("user_msg"), F.col("payload")).alias("template"), pair.alias("pair"))


def blocked_by(candidates: DataFrame, train: DataFrame, keys: tuple[str, ...] = ("payload", "template", "pair")) -> DataFrame:
    """The first key on which a candidate overlaps the training set, or null. Each key is one semi-join flag."""
    out = candidates
    for k in keys:
        seen = train.where(F.col(k).isNotNull() & (F.col(k) != "")).select(F.col(k).alias(f"t_{k}")).distinct().withColumn(f"hit_{k}", F.lit(True))
        out = out.join(seen, F.col(k) == F.col(f"t_{k}"), "left").drop(f"t_{k}")
    reason = F.lit(None).cast("string")
    for k in reversed(keys):
        reason = F.when(F.coalesce(F.col(f"hit_{k}"), F.lit(False)), k).otherwise(reason)
    return out.withColumn("blocked_by", reason).drop(*[f"hit_{k}" for k in keys])


def episode_signature(turns: DataFrame) -> DataFrame:
    """conv_id and the MD5 of its user and assistant messages, role:content joined by ||."""
    rows = turns.where(F.col("role").isin("user", "assistant")).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(":", "role", "text").alias("s")))).alias("m"))
    return rows.select("conv_id", F.md5(F.array_join(F.transform("m", lambda x: x["s"]), "||")).alias("signature"))


def next_assistant(turns: DataFrame) -> DataFrame:
    """For each user turn the next assistant turn of its conversation."""
    after = W.partitionBy("conv_id").orderBy("turn").rowsBetween(1, W.unboundedFollowing)
    reply = F.first(F.when(F.col("role") == "assistant", F.col("turn")), ignorenulls=True).over(after)
    return turns.select("conv_id", "turn", "role", reply.alias("reply_turn")).where("role = 'user'").drop("role")


# Patterns of the episode audit.
CHECKABLE = r"(?i)\b(exactly|only|return|list|json|yes or no|true or false|how many|capital|calculate|compute)\b"
ABSTAIN = r"(?i)(i don't know|i do not know|not enough information|insufficient|cannot determine|can't determine|unclear)"
CONFLICT = r"(?i)(conflict|contradict|disagree|inconsistent)"
STRICT = r"(?i)(no markdown|no quotes|no punctuation|only output|return only|output only|json only)"


def features(turns: DataFrame) -> DataFrame:
    """Feature flags of each conversation, by aggregates alone."""
    user, bot = F.col("role") == "user", F.col("role") == "assistant"
    has = lambda who, p: F.coalesce(F.bool_or(who & F.col("text").rlike(p)), F.lit(False))
    anti = user & F.col("text").rlike(r'(?d)".+?"') & F.col("text").rlike(r"(?i)\b(what|mean|real word)\b")
    wrapped = bot & T.strip(F.col("text")).rlike(r"""(?d)^\[.*\]$|^<.*>$|^'.*'$|^".*"$""")
    out = turns.groupBy("conv_id").agg(
        F.count_if(user).alias("user_turns"), F.count_if(bot).alias("assistant_turns"),
        F.coalesce(F.bool_or((F.col("role") == "system") & (T.strip(F.col("text")) != "")), F.lit(False)).alias("has_system"),
        F.bool_and(F.col("role").isin("user", "assistant", "assistant_context", "system")).alias("roles_ok"),
        has(user, CHECKABLE).alias("checkable"), has(user, CONFLICT).alias("conflict"), has(bot, ABSTAIN).alias("abstain"), has(user, STRICT).alias("strict_fmt"),
        F.bool_or(anti).alias("anti_echo"), F.bool_or(wrapped).alias("operators"),
    )
    depth = F.when(F.col("assistant_turns") <= 1, "2turn_or_less").when(F.col("assistant_turns") <= 2, "3to4_turn_dialogue").otherwise("5plus_turn_dialogue")
    ok = F.col("has_system") & F.col("roles_ok") & (F.col("user_turns") > 0) & (F.col("assistant_turns") > 0)
    return out.select("conv_id", ok.alias("schema_ok"), "user_turns", "assistant_turns", depth.alias("turn_class"), "checkable", "conflict", "abstain", "strict_fmt", "anti_echo", "operators")


def schema_issues(turns: DataFrame) -> DataFrame:
    """(conv_id, issue) for every structural issue of a conversation."""
    per = turns.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("role") == "user").alias("users"), F.count_if(F.col("role") == "assistant").alias("bots"),
        F.count_if(~F.col("role").isin("system", "user", "assistant", "assistant_context") | F.col("role").isNull()).alias("bad_role"),
        F.count_if(T.strip(F.coalesce("text", F.lit(""))) == "").alias("empty"), F.max_by("role", "turn").alias("last"), F.min_by("role", "turn").alias("lead"),
    )
    issues = F.array(
        F.when(F.col("users") == 0, "no_user"), F.when(F.col("bots") == 0, "no_assistant"), F.when(F.col("bad_role") > 0, "bad_role"),
        F.when(F.col("empty") > 0, "empty_content"), F.when(F.col("last") != "assistant", "last_not_assistant"), F.when(F.col("lead") == "assistant", "starts_with_assistant"),
    )
    return per.select("conv_id", F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("issue"))
