"""Statistics of episodes, sources and evaluations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import episodes as E

# First words of questions and imperatives.
QUESTION = ["what", "why", "how", "when", "where", "who", "which", "can", "could", "would", "should", "is", "are", "do", "does"]
IMPERATIVE = ["explain", "describe", "list", "create", "write", "generate", "provide", "give", "show", "tell", "help", "make", "build"]
# Keywords of task types.
TASKS = {
    "explanation": ["explain", "clarify", "what is", "what are", "why", "how does", "understanding"],
    "code_generation": ["code", "function", "implement", "write a", "create a script", "program"],
    "analysis": ["analyze", "compare", "evaluate", "assess", "review"],
    "creative": ["story", "poem", "creative", "imagine", "write about"],
    "formatting": ["format", "list", "bullet", "checklist", "table", "structure"],
    "instruction": ["how to", "steps", "guide", "tutorial", "teach"],
    "summary": ["summarize", "tldr", "brief", "overview", "key points"],
    "advice": ["advice", "suggest", "recommend", "should i", "opinion"],
    "factual": ["fact", "when", "where", "who", "date", "history"],
    "math_logic": ["calculate", "solve", "equation", "logic", "proof", "algorithm"],
}
# Words that are no keywords.
STOPWORDS = """the a an and or but in on at to for of with by from as is was are be been have has had do does did will would should
could may might can i you he she it we they them their this that these those my your me like about just so what how why when where""".split()


def median_by_count(df: DataFrame, value: str) -> DataFrame:
    """One row ``median``: the value at position n // 2. Values are counted first, so what is ordered is the distinct ones."""
    counts = df.groupBy(value).count()
    total = counts.agg(F.sum("count").alias("n"))
    from .ordered import running_total

    ranked = running_total(counts, [value], F.col("count"), "before")
    at = F.floor(F.col("n") / 2)
    return ranked.join(F.broadcast(total)).where((F.col("before") <= at) & (at < F.col("before") + F.col("count"))).select(F.col(value).alias("median"))


def episode_lengths(turns: DataFrame) -> DataFrame:
    """Words of user and assistant messages per conversation."""
    n = T.word_count(F.col("text"))
    per = turns.groupBy("conv_id").agg(F.sum(F.when(F.col("role") == "user", n).otherwise(0)).alias("user"), F.sum(F.when(F.col("role") == "assistant", n).otherwise(0)).alias("assistant"))
    return per.withColumn("total", F.col("user") + F.col("assistant"))


def instruction_type(message: Column) -> Column:
    m = T.strip(F.lower(message))
    starts = F.lit(False)
    for w in IMPERATIVE:
        starts = starts | m.startswith(w)
    return F.when(F.contains(m, F.lit("?")), "question").when(starts, "imperative").when(F.get(T.words(m), 0).isin(*QUESTION), "question").otherwise("other")


def task_labels(message: Column) -> Column:
    m = F.lower(message)
    labels = []
    for name, keys in TASKS.items():
        hit = F.lit(False)
        for k in keys:
            hit = hit | F.contains(m, F.lit(k))
        labels.append(F.when(hit, F.lit(name)))
    return F.filter(F.array(*labels), lambda x: x.isNotNull())


def role_words(turns: DataFrame) -> DataFrame:
    """(role, word) for every run of a-z in user and assistant messages."""
    hits = F.regexp_extract_all(F.lower("text"), F.lit(r"\b([a-z]+)\b"), 1)
    return turns.where(F.col("role").isin("user", "assistant")).select("role", F.explode(hits).alias("word"))


def audit(turns: DataFrame, group: Column) -> DataFrame:
    """Counters and rates of episode features, for all and per group, in one pass by grouping sets."""
    flags = ["schema_ok", "checkable", "conflict", "abstain", "strict_fmt", "anti_echo", "operators"]
    f = E.features(turns).withColumn("source", group)
    sums = [F.count("*").alias("episodes"), F.sum("assistant_turns").alias("assistant_turns"), *[F.count_if(c).alias(c) for c in flags]]
    out = f.rollup("source").agg(F.grouping("source").alias("g"), *sums)
    rates = [F.round(F.col(c) * 100.0 / F.greatest("episodes", F.lit(1)), 2).alias(f"{c}_rate") for c in flags]
    return out.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("source")).alias("source"), "episodes", "assistant_turns", *flags, *rates)


def pass_rates(results: DataFrame, bucket: str, ok: str) -> DataFrame:
    """passed, failed, total and pass rate per bucket and over all."""
    out = results.rollup(bucket).agg(F.grouping(bucket).alias("g"), F.count_if(ok).alias("passed"), F.count("*").alias("total"))
    return out.select(F.when(F.col("g") == 1, "OVERALL").otherwise(F.col(bucket)).alias("bucket"), "passed", (F.col("total") - F.col("passed")).alias("failed"), "total", F.round(F.col("passed") * 100.0 / F.col("total"), 2).alias("pass_rate"))


def first_k(df: DataFrame, group: str, order: str, k: int) -> DataFrame:
    """The first k rows of each group. Only ranks up to k leave a task, so a hot group is cut before it is shuffled."""
    from pyspark.sql import Window as W

    rank = F.row_number().over(W.partitionBy(group).orderBy(order))
    return df.withColumn("__r", rank).where(F.col("__r") <= k).drop("__r")


def overlap_gate(items: DataFrame, response: str, keywords: str, tags: str) -> DataFrame:
    """Passed where any keyword and all tags of an item occur in its response; both columns are arrays."""
    low = F.lower(response)
    any_key = F.exists(keywords, lambda k: F.contains(low, F.lower(k)))
    return items.withColumn("passed", any_key & F.forall(tags, lambda t: F.contains(low, F.lower(t))))
