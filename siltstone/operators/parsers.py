"""Parsers from dataset layouts to episodes (system, messages of role and content, language, source), and back-ends of
question-answering adapters. A parser is one projection; new layouts are added to PARSERS."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

SYSTEM = "You are a helpful assistant."


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), T.strip(content).alias("content"))


def first_of(*names: str) -> Column:
    """The first column that is not blank."""
    return F.coalesce(*[F.when(T.strip(F.col(n).cast("string")) != "", T.strip(F.col(n).cast("string"))) for n in names])


def episode(messages: Column, source: str, system: Column | None = None) -> list[Column]:
    full = F.filter(messages, lambda m: m["content"] != "")
    return [(system if system is not None else F.lit(SYSTEM)).alias("system"), full.alias("messages"), F.lit(source).alias("source")]


def instruction(df: DataFrame) -> DataFrame:
    """instruction, optional input, output."""
    ask = F.when(F.coalesce(F.col("input"), F.lit("")) != "", F.concat_ws("\n\n", "instruction", "input")).otherwise(F.col("instruction"))
    return df.select(*episode(F.array(message("user", ask), message("assistant", F.col("output"))), "instruction"))


def query_response(df: DataFrame) -> DataFrame:
    return df.select(*episode(F.array(message("user", F.col("query")), message("assistant", F.col("response"))), "query_response"))


def shared(df: DataFrame) -> DataFrame:
    """conversations: array of (from, value), human and gpt in turn, system hoisted."""
    system = F.get(F.filter("conversations", lambda m: m["from"] == "system"), 0)["value"]
    rest = F.filter("conversations", lambda m: m["from"] != "system")
    turns = F.transform(rest, lambda m: F.struct(F.when(m["from"].isin("human", "user"), "user").otherwise("assistant").alias("role"), T.strip(m["value"]).alias("content")))
    return df.select(*episode(turns, "shared", F.coalesce(system, F.lit(SYSTEM))))


def chat(df: DataFrame) -> DataFrame:
    """messages: array of (role, content)."""
    known = F.filter("messages", lambda m: m["role"].isin("user", "assistant"))
    return df.select(*episode(F.transform(known, lambda m: F.struct(m["role"].alias("role"), T.strip(m["content"]).alias("content"))), "chat"))


def context_question(df: DataFrame) -> DataFrame:
    """context, question, answer: kept where the context holds the answer, letter case aside."""
    grounded = F.contains(F.lower("context"), F.lower("answer"))
    ask = F.concat(F.lit("Context:\n"), F.substring("context", 1, 4000), F.lit("\n\nQuestion: "), F.col("question"))
    return df.where(grounded).select(*episode(F.array(message("user", ask), message("assistant", F.col("answer"))), "context_question"))


def xml_calls(text: Column) -> Column:
    """Array of (name, arguments map) of calls like <invoke name="f"><parameter name="a">1</parameter></invoke>."""
    calls = F.regexp_extract_all(text, F.lit(r'(?s)(<invoke name="[^"]+">.*?</invoke>)'), 1)

    def one(c: Column) -> Column:
        pattern = r'(?s)<parameter name="([^"]+)">(.*?)</parameter>'
        return F.struct(F.regexp_extract(c, r'<invoke name="([^"]+)">', 1).alias("name"), F.map_from_arrays(F.regexp_extract_all(c, F.lit(pattern), 1), F.regexp_extract_all(c, F.lit(pattern), 2)).alias("arguments"))

    return F.transform(calls, one)


def squad(df: DataFrame, refusal: str = "The passage does not answer this question.") -> DataFrame:
    """context, question, answers: the first answer or a refusal; one row per passage and question."""
    answer = F.coalesce(F.get("answers", 0), F.lit(refusal))
    rows = df.select(T.clean_passage(F.col("context")).alias("p"), "question", answer.alias("a")).where("p is not null")
    return rows.groupBy("p", "question").agg(F.min("a").alias("a")).select(T.reading_comprehension(F.col("p"), F.col("question"), F.col("a")).alias("text"))


def evidence(df: DataFrame) -> DataFrame:
    """question, answer, evidence (array): one row per evidence text that holds the answer; one per passage."""
    rows = df.select("question", "answer", F.explode("evidence").alias("e")).select("question", "answer", T.clean_passage(F.col("e")).alias("p"))
    rows = rows.where(F.col("p").isNotNull() & F.contains(F.lower("p"), F.lower("answer")) & T.clean_answer(F.col("answer")).isNotNull())
    first = rows.groupBy("p").agg(F.min(F.struct("question", "answer")).alias("x"))
    return first.select(T.reading_comprehension(F.col("p"), F.col("x.question"), F.col("x.answer")).alias("text"))


def bilingual(left: DataFrame, right: DataFrame, languages: tuple[str, str] = ("en", "de")) -> DataFrame:
    """Union of two languages' episodes, each tagged."""
    return left.withColumn("language", F.lit(languages[0])).unionByName(right.withColumn("language", F.lit(languages[1])), allowMissingColumns=True)


def replace_user(episodes: DataFrame, texts: DataFrame, key: str = "conv_id") -> DataFrame:
    """User messages replaced by a map from id to text; others stay."""
    return episodes.join(texts.select(key, F.col("text").alias("__new")), key, "left").withColumn("user_msg", F.coalesce("__new", "user_msg")).drop("__new")


def generate(seeds: DataFrame, seed_col: str, templates: list[tuple[str, str]], per_seed: int, seed: int) -> DataFrame:
    """Episodes from templates of (question, answer) with ``{x}`` filled by each seed: ``per_seed`` templates of a seeded
    order each. Templates are a literal list, so seeds are exploded, not crossed."""
    tpl = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(a).alias("a")) for q, a in templates])
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(len(templates) - 1)), lambda i: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(seed_col).cast("string"), i.cast("string"))).alias("k"), i.alias("i"))))
    picked = seeds.select(seed_col, F.explode(F.slice(order, 1, per_seed)).alias("o"))
    fill = lambda c: F.replace(c, F.lit("{x}"), F.col(seed_col).cast("string"))
    rows = picked.select(seed_col, F.col("o.i").alias("template"), F.get(tpl, F.col("o.i")).alias("t"))
    return rows.select(seed_col, "template", *episode(F.array(message("user", fill(F.col("t.q"))), message("assistant", fill(F.col("t.a")))), "generated"))


PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "instruction": instruction, "query_response": query_response, "shared": shared, "chat": chat, "context_question": context_question, "squad": squad, "evidence": evidence,
}
