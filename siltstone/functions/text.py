"""Column functions for text: normalisation, cleaning, filters. All stay in the JVM except where noted.

White space follows Unicode where the pattern says ``(?U)``; ``(?d)`` makes only ``\\n`` a line end. A null text stays null.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Navigation, legal and social boilerplate, applied in this order.
BOILERPLATE = [
    r"Edit this page on GitHub.*",
    r"Edit on GitHub.*",
    r"View on GitHub.*",
    r"Previous\s*[|/]\s*Next",
    r"← Previous.*",
    r"Next →.*",
    r"Table of Contents",
    r"Skip to (main )?content.*",
    r"Skip to navigation.*",
    r"© \d{4}.*",
    r"Copyright \d{4}.*",
    r"All rights reserved.*",
    r"Terms of Service.*",
    r"Privacy Policy.*",
    r"Cookie.*preferences.*",
    r"Subscribe to.*newsletter.*",
    r"Follow us on.*",
    r"Share this.*",
    r"Was this page helpful.*",
    r"Report a bug.*",
    r"Feedback.*",
    r"Last updated:.*",
    r"Last modified:.*",
]
# Page headers and dotted lines of standards documents.
RFC_LINES = [
    r"^[A-Z][a-z]+(?:\s+&\s+[A-Z][a-z]+)?(?:\s+[A-Z][a-z]+)?\s+(?:Standards Track|Informational|Best Current Practice|Experimental|Historic)\s+\[Page \d+\]$",
    r"^RFC \d+\s+.*?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4}$",
    r"\x0c",
    r"\.{5,}\d+$",
]
# Typographic characters and what replaces them.
TYPOGRAPHY = [
    (" ", " "), ("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'),
    ("–", "-"), ("—", "--"), ("…", "..."), ("­", ""),
]
# Licence headers, tried in this order at the start of a file.
LICENSE_HEADERS = [
    r"(?d)\A#!.*\n",
    r"(?d)\A# -\*-.*-\*-\s*\n",
    r"(?di)\A/\*[\s\S]*?Copyright[\s\S]*?\*/\s*\n?",
    r"(?di)\A#\s*Copyright.*\n(#.*\n)*",
    r"(?di)\A//\s*Copyright.*\n(//.*\n)*",
    r"(?di)\A\"\"\"[\s\S]*?Copyright[\s\S]*?\"\"\"\s*\n?",
]
# Marks of generated files.
GENERATED = [
    r"(?dm)^// Code generated .* DO NOT EDIT",
    r"(?dmi)^# This file is auto-generated",
    r"(?dmi)^# Generated by",
    r"(?dm)^\s*\"[A-Za-z0-9+/=]{100,}\"",
]
# Lines of web pages that are no content.
WEB_LINES = [
    r"^Accept\s+(?:all\s+)?cookies?.*$",
    r"^We use cookies.*$",
    r"^Cookie\s+(?:policy|settings|preferences).*$",
    r"^Skip to (?:main )?content.*$",
    r"^(?:Share|Tweet|Pin|Email)\s*(?:on\s+\w+)?\s*$",
    r"^(?:Previous|Next)\s+(?:post|article).*$",
]
# Frequent German words.
GERMAN = ["und", "der", "die", "das", "ist", "ein", "eine", "nicht", "mit", "sich", "auf", "für", "werden", "kann", "sind", "haben", "auch", "oder", "aber", "nach", "wie", "über"]


def bind(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of an expression that is then computed once, however often ``f`` uses it."""
    return F.transform(F.array(c), f)[0]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c)).cast("long")


def without(c: Column, patterns: list[str], flags: str) -> Column:
    for p in patterns:
        c = F.regexp_replace(c, f"(?{flags}){p}", "")
    return c


def without_lines(c: Column, patterns: list[str]) -> Column:
    """As ``without`` for patterns that start with plain words, letter case aside: a pattern is only run on texts that hold
    its words, which a plain search finds much faster than a regular expression fails."""

    def step(p: str):
        words_ = re.match(r"[\w©←→ ]+", p)[0].lower()
        return lambda x: F.when(F.contains(F.lower(F.upper(x)), F.lit(words_)), F.regexp_replace(x, f"(?dmiu){p}", "")).otherwise(x)

    for p in patterns:
        c = bind(c, step(p))
    return c


def normalize(c: Column) -> Column:
    """Lower case, white space to single spaces, trimmed."""
    return strip(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def strip_front_matter(c: Column) -> Column:
    """Drops a leading block between lines of three dashes."""
    return F.when(c.startswith("---"), F.regexp_replace(c, r"(?d)\A---.*\n(?:(?!\s*---\s*(?:\n|\z)).*\n)*?[ \t]*---[ \t]*(?:\n\s*|\z)", "")).otherwise(c)


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Unicode normalisation form C; the JVM has no built-in for it."""
    return texts.str.normalize("NFC")


def plain_typography(c: Column) -> Column:
    for old, new in TYPOGRAPHY:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_controls(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", "")


def indent_lines(c: Column, most: int = 8) -> Column:
    """Single spaces within lines; lines that start with two blanks or a tab keep up to ``most`` of indentation."""

    def one(line: Column) -> Column:
        joined = F.array_join(words(line), " ")
        indent = F.length(line) - F.length(F.regexp_replace(line, r"(?U)\A\s+", ""))
        inner = line.startswith("  ") | line.startswith("\t")
        return F.when(inner & (joined != ""), F.concat(F.repeat(F.lit(" "), F.least(indent, F.lit(most))), joined)).otherwise(joined)

    return F.array_join(F.transform(F.split(c, "\n"), one), "\n")


def collapse_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{4,}", "\n\n\n")


def clean(c: Column, min_chars: int = 400, normal_form: bool = True) -> Column:
    """Full cleaning of a corpus document; null where fewer than ``min_chars`` remain."""
    c = without_lines(without(strip_front_matter(c), RFC_LINES, "dm"), BOILERPLATE)
    c = plain_typography(nfc(c) if normal_form else c)
    c = strip(collapse_blank_lines(indent_lines(strip_controls(c))))
    return bind(c, lambda x: F.when(F.length(x) >= min_chars, x))


def strip_shard_markers(c: Column) -> Column:
    for p in (r"^==== DOC START ====\s*$", r"^==== DOC END ====\s*$", r"^SOURCE:\s*\S+(?:\s*\|\s*(?:PATH|ID):\s*\S+)?\s*$", r"^====\s*$"):
        c = F.regexp_replace(c, f"(?dm){p}", "")
    return c


def strip_code_tags(c: Column) -> Column:
    for tag in ("reponame", "filename", "gh_stars"):
        c = F.regexp_replace(c, rf"<{tag}>[^\n]*\n?", "")
    return c


def unescape_basic(c: Column) -> Column:
    """The five common character references, as the regular-expression extractor decodes them."""
    for old, new in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """All character references of HTML."""
    import html

    return texts.map(html.unescape, na_action="ignore")


def clean_forum(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(c, r"(?dm)^\[deleted\]:\s*", ""), r"(?dm)^\[removed\]\s*$", "")
    return F.translate(unescape(c), "​﻿", "")


def trim_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A(?:[^\S\n]*\n)+|(?:\n[^\S\n]*)+\z", "")


def clean_by_source(c: Column, kind: Column) -> Column:
    """Cleaning by type of source: code, readme, forum (reddit), qa (stackexchange) or anything else."""
    c = F.when(kind.isin("code", "readme"), strip_code_tags(c)).when(kind == "reddit", clean_forum(c)).otherwise(c)
    c = F.when(kind.isin("stackexchange", "readme"), unescape(c)).otherwise(c)
    return F.when(strip(c) == "", "").otherwise(trim_blank_lines(c))


def strip_license(c: Column, most_lines: int = 30) -> Column:
    def cut(p: str):
        def of(x: Column) -> Column:
            head = F.regexp_extract(x, p, 0)
            breaks = F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit("")))
            return F.when(breaks <= most_lines, F.substr(x, F.length(head) + 1)).otherwise(x)

        return of

    for p in LICENSE_HEADERS:
        c = bind(c, cut(p))
    return F.regexp_replace(c, r"\A\n+", "")


def clean_web(c: Column, least: int = 30, most: int = 10000) -> Column:
    c = without(strip(c), WEB_LINES, "dmi")
    c = strip(F.regexp_replace(collapse_blank_lines(c), r"[ \t]{4,}", "   "))
    return bind(c, lambda x: F.when(word_count(x).between(least, most), x))


def truncate_references(c: Column) -> Column:
    """Cuts a long list of citations at the end of a paper to its first five lines; null for too short or long texts."""
    text = strip(c)
    citation = lambda x: x.rlike(r"\A\[?\d+\]?\s*[A-Z]") | x.rlike(r"\A\d+\.\s+[A-Z]")

    def cut(lines: Column) -> Column:
        n = F.size(lines)
        half = F.greatest(F.floor(n / 2).cast("int"), F.lit(0))
        # how many lines at the end are citations, looking no further than the second half
        tail = F.slice(F.reverse(lines), 1, F.greatest(n - half - 1, F.lit(0)))
        first_other = F.array_position(F.transform(tail, lambda x: citation(strip(x))), F.lit(False)).cast("int")
        run = F.when(first_other == 0, F.size(tail)).otherwise(first_other - 1)
        return F.when(run > 20, F.array_join(F.slice(lines, 1, n - run + 5), "\n")).otherwise(F.array_join(lines, "\n"))

    out = strip(collapse_blank_lines(bind(F.split(text, "\n"), cut)))
    return F.when(word_count(text).between(100, 30000), bind(out, lambda x: F.when(word_count(x) >= 80, x)))


def clean_passage(c: Column, least: int = 200, most: int = 8192) -> Column:
    """Tags out, blanks collapsed; long passages end at their last full stop if that is past 70 %."""
    c = F.regexp_replace(F.regexp_replace(strip(c), "<[^>]+>", " "), r"[ \t]+", " ")
    c = strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))

    def cut(x: Column) -> Column:
        head = F.substring(x, 1, most)
        back = F.locate(".", F.reverse(head))
        ended = F.when((back > 0) & (most - back > most * 0.7), F.substr(head, F.lit(1), most - back + 1)).otherwise(head)
        return F.when(F.length(x) >= least, F.when(F.length(x) > most, ended).otherwise(x))

    return bind(c, cut)


def clean_answer(c: Column, least: int = 10) -> Column:
    c = strip(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"(?U)\s+", " "))
    return bind(c, lambda x: F.when(F.length(x) >= least, x))


def reading_comprehension(passage: Column, question: Column, answer: Column) -> Column:
    return F.concat(passage, F.lit("\n\nQuestion: "), question, F.lit("\nAnswer: "), answer)


def clean_comment(c: Column, least: int = 10, most: int = 2000) -> Column:
    """URLs masked, lines trimmed, empty lines dropped."""
    c = F.regexp_replace(c, r"https?://\S+|www\.\S+", "[URL]")
    c = F.array_join(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), "\n")
    return bind(c, lambda x: F.when(word_count(x).between(least, most), x))


def clean_qa(c: Column, least: int = 15, most: int = 3000) -> Column:
    c = F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"&[a-z]+;", " ")
    c = strip(F.regexp_replace(c, r"(?U)\s+", " "))
    return bind(c, lambda x: F.when(word_count(x).between(least, most), x))


def api_text(c: Column) -> Column:
    """Text for an interface that takes no control characters: blanks collapsed, newlines kept."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""), r"[ \t]+", " "))


def truncate_words(c: Column, most: int = 500) -> Column:
    head = F.substring(c, 1, most)
    back = F.locate(" ", F.reverse(head))
    last = most - back
    return F.when(F.length(c) <= most, c).when((back > 0) & (last > most * 0.7), F.concat(F.substr(head, F.lit(1), last), F.lit("..."))).otherwise(F.concat(head, F.lit("...")))


def template_of(c: Column) -> Column:
    """Quoted parts to {X}, numbers to {N}."""
    c = F.regexp_replace(F.lower(c), '"[^"]+"', '"{X}"')
    return strip(F.regexp_replace(F.regexp_replace(c, r"\b\d+\b", "{N}"), r"(?U)\s+", " "))


def html_title(c: Column) -> Column:
    title = strip(F.regexp_extract(c, r"(?i)<title[^>]*>([^<]+)</title>", 1))
    return F.when(title != "", title)


def html_text(c: Column, least: int = 100) -> Column:
    """Text of a page by regular expressions alone."""
    c = F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>", "")
    c = F.regexp_replace(c, r"(?is)<style[^>]*>.*?</style>", "")
    c = F.regexp_replace(F.regexp_replace(c, r"<br\s*/?>", "\n"), "</p>", "\n\n")
    c = F.regexp_replace(F.regexp_replace(c, "</div>", "\n"), "</h[1-6]>", "\n\n")
    c = unescape_basic(F.regexp_replace(c, "<[^>]+>", " "))
    c = strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n"))
    return bind(c, lambda x: F.when(F.length(x) > least, x))


def passages(c: Column, least: int = 80, most: int = 500) -> Column:
    """Array of paragraph passages that are no heading, code or table."""
    paras = F.transform(F.split(c, "\n\n"), strip)
    paras = F.filter(paras, lambda p: ~(p.startswith("#") | p.startswith("```") | p.startswith("|") | p.startswith("---")))
    flat = F.filter(F.transform(paras, lambda p: strip(F.replace(p, F.lit("\n"), F.lit(" ")))), lambda p: F.length(p) >= least)

    def cut(p: Column) -> Column:
        head = F.substring(p, 1, most)
        back = F.locate(" ", F.reverse(head))
        return F.when(F.length(p) <= most, p).otherwise(F.concat(F.when(back > 0, F.substr(head, F.lit(1), most - back)).otherwise(head), F.lit("...")))

    return F.transform(flat, cut)


def extractive_summary(c: Column, most: int = 500) -> Column:
    """Leading paragraphs while their total stays within ``most`` characters."""
    paras = F.filter(F.transform(F.split(strip(c), "\n\n"), strip), lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("n"), F.lit(False).alias("over"))

    def step(s: Column, p: Column) -> Column:
        fits = (~s["over"]) & (s["n"] + F.length(p) <= most)
        first = (~s["over"]) & ~fits & (F.size(s["kept"]) == 0)
        kept = F.when(fits, F.array_append(s["kept"], p)).when(first, F.array(F.concat(F.substring(p, 1, most - 3), F.lit("...")))).otherwise(s["kept"])
        return F.struct(kept.alias("kept"), F.when(fits, s["n"] + F.length(p) + 2).otherwise(s["n"]).alias("n"), (s["over"] | ~fits).alias("over"))

    return F.aggregate(paras, start, step, lambda s: F.when(F.size(s["kept"]) > 0, F.array_join(s["kept"], "\n\n")).otherwise(F.substring(c, 1, most)))


def good_line(c: Column, least: int = 20, most: int = 2000, blanks: int = 3) -> Column:
    spaces = F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    return F.length(c).between(least, most) & (spaces >= blanks)


def code_quality(c: Column, min_lines: int = 5, max_line: int = 1000, max_mean: int = 200) -> Column:
    """The first reason against a code file, or ``ok``."""

    def judge(lines: Column) -> Column:
        n = F.size(lines)
        count = lambda f: F.size(F.filter(lines, f))
        generated = F.lit(False)
        for p in GENERATED:
            generated = generated | F.substring(c, 1, 2000).rlike(p)
        return (
            F.when(n < min_lines, "too few lines")
            .when(count(lambda x: F.length(x) > max_line) > n * 0.1, "likely minified")
            .when((F.length(c) - n + 1) / n > max_mean, "average line too long")
            .when(generated, "generated")
            .when(count(lambda x: strip(x) != "") < n * 0.3, "too sparse")
            .otherwise("ok")
        )

    return F.transform(F.array(F.split(c, "\n")), judge)[0]


def detect_language(c: Column) -> Column:
    """de where three of the listed words are among the first fifty, else en."""
    head = F.array_distinct(F.slice(words(F.lower(c)), 1, 50))
    return F.when(F.size(F.array_intersect(head, F.array(*map(F.lit, GERMAN)))) >= 3, "de").otherwise("en")


def alpha_ratio(c: Column) -> Column:
    text = strip(c)
    return F.length(F.regexp_replace(text, r"[^\p{L}]", "")) / F.greatest(F.length(text), F.lit(1))


def printable_ratio(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[\p{C}\p{Zl}\p{Zp}]|[\p{Zs}&&[^ ]]", "")) / F.greatest(F.length(c), F.lit(1))


def clean_thread(c: Column, messages: Column | None = None, least: int = 30, most: int = 8000) -> Column:
    """A threaded conversation: URLs masked; at least three messages where their number is known."""
    c = strip(F.regexp_replace(c, r"https?://\S+|www\.\S+", "[URL]"))
    enough = F.lit(True) if messages is None else F.coalesce(messages, F.lit(3)) >= 3
    return F.when(enough & word_count(c).between(least, most), c)


def clean_long_qa(c: Column) -> Column:
    return clean_qa(c, 50, 15000)


def subtitle_line(c: Column) -> Column:
    """A subtitle line without tags and dashes; null for numbers, time codes and single words."""
    meta = c.rlike(r"^\s*(?:\d+|\d\d:\d\d:\d\d[,.]\d+\s*-->.*)\s*$")
    c = F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"\{\\[^}]+\}", "")
    c = strip(F.regexp_replace(strip(c), r"\A[- ]+|[- ]+\z", ""))
    return F.when(~meta & (word_count(c) >= 2), c)


def quoted(c: Column) -> Column:
    """The first text in double quotes, else in single quotes."""
    double = F.regexp_extract(c, '"([^"]+)"', 1)
    single = F.regexp_extract(c, "'([^']+)'", 1)
    return F.when(double != "", double).when(single != "", single)


def forbidden_payload(c: Column, payloads: list[str]) -> Column:
    """Whether a payload is listed, alone or as the first part of ``listed_suffix``."""
    n = normalize(F.coalesce(c, F.lit("")))
    hit = n.isin(*payloads)
    for p in payloads:
        hit = hit | n.startswith(f"{p}_")
    return hit


def mentions(c: Column, payloads: list[str]) -> Column:
    """Whether a text holds a listed payload as whole words, or as the first part of a longer name."""
    n = normalize(F.coalesce(c, F.lit("")))
    hit = F.lit(False)
    for p in payloads:
        hit = hit | n.rlike(rf"\b{re.escape(p)}\b") | F.contains(n, F.lit(f"{p}_"))
    return hit


def span_answer(tokens: Column, start: Column, end: Column) -> Column:
    """Words of a token span (array of token and is_html), HTML tokens left out."""
    part = F.slice(tokens, start + 1, F.greatest(end - start, F.lit(0)))
    return F.array_join(F.transform(F.filter(part, lambda t: ~t["is_html"]), lambda t: t["token"]), " ")
