"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, html, lines, packing, quality, simhash, substrings, suffixes, token_files, urls
from .common import shared_folder, table


def op1_line_dedup(spark, sf_dir):
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("dedup_lines").alias("n_lines"), F.col("dedup_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.round(F.max("similarity"), 6).alias("similarity"))


def op3_html_extraction(spark, sf_dir):
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op4_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages")).drop("url")


def op5_substring_dedup(spark, sf_dir):
    return substrings.remove_repeated_passages(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


def op6_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents"), with_bytes=False).drop("kept_bytes", "spans")


def op8_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_quality_rules(spark, sf_dir):
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_token_files(spark, sf_dir):
    folder = shared_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    return token_files.read_token_files(spark, folder)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_decontamination, op3_html_extraction, op4_url_filter, op5_substring_dedup, op6_packing, op7_suffix_dedup, op8_simhash, op9_quality_rules, op10_token_files)}
ORACLES: dict[str, str] = {"op1_line_dedup": lines.ORACLE, "op2_decontamination": decontaminate.ORACLE, "op4_url_filter": urls.ORACLE, "op5_substring_dedup": substrings.ORACLE, "op9_quality_rules": quality.ORACLE}
