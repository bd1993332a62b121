"""Corpus pipeline over ``documents``: quality rules, line dedup, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and the
next stage reads that. All but the last return the columns of their input; n_chars, where there is one, follows the text
that line dedup leaves. No SQL expresses the whole: tests compare it with a brute-force version.

Nulls: a null text fails the quality rules; null doc_ids, languages and sources are values like others. Repeated rows
(same doc_id and text) are one document to line dedup and come out of near-dedup once. Empty tables give empty tables.
Rows travel in a struct, so extra columns keep their names and values whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.llm import decontaminate, lines, packing, quality, simhash
from siltstone.llm.common import broadcast_if_small, drop, materialize, table, tidy

ORACLE_SQL = None


@tidy
def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules keep. Verdicts go by text, language and source, so those rejected are named by a
    hash of the three and no text is written a second time."""
    name = lambda at: F.xxhash64(f"{at}text", F.col(f"{at}lang").isNull(), f"{at}lang", f"{at}source")
    judged = quality.quality_rules(docs.select("text", "lang", "source", name("").alias("name")), ["name"])
    gone = materialize(judged.where("not kept").select(F.col("row.name").alias("gone")).distinct(), "pipeline")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(broadcast_if_small(gone), name("row.") == F.col("gone"), "left_anti").select("row.*")


@tidy
def line_stage(spark, docs, sf_dir):
    """Documents without repeated lines; one that had text and lost every line goes."""
    out = lines.dedup_lines(docs).where("dedup_lines = 0 or dedup_removed < dedup_lines")
    n = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    return out.select(*[n.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


@tidy
def near_duplicate_stage(spark, docs, sf_dir):
    """The document with the smallest doc_id of each near-duplicate group (five-word Jaccard of 0.8 or more); of repeated
    rows of it, one."""
    found = simhash.near_duplicates(docs, shingle=5, similarity=0.8)
    rows = found.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key", "n")).alias("s"))
    first = materialize(first.select(F.col("s.doc_id").alias("k_doc"), F.col("s.text_key").alias("k_text"), F.col("s.n").alias("n")), "pipeline")
    boxed = _boxed(docs)
    chosen = lambda some: boxed.join(broadcast_if_small(some), _same())
    out = chosen(first.where("n = 1")).select("row.*")
    many = materialize(first.where("n > 1"), "pipeline")
    if many.isEmpty():
        return out
    return out.unionByName(chosen(many).groupBy("d", "t").agg(F.first("row").alias("row")).select("row.*"))


def _boxed(docs):
    """Whole rows in a struct, so that no column of theirs can clash, with their key: doc_id and a hash of the text."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("t"))


def _same():
    return F.col("d").eqNullSafe(F.col("k_doc")) & (F.col("t") == F.col("k_text"))


@tidy
def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    hits = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("k_doc"), F.col("text_key").alias("k_text")).distinct()
    hits = broadcast_if_small(materialize(hits, "pipeline"))
    return _boxed(docs).join(hits, _same(), "left_anti").select("row.*")


@tidy
def packing_stage(spark, docs, sf_dir):
    """Training sequences: one row per piece of a document, with its tokens."""
    return packing.pack_documents(docs, cache_words=100_000)  # workers of five stages share their executor's memory


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]


@tidy
def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        written = tidy(lambda docs, stage=stage: materialize(stage(spark, docs, sf_dir), "stage"))
        before, docs = docs, written(docs)
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
