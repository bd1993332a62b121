"""The corpus pipeline against a brute-force version of its stages on the small tables."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from siltstone.llm import jaccard
from siltstone.llm.common import materialize
from test_dedup import brute_lines
from test_others import brute_leaks

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = materialize(stage(spark, docs, SF), "test")
        after = out.collect()
        if name == "quality rules":
            assert 0.5 * len(before) < len(after) < len(before)
            assert all(before[r.doc_id] == r.text for r in after)
        elif name == "line dedup":
            ids = sorted(before)
            want = dict(zip(ids, brute_lines([before[i] for i in ids], 16)))
            assert {r.doc_id: r.text for r in after} == {i: t for i, t in want.items() if t.strip()}
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "SimHash near-dedup":
            ids = sorted(before)
            label = brute_jaccard([before[i] for i in ids], 0.8)
            assert {r.doc_id for r in after} == {min(i for i, x in zip(ids, label) if x == y) for y in set(label)}
        elif name == "benchmark decontamination":
            leaked = {d for d, _ in brute_leaks(before.items(), items)}
            assert {r.doc_id for r in after} == set(before) - leaked
        else:
            tokens = {r.doc_id: r.doc_tokens for r in after}
            assert set(tokens) == set(before)
            assert sum(r.length for r in after) == sum(tokens.values())
            continue
        assert out.columns == columns
        docs = out


def test_repeated_rows_and_clashing_columns(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(5, text, "en", "s", 1), (5, text, "en", "s", 1), (9, text + " more", "en", "s", 1), (None, "other " + text[::-1], "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row long")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(kept.select("doc_id").collect(), key=repr) == sorted([(5,), (None,)], key=repr)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def brute_jaccard(texts, least):
    """Component labels over all pairs whose five-word shingle sets have the least Jaccard."""
    words = [(t or "").encode().lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set() for w in words]
    label = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or len(x & y) >= least * len(x | y) - 1e-9:
                label = [label[j] if k == label[i] else k for k in label]
    return label


@pytest.mark.parametrize(("sample_docs", "threshold"), [(100_000, 3), (5, 0), (5, 8)])
def test_near_duplicates_by_jaccard_against_brute_force(spark, sample_docs, threshold):
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(60)]
    texts = [None, "", "one", "One", "one two three four five", "a b c d e f g h i"]
    for _ in range(20):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(10, 250))] + shared * rng.randint(0, 1)
        for _ in range(4):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(100)}"
            texts.append(" ".join(copy[: len(copy) - rng.randint(0, 9)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = lambda pairs: sorted(sorted(d for d, r in pairs if r == root) for root in {r for _, r in pairs})
    got = groups([(r.doc_id, r.root) for r in jaccard.similar_documents(docs, sample_docs=sample_docs, threshold=threshold).collect()])
    assert got == groups(list(enumerate(brute_jaccard(texts, 0.8)))) and len(got) < len(texts) - 9


def test_stage_finds_a_copy_with_a_few_replaced_words(spark):
    rng = random.Random(8)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(["new" if j in (60, 120) else w for j, w in enumerate(words)]))]
    kept = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 80, 2))


def test_hot_shingles_bring_their_rows_again(spark, monkeypatch):
    """With next to no rows held, every shingle takes the way of hot ones, and the result stays exact."""
    monkeypatch.setattr(jaccard, "_HELD", 1)
    monkeypatch.setattr(jaccard, "_APART", 1)
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(80)]
    texts = [" ".join([*shared, *(f"w{rng.randrange(50)}" for _ in range(rng.randint(2, 20)))]) for _ in range(60)]
    texts += texts[:5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = lambda pairs: sorted(sorted(d for d, r in pairs if r == root) for root in {r for _, r in pairs})
    got = groups([(r.doc_id, r.root) for r in jaccard.similar_documents(docs, threshold=0).collect()])
    assert got == groups(list(enumerate(brute_jaccard(texts, 0.8)))) and len(got) < len(texts) - 9


def test_counts_bound_the_overlap():
    import numpy as np

    rng = np.random.default_rng(2)
    for n, m in ((50, 50), (300, 280), (60_000, 59_000)):
        x = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: int(0.92 * len(x))], rng.integers(0, 1 << 64, m - int(0.92 * len(x)), dtype=np.uint64)]))
        z = np.unique(rng.integers(0, 1 << 64, m, dtype=np.uint64))
        c = [np.frombuffer(jaccard.counts_of(v), np.uint8)[None] for v in (x, y, z)]
        both = len(np.intersect1d(x, y))
        assert both >= 0.8 * (len(x) + len(y) - both) and jaccard.may_reach(np.array([len(x)]), np.array([len(y)]), c[0], c[1], 0.8).all()
        assert n > 1000 or not jaccard.may_reach(np.array([len(x)]), np.array([len(z)]), c[0], c[2], 0.8).any()


@pytest.mark.parametrize("blocks", [1, 3])
def test_rows_of_a_shingle_meet_in_blocks(spark, blocks):
    """Each able pair of different groups comes from one cell, however the stream is cut into batches."""
    rng = random.Random(blocks)
    marked = [(g, rng.randint(1, 4), rng.randint(20, 30), 100 * g + i, rng.randint(0, 4)) for g in range(12) for i in range(rng.choice([1, 2, 9, 30]))]
    most = {g: max(range(1, 5), key=lambda r: sum(x[0] == g and x[1] == r for x in marked)) for g in range(12)}
    table = spark.createDataFrame([(*x, x[1] == most[x[0]], blocks) for x in marked], "gram long, root long, n int, set long, pos int, main boolean, nb int")
    dealt = table.select("gram", F.explode(jaccard.cells()).alias("c"), "root", "n", "set", "pos", "main").select("gram", "c.*", "root", "n", "set", "pos", "main")
    dealt = dealt.orderBy("gram", "h", "v").toArrow()
    got = []
    for t in jaccard._cells_of(dealt.to_batches(max_chunksize=7)):
        for i, j in jaccard._able_pairs(t, 0.8, most=50):
            name = t.column("set").to_numpy()
            got += [frozenset(p) for p in zip(name[i].tolist(), name[j].tolist())]
    want = [frozenset((x[3], y[3])) for x in marked for y in marked if x[0] == y[0] and x[3] < y[3] and x[1] != y[1] and jaccard.can_reach(x[2], x[4], y[2], y[4], 0.8)]
    assert sorted(map(sorted, got)) == sorted(map(sorted, want)) and want


def test_order_of_shingles_comes_of_all_documents(spark, monkeypatch):
    """However many there are: the counts hold every document's one shingle."""

    class Counted(Exception):
        pass

    def counted(*args, real=jaccard.bucket_counts):
        raise Counted(real(*args).sum())

    monkeypatch.setattr(jaccard, "bucket_counts", counted)
    docs = spark.range(0, 200_001, 1, 4).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    with pytest.raises(Counted, match="^200001$"):
        jaccard.similar_documents(docs)
