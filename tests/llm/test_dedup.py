"""Line, passage, byte-string and SimHash dedup against brute force."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from siltstone.llm import lines, repeats, simhash, substrings, suffixes
from siltstone.llm.common import components


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_lines(texts, least):
    seen, out = [], []
    for text in texts:
        kept = []
        for line in text.split("\n"):
            if not line.strip():
                kept.append(line)
                continue
            if not any(line == s or len(line) >= least and one_edit(line, s) for s in seen):
                kept.append(line)
            seen.append(line)
        out.append("\n".join(kept))
    return out


def edited(rng, line):
    i = rng.randrange(len(line))
    return rng.choice([line[:i] + line[i + 1 :], line[:i] + rng.choice("xyé") + line[i:], line[:i] + rng.choice("xyé") + line[i + 1 :]])


def test_lines_against_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randint(3, 70))) + "z" for _ in range(9)]
    texts = []
    for _ in range(60):
        part = []
        for _ in range(rng.randint(0, 5)):
            line = rng.choice(base)
            for _ in range(rng.randint(0, 2)):
                line = edited(rng, line) or "q"
            part.append(rng.choice([line, line, "", "  "]))
        texts.append("\n".join(part))
    got = dict(lines.dedup_lines(docs_of(spark, texts)).select("doc_id", "text").collect())
    want = brute_lines(texts, 16)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(a != b for a, b in zip(texts, want)) > 20


def test_line_edit_at_every_place(spark):
    """The four part keys miss no edit, at any place and length."""
    for n in range(16, 70):
        line = "".join(chr(97 + (i * 7) % 26) for i in range(n))
        keys = {k for k, _, _ in lines.part_keys(line)}
        for i in range(n):
            for other in (line[:i] + line[i + 1 :], line[:i] + "#" + line[i + 1 :], line[:i] + "#" + line[i:]):
                if len(other) >= 15:
                    mine = {p[1:] for p in lines.part_keys(line)} & {p[1:] for p in lines.part_keys(other)}
                    assert keys & {k for k, _, _ in lines.part_keys(other)}, (n, i)
                    assert mine


def test_lines_edge_cases(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, "same line of some length", "b"), (2, "same line of some length\n\n", "c"), (2, "same line of some length\n\n", "c"), (3, "", "d")], "doc_id long, text string, dedup_lines string")
    got = {(r.doc_id, r.text, r.dedup_lines, r.dedup_removed) for r in lines.dedup_lines(df).collect()}
    assert got == {(1, None, 0, 0), (None, "same line of some length", 1, 0), (2, "\n", 1, 1), (3, "", 0, 0)}
    assert lines.dedup_lines(df.limit(0)).count() == 0


def made_docs(rng, n):
    base = ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 120))) for _ in range(6)]
    out = []
    for _ in range(n):
        t = ""
        for _ in range(rng.randint(0, 3)):
            b = rng.choice(base)
            if b and rng.random() < 0.8:
                a = rng.randrange(len(b))
                t += b[a : a + rng.randint(1, 90)]
            else:
                t += "".join(rng.choice("abcd é") for _ in range(rng.randint(0, 40)))
        out.append(t)
    return out


def brute_bytes(texts, w):
    counts = Counter(t[i : i + w] for t in texts for i in range(len(t) - w + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for i in range(len(t) - w + 1):
            if counts[t[i : i + w]] > 1:
                mask[i : i + w] = True
        spans = int((np.diff(np.concatenate([[0], mask, [0]]).astype(int)) == 1).sum())
        out.append((len(t), int(mask.sum()), spans, sha256(np.frombuffer(t, np.uint8)[~mask].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("group_rows", [20_000, 1])
def test_bytes_against_brute_force(spark, group_rows):
    texts = made_docs(random.Random(group_rows), 40)
    ids = [*range(40), None, None, 7]
    texts = [*texts, None, texts[3], texts[7]]
    want = sorted(((i, *x) for i, x in zip(ids, brute_bytes([(t or "").encode() for t in texts], 20))), key=repr)
    kind = suffixes.byte_kind(20, 6)
    out = suffixes.remove_repeated_bytes(docs_of(spark, texts, ids), 20, group_rows=group_rows)
    got = rows(out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
    assert got == want and sum(x[2] for x in want) > 100
    assert kind.gram == 6


def test_bytes_default_window(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = [f"start {i} " + (passage if i % 2 else passage[:-1]) + f" end {i}" for i in range(6)] + ["z" * 500, "y" * 400]
    want = sorted(((i, *x) for i, x in enumerate(brute_bytes([t.encode() for t in texts], 400))), key=repr)
    out = suffixes.remove_repeated_bytes(docs_of(spark, texts)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(out) == want
    assert want[1][2] >= 400 and want[6][2] == 500 and want[7][2] == 0


def test_bytes_of_a_piece_of_one_window(spark):
    """A repeated piece that is one window lies within another piece of its text."""
    a, b = "cdcdcdcdab", "cdcdbacdb"
    texts = [a * 6, a + b + a * 2 + b + a + b * 2 + "cd" + b + a + b * 3]
    want = sorted(((i, *x) for i, x in enumerate(brute_bytes([t.encode() for t in texts], 40))), key=repr)
    out = suffixes.remove_repeated_bytes(docs_of(spark, texts), 40).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(out) == want


def brute_words(ids, texts, w):
    first, out = {}, []
    order = [(1 << 62 if i is None else i, (t or "").encode().split()) for i, t in zip(ids, texts)]
    for k, words in order:
        for j in range(len(words) - w + 1):
            key = tuple(words[j : j + w])
            first[key] = min(first.get(key, 1 << 63), k)
    for i, (k, words) in zip(ids, order):
        mask = [False] * len(words)
        for j in range(len(words) - w + 1):
            if first[tuple(words[j : j + w])] < k:
                mask[j : j + w] = [True] * w
        kept = b" ".join(x for x, gone in zip(words, mask) if not gone)
        out.append((i, len(words), sum(mask), sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group_rows", [20_000, 1])
def test_passages_against_brute_force(spark, group_rows):
    texts = made_docs(random.Random(group_rows + 1), 40)
    ids = [*range(40), None, None, 7]
    texts = [*texts, None, texts[3], texts[7]]
    want = brute_words(ids, texts, 5)
    out = substrings.remove_repeated_passages(docs_of(spark, texts, ids), 5, group_rows=group_rows)
    assert rows(out.select("doc_id", "n_words", "n_removed", "kept_sha256")) == want
    assert sum(x[2] for x in want) > 30


def test_passages_of_a_piece_of_one_window(spark):
    texts = ["a b b a a b a b b a a b", "b a b b a a b a b b a a b a b b a a b"]
    out = substrings.remove_repeated_passages(docs_of(spark, texts), 7).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows(out) == brute_words(range(2), texts, 7)


def test_passages_and_bytes_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert substrings.remove_repeated_passages(empty).count() == 0
    assert suffixes.remove_repeated_bytes(empty).count() == 0


def test_suffix_automaton():
    rng = random.Random(3)
    added = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(8)]
    automaton = substrings.SuffixAutomaton()
    for a in added:
        automaton.add(a)
    known = {tuple(a[i:j]) for a in added for i in range(len(a)) for j in range(i + 1, len(a) + 1)}
    for _ in range(50):
        q = [rng.randrange(3) for _ in range(15)]
        want = [max(n for n in range(i + 2) if n == 0 or tuple(q[i + 1 - n : i + 1]) in known) for i in range(len(q))]
        assert automaton.matching(q) == want


def test_sliding_min_and_runs():
    rng = np.random.default_rng(1)
    for n, w in ((50, 7), (7, 7), (100, 1), (64, 16)):
        x = rng.integers(0, 1 << 60, n).astype(np.uint64)
        assert (repeats.sliding_min(x, w) == [x[i : i + w].min() for i in range(n - w + 1)]).all()
    symbols = rng.integers(0, 3, 500).astype(np.uint64)
    whole, parts = repeats.runs(symbols, 30, 5), repeats.runs(symbols, 30, 5, step=64)
    pick = lambda r: {i: k for a, b, k in zip(*r) for i in range(a, b)}
    assert pick(whole) == pick(parts) and set(pick(whole)) == set(range(471))


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_texts(rng):
    texts = [None, "", " \n", "One", "one", "ONE two", "É é x"]
    for _ in range(15):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randint(100, 400))]
        for _ in range(rng.randint(1, 8)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    return texts


def brute_components(ids, prints):
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    best = {}
    for i, x in zip(ids, label):
        if i is not None:
            best[x] = min(best.get(x, i), i)
    return [best.get(x) for x in label]


@pytest.mark.parametrize("limits", [(128, 100_000), (1, 3)])
def test_simhash_against_brute_force(spark, limits):
    texts = near_texts(random.Random(limits[1]))
    ids = list(range(100, 100 + len(texts)))
    ids[1] = None
    prints = [brute_fingerprint(t) for t in texts]
    want = sorted(zip(ids, prints, brute_components(ids, prints)), key=repr)
    out = simhash.near_duplicates(docs_of(spark, texts, ids), home_size=limits[0], anchor_rows=limits[1])
    got = rows(out.select("doc_id", simhash.fingerprint_hex(out.fp), "component_id"))
    assert got == sorted(((i, f"{p:016x}", c) for i, p, c in want), key=repr)
    assert len({c for _, _, c in want}) < len(texts)
    assert simhash.near_duplicates(docs_of(spark, texts).limit(0)).count() == 0


def test_anchors_cover_every_pair():
    rng = np.random.default_rng(4)
    for k in (4, 9, 16):
        for _ in range(40):
            x = rng.integers(0, 1 << 64, dtype=np.uint64)
            y = x
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                y ^= np.uint64(1 << int(b))
            at, to = simhash.anchors(np.array([x, y]), k, 3)
            met = {int(t) for a, t in zip(at, to) if a == 0} & {int(t) for a, t in zip(at, to) if a == 1}
            homes = {int(to[0]), int(to[1])}
            assert met & homes


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (101, 102), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keys_of_deletions_are_those_of_the_strings():
    rng = random.Random(8)
    for n in (1, 2, 17, lines._BLOCK - 1, lines._BLOCK, lines._BLOCK + 3):
        line = "".join(rng.choice("abé𝄞\x00") for _ in range(n))
        found = {p: (v1, v2) for a, b, c in lines.neighbourhood(line, {(0, 0)}) for v1, v2, p in zip(a, b, c, strict=True)}
        assert sorted(found) == list(range(-1, n))
        whole = lambda s: next((a[0], b[0]) for a, b, _ in lines.neighbourhood(s, set()))
        assert found[-1] == whole(line)
        for i in rng.sample(range(n), min(n, 20)):
            if n > 1:
                assert found[i] == whole(line[:i] + line[i + 1 :])
                if i and line[i] != line[i - 1]:
                    assert found[i] != found[i - 1]


def test_very_long_lines(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdef ") for _ in range(300_000)) + "z"
    texts = [long, long[:150_000] + long[150_001:], "other\n" + long[:7] + "x" + long[8:], long]
    got = rows(lines.dedup_lines(docs_of(spark, texts)).select("doc_id", "text"))
    assert got == [(0, long), (1, ""), (2, "other"), (3, "")]
