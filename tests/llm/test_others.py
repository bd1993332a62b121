"""Decontamination, quality rules, HTML, URLs, packing and token files."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from siltstone.llm import decontaminate, html, packing, quality, token_files, tokens, urls
from siltstone.llm.common import shared_folder


def shingles(words, n=5):
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_leaks(docs, items):
    out = set()
    for d, text in docs:
        words = decontaminate_words(text)
        for i, item in items:
            want = decontaminate_words(item)
            if len(want) < 5:
                continue
            b = shingles(want)
            for s in range(len(words) - len(want) + 1):
                a = shingles(words[s : s + len(want)])
                both = sum((a & b).values())
                if both >= 0.8 * (sum(a.values()) + sum(b.values()) - both) - 1e-9:
                    out.add((d, i))
    return out


def decontaminate_words(text):
    import regex

    return [w for w in regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).split(" ") if w]


def test_decontamination_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "été", "Ost", "x1", "y2", "zeta", "eta", "iota", "kappa"])
    items = [(i, " ".join(word() for _ in range(rng.randint(20, 60)))) for i in range(12)] + [(90, None), (91, "too few words"), (92, "")]
    docs = [(0, None), (1, ""), (2, "four words are few")]
    for d in range(3, 50):
        text = [word() for _ in range(rng.randint(5, 80))]
        item = items[rng.randrange(12)][1].split()
        kind = d % 4
        if kind == 1:
            text[3:3] = item
        elif kind == 2:
            item[0] = "changed"
            text += item
        elif kind == 3:
            text[2:2] = [x for i, x in enumerate(item) if i % 9]
        docs.append((d, ", ".join(text) if d % 2 else " ".join(text).upper()))
    df = spark.createDataFrame([*docs, docs[5]], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    found = decontaminate.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))
    want = brute_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and len(want) > 15


def test_decontamination_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.decontaminate(docs, items).count() == 0
    assert decontaminate.decontaminate(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0


def brute_counts(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + j for i, g in enumerate(grams) if g in many for j in range(3)}
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), base


def test_quality_counts_and_verdicts(spark):
    rng = random.Random(1)
    clean = lambda: " ".join("".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 150)))
    rows = [(i, clean(), "en" if i % 2 else None, "s") for i in range(40)]
    junk = " ".join(w + "***" for w in clean().split())
    rows += [(100, junk, "en", "s"), (101, None, "en", None), (102, "", None, None), (103, "a\nb\na\n \n\n", "en", "s"), (104, "x y z " * 40, "en", "s"), (105, "one\x0btwo three four", "en", "s"), (1, rows[1][1], "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit(7))
    got = [(r.row.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality_rules(df).collect()]
    assert Counter(got) == Counter((i, *brute_counts(t)) for i, t, _, _ in rows)
    kept = {r.row.doc_id: r.kept for r in quality.quality_rules(df).collect()}
    assert all(kept[i] for i in range(40)) and not any(kept[i] for i in range(100, 106))
    assert quality.quality_rules(df.limit(0)).count() == 0


def test_quality_runs_no_python(spark):
    df = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id long, text string, lang string, source string")
    plan = quality.quality_rules(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


HTML = {
    "<body><div class='content'><p>Hello &amp; you<p>two<div class=comments>no</div></div><aside>x</aside><form>f</form><div class='shadow'>keep</div>": "Hello & you\ntwo\nkeep",
    "<nav><img src=x>menu</nav><article><h1>T&eacute;</h1><p>a <b>b\n c</b><br>d</p><script>if(a<b){}</script><!-- <p>x</p> --></article><footer>f</footer>": "Té\na b c d",
    "<header>h</header><article><header><h1>T</h1></header><p>a</p><section class='comments'><p>c</p></section></article>": "T\na",
    "a < b &lt; c": "a < b < c",
    "<article><ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table></article>": "one\ntwo\n1 2\n3",
    "<p hidden>no</p><p style='display: none'>no</p><p>yes &nbsp; &#65;</p>": "yes A",
    "<title>t</title><style>p{}</style>": "",
    "": "",
}


@pytest.mark.parametrize("page", HTML)
def test_html_pages(page):
    assert html.main_text(page, frozenset()) == HTML[page]


def test_style_tree_removes_what_pages_repeat(spark):
    page = lambda i: f"<body><div class='strip'><p>Same words here</p></div><div class='body'><p>Text number {i} differs</p><p>and {i * 7} too</p></div><div class='tail'><p>Always this</p></div>"
    rows = [(i, f"http://a.test/{i}", page(i)) for i in range(12)] + [(50, "http://lone.test/", page(50)), (51, None, None), (0, "http://a.test/0", page(0))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in html.extract_main_text(df).collect()}
    assert got[3] == "Text number 3 differs\nand 21 too"
    assert got[50] == "Same words here\nText number 50 differs\nand 350 too\nAlways this" and got[51] == ""
    assert html.extract_main_text(df).count() == len(rows) and html.extract_main_text(df.limit(0)).count() == 0


def test_style_tree_judges_inside_articles(spark):
    box = lambda i: f"<body><article><h1>Title {i}</h1><div class='infopanel'><p>Every page has this box</p></div><p>Text number {i} differs</p></article>"
    cards = lambda i: f"<body><article class='card'><p>Card {i} of it</p></article><article class='card'><p>Card {i + 1} of it</p></article><div class='story'><p>Story {i} is what this page is about</p><p>and goes on {i * 7}</p></div>"
    fixed = "<body><article class='card'><p>The same card on all pages, longer than the story of the page that it stands on</p></article>"
    rows = [(i, f"http://box.test/{i}", box(i)) for i in range(10)] + [(100 + i, f"http://cards.test/{i}", cards(i)) for i in range(10)]
    rows += [(200 + i, f"http://fixed.test/{i}", f"{fixed}<div class='story'><p>Story {i}</p></div>") for i in range(10)]
    rows += [(300 + i, f"http://same.test/{i}", box(0)) for i in range(6)]
    got = {r.page_id: r.text for r in html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(10):
        assert got[i] == f"Title {i}\nText number {i} differs"
        assert f"Story {i} is what this page is about\nand goes on {i * 7}" in got[100 + i]
        assert got[200 + i] == f"Story {i}"
    assert got[303] == "Title 0\nEvery page has this box\nText number 0 differs"


def test_url_filter(spark):
    cases = {
        "http://Example.COM/en/1?x#y": ("example.com", "/en/1", "example.com/en/", "block"), "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://m.example.com/de/1": ("m.example.com", "/de/1", "com/", "allow"), "ftp://a.net/es/#x": ("a.net", "/es/", "net/es/", "block"), "http://a.net": ("a.net", "", None, "allow"),
        "http://casino-win.org/x": ("casino-win.org", "/x", None, "block"), "http://casino-win.com/x": ("casino-win.com", "/x", "com/", "allow"), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"), "http://ÉX.net?/es/": ("Éx.net".replace("É", "É").replace("x", "x"), "", None, "allow"),
    }
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)] * 2, "page_id long, url string").withColumn("verdict", F.lit(0))
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect()}
    assert got == cases
    assert urls.judge_urls(df).count() == 2 * len(cases) and urls.judge_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, {}, []).collect()} == {"allow"}


def test_digest_array_confirms_strings(spark, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda x: 7)  # all keys collide
    folder = urls.build_list(spark, {"a/": "block", "b/": "allow"}, ["c"])
    assert urls.DigestArray(folder).lookup(["a/", "b/", "term:c", "d/"]) == ["block", "allow", "block", None]


def test_best_fit_decreasing_and_top_up():
    rng = random.Random(2)
    for size in (8, 100, 4096):
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 300))]
        windows = packing.best_fit_decreasing(lengths, size)
        assert sorted(i for w in windows for i, _, _ in w) == list(range(len(lengths)))
        rooms = []  # the same by search over all windows
        for n in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else size) - n)
        assert sorted(size - sum(p[2] for p in w) for w in windows) == sorted(rooms)
        cells = Counter((i, f + k) for w in packing.top_up([list(w) for w in windows], size) for i, f, n in w for k in range(n))
        assert cells == Counter((i, k) for i, n in enumerate(lengths) for k in range(n))
        for w in packing.top_up(windows, size):
            n = sum(p[2] for p in w)
            assert n == size or n & (n - 1) == 0


def texts():
    rng = random.Random(4)
    words = ["The", "it's", "can't", "élan", "Ünïcödé", "3.5%", "<|endoftext|>", "x" * 90, "naïve", "日本", "’s", "é", "²µ", "\x0b\x1c"]
    return [None, "", " \n ", *[rng.choice([" ", "\n", "\t "]).join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)], "long " * 9000]


def test_packing_whole_texts(spark):
    from tokenizers import Tokenizer

    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id"), (3, texts()[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("x"))
    tok = Tokenizer.from_file(tokens.default_tokenizer())
    want = Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in rows)
    out = packing.pack_documents(df.coalesce(1), with_ids=True).collect()
    for p in out:
        assert crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
    sequences = {}
    for p in out:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0
    whole = Counter()
    for i, ids in want:
        pieces = sorted((p.start, p.length) for p in out if p.doc_id == i and p.doc_tokens == len(ids))
        whole[i, ids] = sum(n for _, n in pieces) // len(ids)
    assert whole == want
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    rows = [(i * 3 % 67, t) for i, t in enumerate(texts())] + [(None, "no id"), (3, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    tok = Tokenizer.from_file(tokens.default_tokenizer())
    folder = shared_folder(spark, "test")
    manifest = token_files.write_token_files(df, folder)
    got = token_files.read_token_files(spark, folder, with_ids=True).collect()
    want = Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: -1 if x is None else x)
    assert sum(m["tokens"] for m in manifest) == at
    other = shared_folder(spark, "test")
    token_files.write_token_files(df.limit(0), other)
    assert token_files.read_token_files(spark, other).count() == 0
