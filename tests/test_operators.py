"""Operators on hand-made rows: what the driver's tables don't hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from siltstone.functions import convert
from siltstone.functions import text as T
from siltstone.operators import audit, dedup, episodes, evaluation, mixing, ordered, packing, parsers, retrieval
from siltstone.sources import readers, writers
from siltstone.streaming import logs


def one(spark, f, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (T.normalize, " A b\n C ", "a b c"), (T.strip_front_matter, "---\na: 1\n---\n\nbody", "body"), (T.strip_front_matter, "---\nno end", "---\nno end"), (T.strip_front_matter, "x\n---\n---\n", "x\n---\n---\n"),
        (T.indent_lines, "    a   b\n\tc\n d  e\n  \n" + " " * 12 + "f", "    a b\n c\nd e\n\n" + " " * 8 + "f"), (T.strip_controls, "a\x00b\x7f\tc\n", "ab\tc\n"), (T.nfc, "é", "é"),
        (T.strip_license, "#!/bin/sh\n# Copyright me\n# x\ncode", "code"), (T.strip_license, "code\n# Copyright", "code\n# Copyright"), (T.truncate_words, "short", "short"), (T.clean_answer, "<b>ten  letters</b>", "ten letters"), (T.clean_answer, "few", None),
        (T.unescape, "&eacute;&#65;", "éA"), (T.template_of, 'Say "Hi You" 12 times', 'say "{X}" {N} times'), (T.strip_shard_markers, "==== DOC START ====\nSOURCE: a | PATH: b\n====\nbody\n==== DOC END ====", "\n\n\nbody\n"),
        (T.clean_forum, "[deleted]: hi &amp;​\n[removed]\nx", "hi &\n\nx"), (T.normalize, None, None), (T.html_title, "<title> T </title>", "T"), (T.detect_language, "der die das und ist", "de"),
        (lambda c: T.clean_by_source(c, F.lit("generic")), " \n\na\n \n", "a"), (lambda c: T.clean_by_source(c, F.lit("code")), "<reponame>x\ncode", "code"), (lambda c: T.extractive_summary(c, 10), "abcd\n\nefgh\n\nij", "abcd\n\nefgh"), (lambda c: T.extractive_summary(c, 6), "abcdefghij\n\nx", "abc..."),
    ],
)
def test_text_function(spark, f, text, want):
    assert one(spark, f, text) == want


def test_near_duplicate_chain(spark):
    """A~B~C with A and C too far: greedy keeps A and C, components would not."""
    df = spark.createDataFrame([(1, 0), (2, 0b1111), (3, 0b11111111), (4, -1), (5, 0)], "doc_id long, fingerprint long")
    assert {tuple(r) for r in dedup.near_pairs(df).collect()} == {(1, 2, 4), (2, 3, 4)}
    assert sorted(r.doc_id for r in dedup.greedy_near_dedup(df).collect()) == [1, 3, 4]


def test_drop_contained(spark):
    df = spark.createDataFrame([(["ab", "abc", "x", "ab", "x", ""],)], "t array<string>")
    assert df.select(dedup.drop_contained(F.col("t")).alias("x")).first().x == ["abc", "x"]


def test_payload_and_template(spark):
    assert one(spark, episodes.payload, 'Say "Hi": now') == "Hi"
    assert one(spark, episodes.payload, "Repeat:\nEcho: word ") == "Echo: word"
    assert one(spark, episodes.payload, "nothing") is None
    assert one(spark, episodes.template, 'Say "Hi" and  Hi', "Hi") == 'Say "{PAYLOAD}" and {PAYLOAD}'


def test_running_total_over_partitions(spark):
    df = spark.range(0, 1000).repartition(7)
    got = {r.id: r.t for r in ordered.running_total(df, ["id"], F.col("id"), "t").collect()}
    assert got == {i: i * (i - 1) // 2 for i in range(1000)}
    assert ordered.running_total(df.limit(0), ["id"], F.col("id"), "t").count() == 0


def test_samples(spark):
    df = spark.range(10)
    assert mixing.exact_sample(df, "id", 25, 1).count() == 25 and mixing.exact_sample(df, "id", 0, 1).count() == 0
    assert mixing.exact_sample(df, "id", 4, 1).select("id").distinct().count() == 4
    assert mixing.ratio_sample(df, "id", 0.01, 1).count() == 1 and mixing.ratio_sample(df, "id", 1.0, 1).count() == 10 and mixing.ratio_sample(df, "id", 2.35, 1).count() == 23
    shards = spark.createDataFrame([("a", 0), ("b", 0), ("b", 1)], "name string, shard long")
    assert {(r.name, r.shard): r.split for r in mixing.shard_split(shards, 0.1).collect()} == {("a", 0): "train", ("b", 0): "train", ("b", 1): "val"}


def test_packers(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([5, 4, 3, 20, 6, 0, 10])], "id long, tokens long").coalesce(1)
    for packed in (packing.next_fit(df, 10, parts=3), packing.best_fit(df, 10, parts=1)):
        rows = packed.collect()
        blocks = {}
        for r in rows:
            blocks.setdefault((r.part, r.block), []).append(r)
        assert all(sum(r.tokens for r in b) <= 10 for b in blocks.values())
        assert {r.id: r.tokens for r in rows if r.tokens} == {0: 5, 1: 4, 2: 3, 3: 10, 4: 6, 6: 10}
    tiny = spark.range(600).withColumn("tokens", F.lit(1)).coalesce(1)
    assert packing.next_fit(tiny, 4096, parts=1).groupBy("part", "block").count().agg(F.max("count")).first()[0] == 255


def test_chunks_and_embedding(spark):
    def chunk(text, **k):
        return [tuple(r) for r in one(spark, lambda c: retrieval.chunks(c, **k), text)]

    assert chunk("short") == [("short", 0, 5, 1, 1)] and one(spark, retrieval.chunks, "") is None
    text = "word " * 600
    got = chunk(text)
    assert [g[1] for g in got] == [0, 1000, 2000] and all(g[2] == len(text) or text[g[2] - 1] == " " for g in got)
    df = spark.createDataFrame([(1, "abc"), (2, ""), (3, "a"), (4, "ABC")], "id long, t string")
    e = {r.id: np.array(r.embedding) for r in retrieval.embed(df, "id", "t").collect()}
    assert set(e) == {1, 4} and abs(np.linalg.norm(e[1]) - 1) < 1e-6 and (e[1] == e[4]).all()
    assert one(spark, retrieval.tool_calls, 'x <toolcall>{"name": "f", "a": 1}</toolcall><toolcall>{"a"</toolcall>')[0].name == "f"


def test_embedding_against_counted_grams(spark, monkeypatch):
    """Every gram of every text, hashed by itself: other alphabets, more characters than have ranks, parts of one key, null
    keys, texts over the end of a block, and rows that keep their own vector."""
    from hashlib import md5

    monkeypatch.setattr(retrieval._GramBytes, "BITS", 4)
    retrieval._gram_bytes.cache_clear()
    texts = ["The cat sat. " * 9, "Größe ÉTÉ 数据处理 🙂🙃 x", "".join(map(chr, range(0x4E00, 0x4E40))) * 2, "ab", "", "q", "a\x00b\n c"]

    def plain(of, dim, low=2, high=5):
        c = np.zeros(dim)
        for t in of:
            for n in range(low, high + 1):
                for i in range(len(t) - n + 1):
                    c[md5(b"seed" + t.lower()[i : i + n].encode()).digest()[0] % dim] += 1
        return (c / np.sqrt((c * c).sum())).astype(np.float32)

    for step in (3, 1000):
        got = retrieval.gram_counts([t.lower() for t in texts], 64, "seed", 2, 5, step)
        for t, c in zip(texts, got, strict=True):
            assert c.sum() == sum(max(0, len(t) - n + 1) for n in range(2, 6)) and (not c.sum() or (retrieval._unit(c[None])[0] == plain([t], 64)).all())
    assert (retrieval._unit(retrieval.gram_counts(["abcdefgh"], 64, "seed", 5, 6))[0] == plain(["abcdefgh"], 64, 5, 6)).all()
    monkeypatch.undo()
    retrieval._gram_bytes.cache_clear()
    rows = [*enumerate(texts), (0, "Other part"), (None, "null one"), (None, "null two"), (9, None)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    got = {r.id: np.array(r.embedding, np.float32) for r in retrieval.embed(df, "id", "t").collect()}
    want = {k: plain([t for i, t in rows if i == k and t and len(t) > 1], 256) for k in (0, 1, 2, 3, 6, None)}
    assert set(got) == set(want) and all((got[k] == want[k]).all() for k in want)
    each = retrieval.embed_rows(df, "t", 32).collect()
    assert sorted(r.t for r in each) == sorted(t for _, t in rows if t and len(t) > 1)
    assert all((np.array(r.embedding, np.float32) == plain([r.t], 32)).all() for r in each)


def test_embeddings_shuffle_no_grams(spark):
    """No row per gram or bucket is exploded, and rows that keep their columns aren't shuffled."""
    df = spark.createDataFrame([(1, "abc")], "id long, t string")
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (retrieval.embed(df, "id", "t"), retrieval.embed_rows(df, "t"))]
    assert not any("Generate" in p or "Aggregate" in p for p in plans) and "Repartition" not in plans[1] and "Join" not in plans[1]


def test_index_of_repeated_ids(spark, tmp_path):
    """Each chunk comes once, with the vector of its own text."""
    from siltstone.plans import serving

    spark.createDataFrame([(1, "first text", "a"), (1, "other words", "b"), (2, "x", "a"), (3, None, "a")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.text: np.array(r.embedding, np.float32) for r in serving.build_index(spark, str(tmp_path)).collect()}
    assert serving.build_index(spark, str(tmp_path)).count() == 2
    assert all((v == retrieval._unit(retrieval.gram_counts([t], 64, "seed", 2, 5))[0]).all() for t, v in got.items()) and len(got) == 2


def test_audit_lines(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00.123456", 'a|b="c d"', None, "free | text=1")], "ts string, v string, none string, details string")
    line = df.select(audit.line(F.col("ts").cast("timestamp"), F.lit("CHAT"), F.lit("INFO"), {"user": F.lit("me"), "ip": F.col("none")}, {"z": F.lit("1"), "k": F.col("v")}, F.col("details")).alias("l"))
    text = line.first().l
    assert text == '2024-01-01T10:00:00.123Z | CHAT | INFO | user=me | k="a\\|b=\\"c d\\"" | z=1 | details="free | text=1"'
    p = line.select(audit.parse(F.col("l")).alias("p")).first().p
    assert p.fields == {"user": "me", "k": 'a|b="c d"', "z": "1"} and p.details == "free | text=1" and p.category == "CHAT"


def test_lineage(spark):
    edges = [("mix", "a", 0.5), ("mix", "b", 0.5), ("a", "x", 0.5), ("a", "b", 0.5), ("b", "y", 1.0)]
    got = dict(audit.flatten_lineage(spark.createDataFrame(edges, "dataset string, input string, ratio double"), "mix").collect())
    assert got == {"x": 0.25, "y": 0.75}
    with pytest.raises(ValueError, match="cycle"):
        audit.flatten_lineage(spark.createDataFrame([("a", "a", 1.0)], "dataset string, input string, ratio double"), "a", 3)


def test_gold_selection(spark):
    log = [(1, 1.0, 1.0), (2, 0.9, 0.8), (3, 0.5, 0.79), (4, 0.9, 0.9), (5, 0.9, 1.0), (6, 0.9, 1.1), (7, 0.9, 0.7), (8, 0.9, 0.75)]
    got = {r.step: (r.blocked, r.gold) for r in evaluation.gold(spark.createDataFrame(log, "step int, t double, v double"), "step", "t", "v").collect()}
    assert got[2] == (None, True) and got[3] == ("overfit", False) and got[7] == ("flapping", False) and got[8] == (None, True)


def test_converters():
    assert convert.html("<h1>T</h1><p>a<img src=x> b</p><div class='shadow'>c</div><div class=ad>no</div><ol><li>x<li>y</ol><pre>k  k</pre>") == "T\n=\n\na b\n\nc\n\n1. x\n2. y\n\n[CODE]\nk  k\n[/CODE]"
    assert convert.markdown("# T #\n\n**b** [l](u) `c`\n```\nx_y_z\n```") == "T\n=\n\nb l c\n[CODE]\nx_y_z\n[/CODE]"
    assert convert.rst("T\n=\n\n.. comment\n   gone\n\n``a`` :ref:`b <c>`") == "T\n=\n\na b"
    assert convert.man('.TH LS 1\n.\\" c\n.SH name\n.B ls\n\\fBx\\fR \\- y') == "LS\n\nNAME\n\nls\nx - y"
    assert convert.rfc_xml("<rfc><middle><section title='A'><t>one <b>two</b></t></section></middle></rfc>") == "A\n=\n\none two"
    assert convert.texinfo("@chapter One\n@c x\n@code{a @b{c}} @@") == "One\n---\n\na c @".replace("---", "===")
    assert convert.javadoc("/** Does a thing with care.\n * @param x the x */\npublic int f(int x) {") == "public int f(int x)\n\nDoes a thing with care.\nParameter x: the x"
    assert convert.go_docs("// F does it.\n// Well.\nfunc F() {}\n") == "F\n\nF does it.\nWell."
    assert convert.ts_docs("/** short */ /** " + "long " * 20 + "*/") == ("long " * 20).strip()
    assert convert.threat_json('{"objects": [{"type": "tool", "name": "n", "description": "d"}, {"type": "x", "name": "n", "description": "d"}]}') == "n\n\nd"
    assert convert.yaml_docs("description: |\n  a block of more than thirty characters\n  on two lines\nx: 1\nsummary: short") == "a block of more than thirty characters\non two lines"


def test_convert_status(spark):
    df = spark.createDataFrame([("a.md", "# x"), ("b.xml", "<broken"), ("c.zip", "x"), ("d.txt", None), ("e.html", "<script>x</script>")], "p string, t string")
    got = {r.p: (r.c.text, r.c.status) for r in df.select("p", convert.to_text(F.col("t"), F.col("p")).alias("c")).collect()}
    assert got["a.md"] == ("x\n=", "ok") and got["b.xml"] == (None, "error:ParseError") and got["c.zip"][1] == "unsupported:zip" and got["d.txt"][1] == "empty" and got["e.html"][1] == "empty"


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "docs/sub").mkdir(parents=True)
    (tmp_path / "docs/a.md").write_text("# Title")
    (tmp_path / "docs/sub/b.txt").write_text("text é")
    (tmp_path / "docs/c.bin").write_bytes(b"\x00")
    got = {r.filename: (r.text, r.status) for r in readers.documents(spark, str(tmp_path / "docs"), ["md", ".txt"]).collect()}
    assert got == {"a.md": ("Title\n=====", "ok"), "b.txt": ("text é", "ok")}

    docs = spark.createDataFrame([(i, "s", f"text {i}\n\nmore") for i in range(6)], "doc_id long, source string, text string")
    manifest = writers.text_shards(docs, str(tmp_path / "shards"), per_shard=150)
    assert manifest.count() == 6
    back = readers.marked_shards(spark, str(tmp_path / "shards/*"))
    assert {(r.source, r.path, r.text) for r in back.collect()} == {("s", str(i), f"text {i}\n\nmore") for i in range(6)}
    assert back.select("shard").distinct().count() > 1

    (tmp_path / "x.jsonl").write_text('{"a": 1}\nbroken\n')
    rows = readers.jsonl(spark, str(tmp_path / "x.jsonl"), "a int").cache()
    assert rows.where("_corrupt_record is null").count() == 1
    (tmp_path / "l.txt").write_text("a\tb\n\t\nc\n")
    assert sorted(r.line for r in readers.lines(spark, str(tmp_path / "l.txt"), True).collect()) == ["a", "b", "c"]
    assert readers.named_sources(spark, [f"n:{tmp_path}/l.txt"]).count() == 3
    (tmp_path / "q.txt").write_text("one<|endoftext|> <|endoftext|>two\n")
    assert sorted(r.text for r in readers.delimited(spark, str(tmp_path / "q.txt")).collect()) == ["one", "two"]
    (tmp_path / "t.txt").write_text("=== e1 ===\nhi\nyou\n<<<MSG_SEP>>>\nthere\n=== e2 ===\nx")
    assert sorted(map(tuple, readers.translation_blocks(spark, str(tmp_path / "t.txt")).collect())) == [("e1", 0, "hi\nyou"), ("e1", 1, "there"), ("e2", 0, "x")]

    tokens = spark.createDataFrame([(1, [1, 2, 3]), (2, [4]), (3, [5, 6])], "id long, tokens array<int>")
    writers.token_shards(tokens, str(tmp_path / "tok"), "id", 4)
    back = spark.read.parquet(str(tmp_path / "tok"))
    assert [r.token for r in back.orderBy("shard", "place").collect()] == [1, 2, 3, 4, 5, 6] and writers.next_shard(back) == 2
    np.array([7, 8, 9], "<u4").tofile(tmp_path / "s.bin")
    assert readers.token_shards(spark, str(tmp_path)).where("shard = 's.bin'").first().tokens == [7, 8, 9]
    e = tmp_path / "ep"
    e.mkdir()
    np.arange(5, dtype="<u4").tofile(e / "tokens.bin")
    np.array([0, 1, 1, 0, 1], np.uint8).tofile(e / "mask.bin")
    np.array([0, 3, 3, 2], "<u8").tofile(e / "episodes.idx")
    assert [(r.episode, r.tokens, r.mask) for r in readers.episode_shards(spark, str(e)).collect()] == [(0, [0, 1, 2], [0, 1, 1]), (1, [3, 4], [0, 1])]
    assert readers.is_episode_indexed(spark, str(e)) and not readers.is_episode_indexed(spark, str(tmp_path / "tok"))
    (tmp_path / "chat-2024-01-05.log").write_text("line\n")
    (tmp_path / "bad.log").write_text("line\n")
    assert [(r.category, str(r.date)) for r in readers.audit_logs(spark, f"{tmp_path}/*.log").collect()] == [("chat", "2024-01-05")]


def test_path_rules(spark):
    f = lambda c: readers.path_reason(c, ["**/*.md", "docs/*.txt"], ["README.md", "**/test/**"])
    cases = {"a/b.md": "kept", "b.md": "kept", "docs/x.txt": "kept", "docs/y/x.txt": "not_included", "a/README.md": "excluded", "a/test/b.md": "excluded"}
    assert {p: one(spark, f, p) for p in cases} == cases


def test_law_versions(spark):
    df = spark.createDataFrame([("/cc/210/20200101/de/x",), ("/cc/210/20210101/de/y",), ("/cc/210/20210101/de/z",), ("/cc/210/20190101/fr/x",), ("bad",)], "path string")
    assert sorted(r.path[-1] for r in readers.law_versions(df).collect()) == ["x", "y", "z"]


def test_parsers(spark):
    df = spark.createDataFrame([("do", "", "done"), ("do", "this", "ok")], "instruction string, input string, output string")
    assert {r.messages[0].content for r in parsers.instruction(df).collect()} == {"do", "do\n\nthis"}
    call = one(spark, parsers.xml_calls, '<invoke name="f"><parameter name="a">1</parameter><parameter name="b">x y</parameter></invoke>')
    assert call[0].name == "f" and call[0].arguments == {"a": "1", "b": "x y"}
    qa = spark.createDataFrame([("The answer is Blue.", "q", "blue"), ("None", "q", "red")], "context string, question string, answer string")
    assert parsers.context_question(qa).count() == 1


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    day = lambda d: f'2024-01-{d:02d}T10:00:00.000Z | CHAT | INFO | user=me | action=x | details="a"\n'
    (source / "1.log").write_text(day(1) * 3 + day(2))
    counts = logs.daily_counts(logs.audit_stream(spark, str(source)))
    logs.run_once(counts, "days", str(tmp_path / "c1"))
    (source / "2.log").write_text(day(5) + day(1))
    got = {str(r.day)[:10]: r["count"] for r in logs.run_once(counts, "days2", str(tmp_path / "c2"), "complete").collect()}
    assert got == {"2024-01-01": 4, "2024-01-02": 1, "2024-01-05": 1}
    (tmp_path / "log").mkdir()
    (tmp_path / "log/a.json").write_text('{"event": "eval", "iter": 1, "val_loss": 2.0}\n{"event": "gold", "iter": 1}\n')
    assert logs.run_once(logs.training_log(spark, str(tmp_path / "log")), "train", str(tmp_path / "c3")).count() == 1


def test_mega_episodes(spark):
    df = spark.createDataFrame(list(enumerate([70, 10, 20, 90, 250, 80, 5])), "id long, tokens long").coalesce(1)
    got = {}
    for r in packing.mega_episodes(df, 100, 15, 0.75, parts=1).collect():
        got.setdefault(r.block, []).append((r.id, r.offset, r.tokens))
    assert sorted(map(sorted, got.values())) == [[(0, 0, 70), (2, 70, 20)], [(3, 0, 90)], [(4, 0, 100)], [(5, 0, 80)]]


def test_small_text_functions(spark):
    assert one(spark, T.subtitle_line, "- <i>Hello</i> there -") == "Hello there" and one(spark, T.subtitle_line, "00:01:02,000 --> 00:01:03,000") is None
    assert one(spark, T.quoted, "a 'b' c") == "b" and one(spark, T.quoted, "none") is None
    assert one(spark, lambda c: T.forbidden_payload(c, ["hello"]), "Hello_7") and not one(spark, lambda c: T.forbidden_payload(c, ["hello"]), "hellos")
    assert one(spark, lambda c: T.mentions(c, ["ok"]), "is it OK?") and not one(spark, lambda c: T.mentions(c, ["ok"]), "book")
    span = spark.createDataFrame([([("<p>", True), ("a", False), ("b", False), ("c", False)],)], "t array<struct<token:string,is_html:boolean>>")
    assert span.select(T.span_answer(F.col("t"), F.lit(0), F.lit(3)).alias("x")).first().x == "a b"
    assert one(spark, lambda c: T.clean_thread(c, F.lit(2)), "word " * 40) is None


def test_workspace(spark):
    from siltstone.operators import workspace

    files = spark.createDataFrame([("/w/a/Note.md", "First part.\n\nSecond part."), ("/w/b.txt", "Other words entirely")], "path string, text string")
    docs = workspace.documents(files, "/w")
    assert [r.title for r in workspace.list_documents(docs).collect()] == ["Note", "b"]
    note = workspace.get_document(docs, title="NOTE").first()
    assert len(note.doc_id) == 12 and workspace.summarize(docs, note.doc_id, 15).first().summary == "First part."
    index = retrieval.embed(docs.withColumnRenamed("doc_id", "chunk_id"), "chunk_id", "text", 64).join(docs.select(F.col("doc_id").alias("chunk_id"), "text"), "chunk_id")
    assert workspace.call("search", index, "other words", k=1).first().text == "Other words entirely"
    assert workspace.search(index, "x").count() == 0
    with pytest.raises(ValueError, match="unknown tool"):
        workspace.call("nope")


def test_sizes_are_rounded_as_by_printf(spark):
    """Halves go to the even digit; nulls stay null."""
    k = 1024
    want = {1023: "1023 B", -5: "-5 B", 1280: "1.2 KB", 1792: "1.8 KB", k**2 - 1: "1024.0 KB", k**2 * 5 // 4: "1.2 MB", k**2 * 7 // 4: "1.8 MB", k**3 // 8 * 9: "1.12 GB", k**3 // 8 * 11: "1.38 GB", k**3 * 2 - 1: "2.00 GB"}
    for n in (*range(1024, 1 << 20, 9973), *range(1 << 20, 1 << 30, 9_999_991), *range(1 << 30, 1 << 37, 999_999_937)):
        want[n] = f"{n / k:.1f} KB" if n < k**2 else f"{n / k**2:.1f} MB" if n < k**3 else f"{n / k**3:.2f} GB"
    df = spark.createDataFrame([(n,) for n in (*want, None)], "n long")
    assert dict(map(tuple, df.select("n", evaluation.human_size(F.col("n"))).collect())) == want | {None: None}


def test_groups_and_gates(spark):
    from siltstone.operators import stats

    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 5)], "g string, o int")
    assert sorted(map(tuple, stats.first_k(df, "g", "o", 2).collect())) == [("a", 1), ("a", 2), ("b", 5)]
    items = spark.createDataFrame([("It is Blue <t>", ["red", "blue"], ["<t>"]), ("blue", ["blue"], ["<t>"])], "r string, k array<string>, t array<string>")
    assert [r.passed for r in stats.overlap_gate(items, "r", "k", "t").collect()] == [True, False]
    f = audit.with_context({"user": F.lit(""), "x": F.lit("1")}, {"user": F.lit("ctx"), "ip": F.lit("9")})
    row = spark.range(1).select(*[v.alias(k) for k, v in f.items()]).first()
    assert row.asDict() == {"user": "ctx", "ip": "9", "x": "1"}
    ranked = ordered.rank_within(df, ["g"], ["o"])
    assert {(r.g, r.o): (r["rank"], r.size) for r in ranked.collect()} == {("a", 1): (0, 3), ("a", 2): (1, 3), ("a", 3): (2, 3), ("b", 5): (0, 1)}


def test_episode_shards_round_trip(spark, tmp_path):
    """Whole episodes come back from the files in order of id, across shards; an overlong one has a shard of its own."""
    import random

    from siltstone.operators import shards
    from siltstone.sources import readers

    rng = random.Random(3)
    rows = [(i, [rng.randint(0, 60_000) for _ in range(n)], [rng.choice([0.0, 0.5, 1.0]) for _ in range(n)]) for i, n in enumerate([5, 0, 7, 40, 3, 9, 9, 2, 10, 1])]
    made = spark.createDataFrame(rows, "id long, tokens array<int>, mask array<double>")
    manifest = sorted(map(tuple, shards.write_episode_shards(made, str(tmp_path / "a"), 10, parts=1).collect()))
    want, used = [[]], 0
    for row in rows:
        if want[-1] and used + len(row[1]) > 10:
            want.append([])
            used = 0
        want[-1].append(row)
        used += len(row[1])
    assert manifest == [(i, len(x), sum(len(r[1]) for r in x)) for i, x in enumerate(want)]
    for i, x in enumerate(want):
        got = readers.episode_shards(spark, str(tmp_path / "a" / f"shard_{i:05d}")).orderBy("episode").collect()
        assert [(r.tokens, r.mask) for r in got] == [(t, [int(w > 0) for w in m]) for _, t, m in x]
    assert not [f for f in (tmp_path / "a").iterdir() if f.name.startswith(".")]
    assert shards.write_episode_shards(made.limit(0), str(tmp_path / "b"), 10).count() == 0


def test_bpe_special_tokens(spark):
    """Pinned ids, the longest special token first, nulls, and ids beyond the vocabulary."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from siltstone.functions import bpe
    from tokenizers import Tokenizer

    path, specials = public_tokenizers.path("byte_bpe_50k.json"), {"<a>": 50_300, "<a><b>": 50_301}
    plain = lambda t: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids
    df = spark.createDataFrame([(0, "one<a><b>two <a>"), (1, None), (2, ""), (3, "ça va\n  été")], "id long, text string")
    got = {r.id: r.ids for r in df.select("id", bpe.encoder(path, specials)("text").alias("ids")).collect()}
    assert got == {0: [*plain("one"), 50_301, *plain("two "), 50_300], 1: None, 2: [], 3: plain("ça va\n  été")}
    back = spark.createDataFrame([(0, [*plain("ab"), 50_300, 70_000, *plain("c")]), (1, None), (2, [])], "id long, ids array<int>")
    assert {r.id: r.t for r in back.select("id", bpe.decoder(path, specials)("ids").alias("t")).collect()} == {0: "ab<a><unk_tok_70000>c", 1: None, 2: ""}
