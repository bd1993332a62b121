"""Operator 1: line dedup by a deletion-neighbourhood join.

A line goes if an earlier line of the corpus (by doc_id, then text, then place) lies within one edit: one character
inserted, deleted or replaced. Equal lines are found by their 128-bit hash. For the rest, a line's deletion
neighbourhood is itself and every string with one character left out; two lines are within one edit exactly if one is in
the other's neighbourhood or both give the same string by leaving out the same place. These keys are joined, the pairs
verified on their texts (within one edit: equal without the places left out), and the earliest kept.

Not every line needs its whole neighbourhood: in four parts measured from both ends, one edit leaves three intact, so
each line first emits four keys, each the hash of all but one part, and only lines that share such a key emit the
deletions inside the part left out. That skips nothing within the bound. No line's text is shuffled in this step.

Very long texts and lines: a deletion's key comes of sums over the line's prefixes, so a line of n characters takes time
in proportion to n, and keys are made and sent on in blocks of bounded size.

Blank lines always stay. Lines under ``min_chars`` characters are only dropped when equal to an earlier one. A document
that loses all its lines keeps its row with an empty text (dedup_lines) and is left out by the pipeline.
Nulls: a null text has no lines and stays null; a null doc_id comes first in order. Rows with the same doc_id and text
are one document to this operator: each gets the same result. An empty table gives no rows. All columns of the input
are returned, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_small, drop, materialize, small_parts, tidy

_SIGN = 1 << 63
_BLANK = " \t\r\x0b\x0c"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= _SIGN else x


def line_hash(line: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(line)
    return _signed(h >> 64), _signed(h & ((1 << 64) - 1))


def _units(length: int) -> set[int]:
    """Part lengths for a line and for one a character longer, rounded so that both nearly always agree."""
    return {length // 16 * 4, (length + 1) // 16 * 4} - {0}


def part_keys(line: str) -> list[tuple[int, int, int]]:
    """(key, unit, part): the hash of all but one of four parts. Lines within one edit share a key at least."""
    out = []
    for u in _units(len(line)):
        for part in range(4):
            kept = f"{part}|{u}|{line[: part * u]}|{line[len(line) - (3 - part) * u :]}"
            out.append((_signed(xxhash.xxh3_64_intdigest(kept.encode("utf-8", "surrogatepass"))), u, part))
    return out


#: The four largest primes below 2^31, and a base for each.
_PRIMES = np.array([[2147483647], [2147483629], [2147483587], [2147483579]], dtype=np.uint64)
_BASES = (1103515245, 1664525001, 1812433253, 1566083941)
_INVERSES = np.array([[pow(b, -1, int(p))] for b, p in zip(_BASES, _PRIMES[:, 0], strict=True)], dtype=np.uint64)
_BLOCK = 1 << 13
_POWERS = np.array([[pow(b, i, int(p)) for i in range(_BLOCK + 1)] for b, p in zip(_BASES, _PRIMES[:, 0], strict=True)], dtype=np.uint64)


def _prefix_sums(codes: np.ndarray):
    """(first place, sums) of each block of a line: the polynomial hashes of all prefixes that end in it, by prime."""
    at, scale = np.zeros((4, 1), np.uint64), np.ones((4, 1), np.uint64)
    for i in range(0, len(codes), _BLOCK):
        block = codes[i : i + _BLOCK]
        terms = block * _POWERS[:, : len(block)] % _PRIMES * scale % _PRIMES
        sums = np.concatenate([at, (at + np.cumsum(terms, axis=1)) % _PRIMES], axis=1)
        yield i, sums
        at, scale = sums[:, -1:], scale * _POWERS[:, _BLOCK:] % _PRIMES


def _two_keys(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = (sums[::2] << np.uint64(31)) | sums[1::2]
    return pairs[0].astype(np.int64), pairs[1].astype(np.int64)


def neighbourhood(line: str, parts: set[tuple[int, int]]):
    """Arrays (v1, v2, place), block by block: the keys of the line itself (place -1) and of its deletions at the places
    inside the parts. Equal strings have equal keys. A key takes the sums of the prefixes before and after its place."""
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    for _, sums in _prefix_sums(codes):
        whole = sums[:, -1:]
    yield *_two_keys(whole), np.array([-1])
    for first, sums in _prefix_sums(codes):
        places = np.arange(first, first + sums.shape[1] - 1)
        inside = np.zeros(len(places), bool)
        for u, part in parts:
            inside |= (places >= part * u) & (places < len(codes) - (3 - part) * u)
        before, after = sums[:, :-1][:, inside], sums[:, 1:][:, inside]
        yield *_two_keys((before + (whole + _PRIMES - after) % _PRIMES * _INVERSES) % _PRIMES), places[inside]


def _without(line: str, place: str) -> Column:
    """A line without the character at a place; whole if the place is -1."""
    p = F.col(place).cast("int")
    return F.when(p < 0, F.col(line)).otherwise(F.concat(F.substring(line, F.lit(1), p), F.expr(f"substring({line}, cast({place} as int) + 2)")))


@tidy
def dedup_lines(docs: DataFrame, min_chars: int = 16) -> DataFrame:
    """The input with ``text`` reduced to kept lines, and the columns dedup_lines (lines with text) and dedup_removed."""
    cols = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("txt"), F.xxhash64("text").alias("tk"))

    def scan(batches):
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.list_(pa.int64())]
        for batch in small_parts(batches):
            rows = []
            for doc, tk, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for n, line in enumerate((text or "").split("\n")):
                    if line.strip(_BLANK):
                        near = [k for k, _, _ in part_keys(line)] if len(line) >= min_chars - 1 else []
                        rows.append((*line_hash(line.encode()), doc, tk, n, near))
            c = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds, strict=True)], names=["h1", "h2", "doc", "tk", "n", "near"])

    lines = boxed.select("doc", "tk", "txt").mapInArrow(scan, "h1 long, h2 long, doc long, tk long, n int, near array<long>")
    place = F.struct("doc", "tk", "n")
    first = materialize(lines.groupBy("h1", "h2").agg(F.min(place).alias("at"), F.first("near").alias("near")), "lines")

    keyed = first.select("h1", "h2", "at", F.posexplode("near").alias("slot", "key"))

    def shared(batches):
        """Sorted by key: rows whose key at least two different lines have. Holds one row."""
        last_key, held = None, None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            keep = []
            lead = []
            for i, key in enumerate(keys):
                if key == last_key:
                    if held is not None:
                        lead.append(held)
                        held = None
                    keep.append(i)
                else:
                    last_key, held = key, batch.slice(i, 1)
            yield from lead
            if keep:
                yield batch.take(pa.array(keep))

    wanted = "key long, h1 long, h2 long, slot int, doc long, tk long, n int"
    grouped = keyed.select("key", "h1", "h2", "slot", "at.*").repartition("key").sortWithinPartitions("key")
    close = materialize(grouped.mapInArrow(shared, wanted), "lines-close")

    near = materialize(close.groupBy("h1", "h2", "doc", "tk", "n").agg(F.collect_set("slot").alias("slots")), "lines-close")
    drop(close)
    per_doc = materialize(near.groupBy("doc", "tk").agg(F.collect_list(F.struct("n", "slots")).alias("todo")), "lines-close")
    side = broadcast_if_small(per_doc).alias("r")
    held = boxed.select("doc", "tk", "txt").alias("l").join(side, F.col("l.doc").eqNullSafe(F.col("r.doc")) & (F.col("l.tk") == F.col("r.tk"))).select("l.doc", "l.tk", "txt", "todo")

    def pick(batches):
        for batch in small_parts(batches):
            rows = []
            for doc, tk, text, todo in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                lines = text.split("\n")
                for x in todo:
                    line = lines[x["n"]]
                    rows.append((*line_hash(line.encode()), doc, tk, x["n"], x["slots"], line))
            c = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.list_(pa.int32()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds, strict=True)], names=["h1", "h2", "doc", "tk", "n", "slots", "line"])

    texts = materialize(held.mapInArrow(pick, "h1 long, h2 long, doc long, tk long, n int, slots array<int>, line string").dropDuplicates(["h1", "h2"]), "lines-text")

    def emit(batches):
        for batch in batches:
            held, size = [], 0
            for row, (slots, line) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("slots", "line")), strict=True)):
                keys = part_keys(line)
                for v1, v2, place in neighbourhood(line, {keys[s][1:] for s in slots}):
                    held.append((row, v1, v2, place))
                    size += len(place)
                    if size > 50_000:
                        yield variants_of(batch, held)
                        held, size = [], 0
            if held:
                yield variants_of(batch, held)

    def variants_of(batch, held):
        row = pa.array(np.repeat([x[0] for x in held], [len(x[3]) for x in held]))
        v1, v2, place = (pa.array(np.concatenate([x[i] for x in held])) for i in (1, 2, 3))
        made = {"v1": v1, "v2": v2, "place": place.cast(pa.int32())}
        names = ["v1", "v2", "doc", "tk", "n", "place", "h1", "h2"]
        return pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c).take(row) for c in names], names=names)

    def meet(batches):
        """Rows sorted by key, then by the line's place in the corpus: each line with the earliest one that it meets.

        Under one key, the whole line meets deletions and a deletion meets the whole line and deletions of its place.
        Earlier lines come first, so the earliest of each place is all that is held.
        """
        key, whole, cut, cut_at, same = None, None, None, None, {}
        for batch in batches:
            found = []
            for v1, v2, _, _, _, place, h1, h2 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (v1, v2) != key:
                    key, whole, cut, cut_at = (v1, v2), None, None, None
                    same.clear()
                me = (h1, h2)
                others = ((cut, cut_at),) if place < 0 else ((whole, -1), (same.get(place), place))
                found += [(h1, h2, *x, place, at) for x, at in others if x and x != me]
                if place < 0:
                    whole = whole or me
                else:
                    if cut is None:
                        cut, cut_at = me, place
                    same.setdefault(place, me)
            c = list(zip(*found, strict=True)) if found else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in c], names=["h1", "h2", "o1", "o2", "cut", "o_cut"])

    variants = texts.mapInArrow(emit, "v1 long, v2 long, doc long, tk long, n int, place int, h1 long, h2 long")
    variants = variants.repartition("v1", "v2").sortWithinPartitions("v1", "v2", "doc", "tk", "n", "place")
    pairs = materialize(variants.mapInArrow(meet, "h1 long, h2 long, o1 long, o2 long, cut long, o_cut long").dropDuplicates(["h1", "h2", "o1", "o2"]), "lines-pairs")
    a, b = texts.select("h1", "h2", F.col("line").alias("a")), texts.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("line").alias("b"))
    met = pairs.join(a, ["h1", "h2"]).join(b, ["o1", "o2"]).where(_without("a", "cut") == _without("b", "o_cut"))
    gone = materialize(met.where(F.length("a") >= min_chars).select("h1", "h2").distinct(), "lines-gone")

    kept = first.select("h1", "h2", "at").join(gone, ["h1", "h2"], "left_anti").groupBy(F.col("at.doc").alias("doc"), F.col("at.tk").alias("tk")).agg(F.collect_list("at.n").alias("kept"))
    kept = materialize(kept, "lines-kept")  # all that the result reads of these tables
    joined = boxed.alias("l").join(kept.alias("r"), F.col("l.doc").eqNullSafe(F.col("r.doc")) & (F.col("l.tk") == F.col("r.tk")), "left")

    keep = [c for c in cols if c not in ("dedup_lines", "dedup_removed")]
    plain = joined.select(*[F.col(f"row.`{c}`").alias(f"c{i}") for i, c in enumerate(keep) if c != "text"], "txt", "kept")
    others = [f for f in plain.schema.fields if f.name not in ("txt", "kept")]
    fields = T.StructType([*others, T.StructField("text", T.StringType()), T.StructField("lines", T.IntegerType()), T.StructField("removed", T.IntegerType())])

    def rebuilt(batches):
        for batch in small_parts(batches):
            new = []
            for text, mine in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                if text is None:
                    new.append((None, 0, 0))
                    continue
                mine, all_ = set(mine or ()), text.split("\n")
                solid = [bool(x.strip(_BLANK)) for x in all_]
                new.append(("\n".join([x for i, x in enumerate(all_) if i in mine or not solid[i]]), sum(solid), sum(solid) - len(mine)))
            made = [pa.array(c, k) for c, k in zip(zip(*new, strict=True), (pa.string(), pa.int32(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], names=fields.names)

    out = plain.mapInArrow(rebuilt, fields)
    named = [F.col("text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(*named, F.col("lines").alias("dedup_lines"), F.col("removed").alias("dedup_removed"))


ORACLE = r"""
WITH l AS (SELECT doc_id, i - 1 AS n, ls[i] AS x FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
s AS (SELECT * FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
f AS (SELECT x, min((doc_id, n)) AS pos, length(x) AS c FROM s GROUP BY x),
h AS (SELECT x, pos, c, 'p' || k AS side, left(x, k) AS part FROM (SELECT *, unnest([c // 2, (c + 1) // 2]) AS k FROM f WHERE c >= 15)
      UNION SELECT x, pos, c, 's' || k, right(x, k) FROM (SELECT *, unnest([c // 2, (c + 1) // 2]) AS k FROM f WHERE c >= 15)),
p AS (SELECT DISTINCT a.x, a.c AS ca, b.x AS y, b.c AS cb FROM h a JOIN h b ON a.side = b.side AND a.part = b.part AND b.pos < a.pos AND abs(a.c - b.c) <= 1 WHERE a.c >= 16),
g AS (SELECT DISTINCT x FROM p WHERE len(list_filter(range(0, greatest(ca, cb)::INT), lambda i:
        CASE WHEN ca = cb THEN left(x, i) = left(y, i) AND substr(x, i + 2) = substr(y, i + 2)
             WHEN ca > cb THEN left(x, i) || substr(x, i + 2) = y ELSE left(y, i) || substr(y, i + 2) = x END)) > 0),
k AS (SELECT l.doc_id, l.n, l.x, NOT regexp_matches(l.x, '[^\x20\x09-\x0D]') AS blank, (l.doc_id, l.n) = f.pos AND g.x IS NULL AS keep FROM l LEFT JOIN f USING (x) LEFT JOIN g USING (x))
SELECT doc_id, (count(*) FILTER (NOT blank))::INT AS n_lines, (count(*) FILTER (NOT blank AND NOT keep))::INT AS n_removed,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY n) FILTER (blank OR keep), '')) AS kept_sha256 FROM k GROUP BY doc_id
"""
