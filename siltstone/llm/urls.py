"""Operator 4: URL filter by a sorted digest array.

A list of entries becomes three files: the sorted 64-bit xxhash keys, the place of each entry's string, and the strings.
Workers memory-map them, probe whole batches of candidate keys by vectorised binary search, and confirm every hit by
comparing the stored string, so a collision can't decide. An entry is ``host/path``; it fits its host, all subdomains,
and paths that start with its path. The longest entry decides. Where none fits, the host is blocked if one of its labels, or a part of one between hyphens, is a listed term (entries ``term:...`` of
the same array), and allowed otherwise.

Nulls: a null url, or one without ``://``, has an empty host and path; it is allowed, with no rule. Repeated rows are
judged alike. An empty table gives no rows. Other columns than page_id and url are not read.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder

# The rules of the query's contract.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
# Terms that block a host.
TERMS = ["casino", "poker", "bets", "betting", "pills", "viagra", "porn", "adult", "xxx", "escort", "warez"]

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as the contract has them."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for sign in "?#":
        rest = rest.partition(sign)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def build_list(spark: SparkSession, rules: dict[str, str], terms: list[str]) -> str:
    """Writes the digest array to a shared folder and returns its path."""
    folder = shared_folder(spark, "urls")
    entries = [f"{verdict}:{rule}" for rule, verdict in rules.items()] + [f"block:term:{t}" for t in terms]
    keyed = sorted((xxhash.xxh64_intdigest(e.partition(":")[2]), e) for e in entries)
    texts = [e.encode() for _, e in keyed]
    np.array([k for k, _ in keyed], "<u8").tofile(os.path.join(folder, "keys"))
    np.cumsum([0, *map(len, texts)]).astype("<u8").tofile(os.path.join(folder, "places"))
    with open(os.path.join(folder, "texts"), "wb") as f:
        f.write(b"".join(texts))
    return folder


class DigestArray:
    def __init__(self, folder: str):
        self.keys = np.memmap(os.path.join(folder, "keys"), "<u8", "r") if os.path.getsize(os.path.join(folder, "keys")) else np.empty(0, "<u8")
        self.places = np.fromfile(os.path.join(folder, "places"), "<u8")
        self.texts = np.memmap(os.path.join(folder, "texts"), np.uint8, "r") if len(self.keys) else np.empty(0, np.uint8)

    def lookup(self, names: list[str]) -> list[str | None]:
        """The verdict stored for each name, or None."""
        out: list[str | None] = [None] * len(names)
        if not len(self.keys) or not names:
            return out
        probes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
        at = np.searchsorted(self.keys, probes)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == probes).tolist():
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == probes[i]:
                verdict, _, name = bytes(self.texts[int(self.places[j]) : int(self.places[j + 1])]).decode().partition(":")
                if name == names[i]:
                    out[i] = verdict
                    break
                j += 1
        return out


def judge_urls(pages: DataFrame, rules: dict[str, str] | None = None, terms: list[str] | None = None) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every row."""
    rules, terms = RULES if rules is None else rules, TERMS if terms is None else terms
    folder = build_list(pages.sparkSession, rules, terms)
    # only prefix lengths that some rule has need a probe
    lengths = sorted({len(r) - r.index("/") for r in rules}, reverse=True)
    names = ["page_id", "url", "host", "path", "rule", "verdict"]

    def run(batches):
        array = DigestArray(folder)
        for batch in batches:
            ids, urls = (batch.column(i).to_pylist() for i in range(2))
            parts = [split_url(u) for u in urls]
            asked, owner = [], []
            for i, (host, path) in enumerate(parts):
                if not host:
                    continue
                labels = host.split(".")
                found = [f"{'.'.join(labels[j:])}{path[:n]}" for j in range(len(labels)) for n in lengths if n <= len(path)]
                found.sort(key=len, reverse=True)
                found += [f"term:{x}" for label in labels for x in {label, *label.split("-")}]
                asked += found
                owner += [i] * len(found)
            rule: list[str | None] = [None] * len(urls)
            verdict = ["allow"] * len(urls)
            for i, name, said in zip(owner, asked, array.lookup(asked), strict=True):
                if said and rule[i] is None:
                    verdict[i] = said
                    if not name.startswith("term:"):
                        rule[i] = name
            columns = [ids, urls, [h for h, _ in parts], [p for _, p in parts], rule, verdict]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.string()) for i, c in enumerate(columns)], names=names)

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return slim.mapInArrow(run, "page_id long, url string, host string, path string, rule string, verdict string")


ORACLE = """
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(regexp_extract(r, '^[^?#]*'), length(regexp_extract(r, '^[^/?#]*')) + 1) AS path FROM p),
u AS (SELECT * FROM (VALUES """ + ", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in RULES.items()) + """) AS t(rule, rh, rp, v)),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v FROM h JOIN u ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(host, '(^|[.-])(""" + "|".join(TERMS) + """)($|[.-])') THEN 'block' ELSE 'allow' END) AS verdict FROM h LEFT JOIN m ON m.page_id = h.page_id
"""
