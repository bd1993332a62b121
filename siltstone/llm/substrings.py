"""Operator 5: removal of passages that an earlier document holds, by suffix automata.

Reference shards are the passages around one anchor (see repeats.py): each shard's automaton takes its pieces in doc_id
order, and a piece's matching statistics against it tell which of its windows an earlier document holds. Broadcasting
automata of the whole corpus to every task would grow with the corpus, so pieces go to their shard's task instead.

Nulls: a null text has no words; a null doc_id ranks after all others and removes nothing from another such row. Rows
with the same doc_id don't remove each other's words. Texts under ``window`` words stay whole. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .repeats import Kind, apply


class SuffixAutomaton:
    """Generalised suffix automaton over integer symbols: accepts every substring of the sequences added."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _clone(self, p: int, q: int, c: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
                continue
            new, p = len(self.next), last
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
            last = new

    def matching(self, sequence: list[int]) -> list[int]:
        """Length of the longest suffix of each prefix that occurs in what was added."""
        state = n = 0
        out = []
        for c in sequence:
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if c in self.next[state]:
                state, n = self.next[state][c], n + 1
            out.append(n)
        return out


def word_kind(window: int, gram: int = 5) -> Kind:
    def read(text: bytes):
        words = text.split()
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        return h, lambda a, b: b" ".join(words[a:b])

    def windows(piece: bytes) -> list[bytes]:
        words = piece.split(b" ")
        return [b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)]

    def solve(pieces):
        out = []
        pieces.sort(key=lambda x: x[1])
        if len(pieces) == 1:
            piece, doc, _ = pieces[0]
            return [(doc, piece, 0, piece.count(b" ") + 2 - window)]
        names: dict[bytes, int] = {}
        automaton, i = SuffixAutomaton(), 0
        while i < len(pieces):
            j = i
            while j < len(pieces) and pieces[j][1] == pieces[i][1]:
                j += 1
            coded = [[names.setdefault(w, len(names)) for w in p[0].split(b" ")] for p in pieces[i:j]]
            for (piece, doc, _), words in zip(pieces[i:j], coded, strict=True):
                n = automaton.matching(words)[window - 1 :] if i else [0] * (len(words) - window + 1)
                a = 0
                while a < len(n):
                    b = a
                    while b < len(n) and n[b] < window:
                        b += 1
                    if b > a:
                        out.append((doc, piece, a, b))
                    a = b + 1
                if len(n) and all(x >= window for x in n):
                    out.append((doc, piece, 0, 0))
            if j < len(pieces):
                for words in coded:
                    automaton.add(words)
            i = j
        return out

    return Kind(window, min(gram, window), read, windows, solve, True)


SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def remove_repeated_passages(docs: DataFrame, window: int = 13, with_text: bool = True, group_rows: int = 20_000) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and kept_text (the kept words joined by one space; null if not
    with_text). A word goes if it lies in ``window`` consecutive words that also occur in a document with a smaller id."""

    def judge(doc, text, mask, part):
        words = text.split()
        kept = b" ".join([w for w, gone in zip(words, mask.tolist(), strict=True) if not gone])
        return doc, len(words), int(mask.sum()), sha256(kept).hexdigest(), kept.decode() if with_text else None

    return apply(docs, word_kind(window), SCHEMA, judge, "passages", group_rows)


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS s FROM (SELECT *, unnest(range(1, len(ws) - 11)) AS i FROM d)),
m AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY s) AS lead FROM w) WHERE lead < doc_id),
g AS (SELECT DISTINCT doc_id, i + k AS i FROM m, (SELECT unnest(range(13)) AS k)),
k AS (SELECT p.doc_id, p.i, p.x, g.i IS NOT NULL AS gone FROM (SELECT doc_id, i, ws[i] AS x FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM d)) p LEFT JOIN g ON g.doc_id = p.doc_id AND g.i = p.i)
SELECT d.doc_id, count(k.i) AS n_words, count(k.i) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(x, ' ' ORDER BY k.i) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id
"""
