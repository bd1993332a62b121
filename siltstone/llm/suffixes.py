"""Operator 7: removal of repeated byte strings, by prefix-free parsing.

Rolling-hash triggers cut the corpus: here a trigger is the least hash of any ``window`` bytes, so each such string holds
one (see repeats.py), and phrases meet at triggers. The dictionary is the set of different phrases; only phrases that
occur again can hold a repeated string, and equal pieces collapse to one entry with a count. Within the entries of one
trigger, the order of all suffixes follows from two small orders: of the dictionary's parts before the trigger, and of
what follows it in the parse. Suffixes that start ``a`` bytes before the trigger are ordered by those ``a`` bytes and then
by the rank of the rest, so classes of equal parts, refined byte by byte where they differ, with the common prefixes of
neighbouring ranks give every suffix's longest repeat without comparing pairs.

Nulls: a null text is empty. Rows with equal doc_id or text are separate occurrences. Texts under ``window`` bytes stay
whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Kind, apply


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def longest_repeats(lefts: list[bytes], rights: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """For each entry (reversed part before the trigger, part from it on): inclusive ranges of ``a`` so that the window
    starting ``a`` bytes before the trigger occurs in another entry too."""
    found: list[list[tuple[int, int]]] = [[] for _ in lefts]
    order = sorted(range(len(lefts)), key=rights.__getitem__)
    near = [common(rights[x], rights[y]) for x, y in zip(order, order[1:], strict=False)]
    # a class: entries in rank order whose first ``a`` left bytes are equal, with the common prefix of neighbours
    todo = [(order, near, 0)]
    while todo:
        members, near, low = todo.pop()
        if len(members) < 2:
            continue
        head = lefts[members[0]]
        high = min(common(head, lefts[m]) for m in members[1:])
        for i, m in enumerate(members):
            best = max(near[i - 1] if i else 0, near[i] if i < len(near) else 0)
            start = max(low, window - best)
            if start <= high:
                found[m].append((start, high))
        parts: dict[int, tuple[list[int], list[int], int]] = {}
        least: dict[int, int] = {}
        for i, m in enumerate(members):
            if i:
                for c in least:
                    least[c] = min(least[c], near[i - 1])
            if len(lefts[m]) <= high:
                continue
            c = lefts[m][high]
            if c in parts:
                parts[c][1].append(least[c])
            else:
                parts[c] = ([], [], high + 1)
            parts[c][0].append(m)
            least[c] = 1 << 62
        todo += parts.values()
    return found


def byte_kind(window: int, gram: int = 32) -> Kind:
    gram = min(gram, window)

    def read(text: bytes):
        return np.frombuffer(text, np.uint8).astype(np.uint64), lambda a, b: text[a:b]

    def windows(piece: bytes) -> list[bytes]:
        return [piece[i : i + window] for i in range(len(piece) - window + 1)]

    def solve(pieces):
        if len(pieces) == 1:
            piece, doc, n = pieces[0]
            return [] if n > 1 else [(doc, piece, 0, len(piece) - window + 1)]
        # the trigger lies in every window of a piece: between its last window's start and its first window's end
        lefts, rights = [], []
        for piece, _, _ in pieces:
            at = trigger(piece, window, gram)
            lefts.append(piece[:at][::-1])
            rights.append(piece[at:])
        out = []
        for (piece, doc, n), left, ranges in zip(pieces, lefts, longest_repeats(lefts, rights, window), strict=True):
            if n > 1:
                continue
            total = len(piece) - window + 1
            gone = np.zeros(total + 1, bool)
            for a, b in ranges:
                gone[max(0, len(left) - b) : min(total, len(left) - a + 1)] = True
            gone[total] = True
            edges = np.flatnonzero(np.diff(np.concatenate([[True], gone]).astype(np.int8)))
            out += [(doc, piece, int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)] or [(doc, piece, 0, 0)]
        return out

    return Kind(window, gram, read, windows, solve, False)


def trigger(piece: bytes, window: int, gram: int) -> int:
    """Place of the trigger in a piece: the least rolling hash of its first window."""
    from .repeats import rolling

    h = rolling(np.frombuffer(piece[:window], np.uint8).astype(np.uint64), gram) >> np.uint64(24)
    return int(np.argmin(h))


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary, spans array<struct<first:long,end:long>>"


def remove_repeated_bytes(docs: DataFrame, window: int = 400, with_bytes: bool = True, group_rows: int = 20_000) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes (null if not with_bytes) and the removed
    spans. A byte goes if it lies in ``window`` bytes that occur anywhere else in the corpus."""

    def judge(doc, text, mask, part):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8))).tolist()
        spans = list(zip(edges[::2], edges[1::2], strict=True))
        kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
        return doc, len(text), int(mask.sum()), len(spans), sha256(kept).hexdigest(), kept if with_bytes else None, [{"first": a, "end": b} for a, b in spans]

    return apply(docs, byte_kind(window), SCHEMA, judge, "suffixes", group_rows)
