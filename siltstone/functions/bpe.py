"""Byte-pair encoding by a tokenizer file, with special tokens whose ids are pinned. The file must lie on every executor.
A byte-level file gives every text back."""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import functions as F


@functools.cache
def _tokenizer(path: str):
    """One tokenizer a worker."""
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True  # the file's own special tokens are ordinary text; the caller names those that count
    return out


def encoder(path: str, specials: dict[str, int]):
    """Column function text -> ids. Each special token is one id, whatever stands around it; of those that begin at one
    place the longest counts. A null text has no ids, an empty one an empty array; no text is cut."""
    names = sorted(specials, key=len, reverse=True)
    split = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def ids(text: str | None) -> list[int] | None:
        if text is None:
            return None
        out = []
        for part in split.split(text) if split else [text]:
            if part in specials:
                out.append(specials[part])
            elif part:
                out += _tokenizer(path).encode(part, add_special_tokens=False).ids
        return out

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(ids)

    return encode


def decoder(path: str, specials: dict[str, int]):
    """Column function ids -> text. An id beyond the vocabulary that is no special token comes out as ``<unk_tok_id>``."""
    names = {i: name for name, i in specials.items()}

    def text(ids) -> str | None:
        if ids is None:
            return None
        tokenizer = _tokenizer(path)
        size, out, held = tokenizer.get_vocab_size(), [], []

        def flush():
            if held:
                out.append(tokenizer.decode(held, skip_special_tokens=False))
                held.clear()

        for i in map(int, ids):
            if i not in names and 0 <= i < size:
                held.append(i)
            else:
                flush()
                out.append(names.get(i, f"<unk_tok_{i}>"))
        flush()
        return "".join(out)

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(text)

    return decode
