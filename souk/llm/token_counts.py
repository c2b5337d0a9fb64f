"""Token counts: batch encoding in Arrow functions that return lengths only.

Long texts are split where no token can cross, pieces are packed into batches
of about equal bytes, and only the number of tokens of a batch's pieces is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 4_096            # a longer text is split at the next safe boundary
BATCH_BYTES = 1 << 20          # bytes encoded at a time


class _Pieces:
    """A sentencepiece model.  Splitting at a space between two non-spaces is
    safe if no token has a space inside or at its end (after another
    character) and the model puts a space before every text, which then stands
    for the one at the boundary."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        inside = any(" " in p or "▁" in p.lstrip("▁") for p in
                     (self.model.id_to_piece(i) for i in range(self.model.get_piece_size())))
        enc = self.model.encode
        self.safe = not inside and enc("ab cd ef") == enc("ab") + enc("cd") + enc("ef")

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]


class _Json:
    """A model of the tokenizers library; texts are encoded whole."""

    safe = False

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=4)
def load(path: str):
    return _Pieces(path) if path.endswith(".model") else _Json(path)


def _joins(c: str) -> bool:
    """Whether a character may be one with a space beside it."""
    return c.isspace() or c == "▁"


def split_safely(text: str, most: int = PIECE_CHARS) -> list[str]:
    """``text`` in pieces of at least ``most`` characters (the last may be
    shorter), cut at single spaces between two non-spaces; those are left out."""
    out, at = [], 0
    while len(text) - at > most:
        cut = text.find(" ", at + most)
        while cut > 0 and (_joins(text[cut - 1]) or _joins(text[cut + 1:cut + 2])):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut + 1 >= len(text):
            break
        out.append(text[at:cut])
        at = cut + 1
    out.append(text[at:])
    return out


def count_batch(texts: list[str | None], path: str) -> np.ndarray:
    """Tokens of every whole text; a null text has none."""
    model = load(path)
    total = np.zeros(len(texts), dtype=np.int64)
    batch, owner, size = [], [], 0

    def flush() -> None:
        nonlocal size
        if batch:
            np.add.at(total, owner, model.count(batch))
        batch.clear()
        owner.clear()
        size = 0

    for i, text in enumerate(texts):
        for piece in split_safely(text, PIECE_CHARS) if model.safe and text else [text or ""]:
            batch.append(piece)
            owner.append(i)
            size += len(piece)
            if size >= BATCH_BYTES:
                flush()
    flush()
    return total


def with_token_count(df: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of every whole text (null: 0), without
    begin, end or other added tokens, truncation or padding.  ``path`` is a
    tokenizer file that all executors have.  No shuffle."""
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(count_batch(batch.tolist(), path))

    return df.withColumn(out_col, run(F.col(text_col)))
