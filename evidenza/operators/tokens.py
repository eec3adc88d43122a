"""Texts -> WordPiece tokens, token windows, and vectors of whole texts read in such windows.

The vocabulary is a table with one piece per row.  A published model fixes it, so its size does
not grow with the data; its pieces are shipped to the tasks, and a table that is larger than
any model's vocabulary is refused, as it cannot be one.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidenza.functions.encoders import HashingEncoder, encode_column
from evidenza.functions.wordpiece import MAX_TOKENS, TokenWindows, WordPiece

#: More pieces than any published vocabulary has; about 100 MB in a worker.
MAX_PIECES = 1 << 20


def vocabulary_pieces(vocabulary: DataFrame, piece: str = "piece", limit: int = MAX_PIECES) -> list[str]:
    """Distinct pieces of a vocabulary table, sorted; nulls and empty pieces do not count."""
    wanted = vocabulary.select(F.col(piece).alias("piece")).where("piece <> ''").distinct()
    found = [r.piece for r in wanted.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"a vocabulary of more than {limit} pieces")
    return sorted(found)


def token_column(text: Column, pieces: Sequence[str]) -> Column:
    """``array<string>``: all tokens of a whole text; null for null."""

    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = WordPiece(pieces)
        for batch in batches:
            parts = [pa.array([tokenizer.tokens(t.as_py()) if t.is_valid else None], pa.list_(pa.string())) for t in batch]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    tokens.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(tokens, "array<string>")(text)


def window_column(text: Column, pieces: Sequence[str], max_tokens: int = MAX_TOKENS) -> Column:
    """``array<struct<start, stop, n_words, n_tokens>>``: where the windows of a text lie, in
    characters; null for null."""
    names = ("start", "stop", "n_words", "n_tokens")

    def windows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = WordPiece(pieces)
        for batch in batches:
            # one text and flat numbers at a time: whole batches as Python objects take ten times the room
            values, sizes = array("q"), array("q")
            for text in batch:
                found = tokenizer.windows(text.as_py(), max_tokens) if text.is_valid else ()
                values.extend(chain.from_iterable(found))
                sizes.append(len(found))
            cells = np.frombuffer(values, np.int64).reshape(-1, len(names))
            structs = pa.StructArray.from_arrays([pa.array(cells[:, i]) for i in range(len(names))], names)
            ends = np.r_[0, np.cumsum(np.frombuffer(sizes, np.int64))].astype(np.int32)
            null = np.r_[batch.is_null().to_numpy(zero_copy_only=False), False]
            yield pa.ListArray.from_arrays(pa.array(ends, mask=null), structs)

    windows.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    kind = f"array<struct<{', '.join(f'{n}: bigint' for n in names)}>>"
    return F.arrow_udf(windows, kind)(text)


def window_rows(
    texts: DataFrame, key: Sequence[str], pieces: Sequence[str], text: str = "text", max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """``(*key, window_no, start, stop, n_words, n_tokens)``: one row per window of each text.

    The outer form keeps Spark from testing the windows in a filter of its own, which would
    read every text twice, in two Python workers per task.
    """
    found = texts.select(*key, window_column(F.col(text), pieces, max_tokens).alias("_windows"))
    rows = found.select(*key, F.posexplode_outer("_windows").alias("window_no", "_w")).where("window_no IS NOT NULL")
    return rows.select(*key, "window_no", "_w.*")


def encode_by_tokens(
    text: Column,
    pieces: Sequence[str],
    encoder_factory: Callable[[], object] = HashingEncoder,
    max_tokens: int = MAX_TOKENS,
) -> Column:
    """Vectors of whole texts through an encoder with a limit of tokens, see ``TokenWindows``."""
    return encode_column(text, lambda: TokenWindows(encoder_factory(), WordPiece(pieces), max_tokens))
