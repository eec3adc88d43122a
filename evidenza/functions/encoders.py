"""Text -> vector encoders and the Arrow function that runs them.

An encoder is any object with ``encode_batch(list[str]) -> 2-D array``.  Callers
pass a factory, so that a model is loaded once per Python worker and never
shipped with the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

ENCODER_BATCH = 32

# Bytes of a lower-case text as they count in words: a-z as they are, all others as spaces.
_LETTERS = np.full(256, ord(" "), np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


def letter_words(texts: list[str]) -> pa.ListArray:
    """Runs of a-z in the lower-case form of each text, with an empty piece at ends that hold none."""
    lowered = pc.utf8_lower(pa.array(texts, pa.large_string()))
    _, ends, data = lowered.buffers()
    plain = _LETTERS[np.frombuffer(data, np.uint8)] if data else np.empty(0, np.uint8)
    spaced = pa.LargeStringArray.from_buffers(len(lowered), ends, pa.py_buffer(plain))
    return pc.ascii_split_whitespace(spaced)


class HashingEncoder:
    """Term counts in ``dim`` md5 buckets, unit length; needs no model files."""

    # distinct tokens are hashed once per batch, so large batches cost least
    batch_size = 2048
    # buckets that are remembered from batch to batch; beyond that the memory starts anew
    cache_limit = 1 << 18

    def __init__(self, dim: int = 64, normalize: bool = True):
        self.dim = dim
        self.normalize = normalize
        self._known: dict[str, int] = {}

    def bucket(self, token: str) -> int:
        """The first four md5 bytes of a token, modulo ``dim``; -1 for an empty one."""
        digest = hashlib.md5(token.encode()).digest()
        self._known[token] = place = int.from_bytes(digest[:4], "big") % self.dim if token else -1
        return place

    def buckets(self, tokens: pa.Array) -> np.ndarray:
        if len(self._known) > self.cache_limit:
            self._known.clear()
        known = self._known
        return np.array([known[t] if t in known else self.bucket(t) for t in tokens.to_pylist()], np.int64)

    def encode_batch(self, texts: list[str]) -> np.ndarray:
        """Splits and counts in Arrow and numpy; only distinct tokens are hashed one by one."""
        pieces = letter_words(texts)
        tokens = pc.list_flatten(pieces).dictionary_encode()
        row = pc.list_parent_indices(pieces).to_numpy().astype(np.int64)
        at = self.buckets(tokens.dictionary)[tokens.indices.to_numpy()]
        real = at >= 0  # the ends of a text split off empty pieces
        cells = np.bincount(row[real] * self.dim + at[real], minlength=len(texts) * self.dim)
        counts = cells.reshape(len(texts), self.dim).astype(np.float64)
        if self.normalize:
            counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-12)
        return counts


def encode_rows(encoder, texts: list[str | None], batch_size: int = ENCODER_BATCH) -> list:
    """One vector or None per text; a text that fails costs only its own row.

    Batches have ``batch_size`` texts unless the encoder declares its own; one
    that fails is halved until the failing texts stand alone.

    An encoder that declares ``max_chars`` gets a longer text in windows of that
    many characters, all of which are encoded; the vector is their mean by length.
    """
    limit = getattr(encoder, "max_chars", None)
    if limit and any(t is not None and len(t) > limit for t in texts):
        return _encode_windows(encoder, texts, batch_size, limit)
    vectors: list = [None] * len(texts)
    present = [i for i, t in enumerate(texts) if t is not None]
    size = getattr(encoder, "batch_size", batch_size)
    waiting = [present[start : start + size] for start in range(0, len(present), size)]
    while waiting:
        rows = waiting.pop()
        try:
            encoded = encoder.encode_batch([texts[i] for i in rows])
            for i, vector in zip(rows, encoded, strict=True):
                vectors[i] = vector
        except Exception:
            if len(rows) > 1:
                half = len(rows) // 2
                waiting += [rows[:half], rows[half:]]
    return vectors


def _encode_windows(encoder, texts: list[str | None], batch_size: int, limit: int) -> list:
    windows, owner = [], []
    for i, text in enumerate(texts):
        if text is not None:
            parts = [text[a : a + limit] for a in range(0, max(len(text), 1), limit)]
            windows += parts
            owner += [i] * len(parts)
    sums: list = [None] * len(texts)
    failed = set()
    for i, part, vector in zip(owner, windows, encode_rows(encoder, windows, batch_size), strict=True):
        if vector is None:
            failed.add(i)
        else:
            weighed = np.asarray(vector, np.float64) * max(len(part), 1)
            sums[i] = weighed if sums[i] is None else sums[i] + weighed
    return [
        None if total is None or i in failed else total / max(len(texts[i]), 1)
        for i, total in enumerate(sums)
    ]


def encode_column(
    text: Column,
    encoder_factory: Callable[[], object] = HashingEncoder,
    batch_size: int = ENCODER_BATCH,
) -> Column:
    """``array<float>`` vectors of a text column; null text or failure gives null."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_factory()
        for batch in batches:
            vectors = encode_rows(encoder, batch.to_pylist(), batch_size)
            yield pa.array(
                [None if v is None else np.asarray(v, dtype=np.float32) for v in vectors],
                type=pa.list_(pa.float32()),
            )

    encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Marked non-deterministic so that a later filter on the vector does not run the model twice.
    return F.arrow_udf(encode, "array<float>").asNondeterministic()(text)
