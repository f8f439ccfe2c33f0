"""Encoders: text to token vectors, and mean pooling inside a task."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import tokenize

# The longest input encoded at once and the size of one encoding step.
MAX_LENGTH = 512
STEP_ROWS = 10
MAX_SEEN = 100_000
# Numbers in the token vectors that are summed at once (about 32 MB).
WORDS_AT_ONCE = 1 << 22

Encoded = tuple[np.ndarray, np.ndarray]


class Encoder:
    """What an encoder has to offer. Subclass it to plug in a trained model.

    ``prepare`` runs in Spark; ``windows`` cuts a prepared value into inputs that
    the model takes at once; ``load`` runs once per task and returns a function
    from a list of such inputs to token vectors (rows, length, dim) and a mask
    (rows, length).
    """

    step_rows = STEP_ROWS

    def prepare(self, text: Column) -> Column:
        return text

    def windows(self, value) -> list:
        return [value]

    def load(self) -> Callable[[list], Encoded]:
        raise NotImplementedError


class HashedEncoder(Encoder):
    """Token vectors made from digests of the token: no weights, same everywhere."""

    def __init__(self, dim: int = 64, max_length: int = MAX_LENGTH):
        if dim % 16:
            raise ValueError("dim must be a multiple of 16")
        self.dim = dim
        self.max_length = max_length
        self.step_rows = max(1, 4096 // dim)  # about 16 MB of token vectors at once

    def prepare(self, text: Column) -> Column:
        return tokenize(text)

    def windows(self, value) -> list:
        return [value[i : i + self.max_length] for i in range(0, len(value), self.max_length)] or [value]

    def token_vector(self, token: str) -> np.ndarray:
        digests = b"".join(
            hashlib.md5(f"{token}:{block}".encode()).digest() for block in range(self.dim // 16)
        )
        return (np.frombuffer(digests, dtype=np.uint8) - 127.5) / 127.5

    def load(self) -> Callable[[list], Encoded]:
        seen: dict[str, np.ndarray] = {}  # frequent tokens are hashed once per task

        def encode(rows: list) -> Encoded:
            length = max((len(r) for r in rows), default=0)
            known = sorted({t for r in rows for t in r})
            if len(seen) > MAX_SEEN:
                seen.clear()
            seen.update((t, self.token_vector(t)) for t in known if t not in seen)
            table = np.array([seen[t] for t in known] + [np.zeros(self.dim)])
            ids = {t: i for i, t in enumerate(known)}
            places = np.full((len(rows), length), len(known))
            for i, row in enumerate(rows):
                places[i, : len(row)] = [ids[t] for t in row]
            return table[places], (places < len(known)).astype(float)

        return encode


def mean_pool(vectors: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Mean of the unmasked token vectors of each row; zeros if all are masked."""
    summed = np.einsum("nld,nl->nd", vectors, mask)
    return summed / np.maximum(mask.sum(axis=1, keepdims=True), 1e-9)


def pooled_windows(rows: list, encoder: Encoder, encode: Callable[[list], Encoded]) -> list[np.ndarray]:
    """Mean of all token vectors of each row, whatever its number of windows."""
    inputs = [(i, w) for i, row in enumerate(rows) for w in encoder.windows(row)]
    sums: list = [0.0] * len(rows)
    counts = np.zeros(len(rows))
    for start in range(0, len(inputs), encoder.step_rows):
        some = inputs[start : start + encoder.step_rows]
        vectors, mask = encode([w for _, w in some])
        summed, n = np.einsum("nld,nl->nd", vectors, mask), mask.sum(axis=1)
        for (i, _), s, c in zip(some, summed, n):
            sums[i] = sums[i] + s
            counts[i] += c
    return [s / max(c, 1e-9) for s, c in zip(sums, counts)]


def embed(text: Column, encoder: Encoder) -> Column:
    """One float vector per text, of the whole text. The encoder is loaded once
    per task and fed a few windows at a time; token vectors never leave the task."""
    if isinstance(encoder, HashedEncoder):
        return _embed_words(encoder.prepare(text), encoder)

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder.load()
        for batch in batches:
            rows, out = batch.tolist(), []
            for start in range(0, len(rows), encoder.step_rows):
                some = rows[start : start + encoder.step_rows]
                out.extend(v.astype(np.float32) for v in pooled_windows(some, encoder, encode))
            yield pd.Series(out, dtype=object)

    return run(encoder.prepare(text))


def _embed_words(tokens: Column, encoder: HashedEncoder) -> Column:
    """The mean of the token vectors where a vector depends on the token alone: the
    tokens are numbered by Arrow, each distinct one is looked up once, and the rows
    of the table are summed per text; a long text is summed in parts."""

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: dict[str, np.ndarray] = {}
        most = max(1, WORDS_AT_ONCE // encoder.dim)
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            owner, words = np.repeat(np.arange(len(batch)), size), batch.flatten()
            sums = np.zeros((len(batch), encoder.dim))
            for a in range(0, len(words), most):
                coded, own = words[a : a + most].dictionary_encode(), owner[a : a + most]
                known = coded.dictionary.to_pylist()
                if len(seen) > MAX_SEEN:
                    seen.clear()
                seen.update((t, encoder.token_vector(t)) for t in known if t not in seen)
                table = np.array([seen[t] for t in known])
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                sums[own[starts]] += np.add.reduceat(table[coded.indices.to_numpy()], starts, axis=0)
            means = (sums / np.maximum(size, 1)[:, None]).astype(np.float32)
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * encoder.dim)
            yield pa.ListArray.from_arrays(offsets, pa.array(means.ravel(), pa.float32()))

    return run(tokens)
