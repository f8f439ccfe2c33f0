"""Byte-pair encoding by dynamic programming over prefixes.

For every prefix of a piece of text, the last token of its encoding is unique: of
the vocabulary tokens that end there, it is the one that is compatible with the
last token of what precedes it. A suffix automaton of the vocabulary, fed one
byte at a time, lists the tokens ending at a place; a test of token pairs, which
undoes merges at the seam from the latest on, tells whether two tokens can stand
side by side. Following the last tokens back from the end gives the ids. The work
per byte is bounded by the number of tokens that end there, so a piece of any
length takes time in proportion to it.

Pieces are cut by the vocabulary's own pattern; frequent ones are remembered per
Python worker (the memory is emptied when full, which changes no result).

Defined cases: a null text counts as empty; an empty text has no ids and decodes
to an empty text; repeated rows give one result each; null ids are carried
through; further columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shipping import map_batches
from marquee.llm.tokens import LETTERS, SIGNS, SPACE, tokenizer_path, unusual

# The pattern of byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
MAX_PIECES = 500_000
MAX_PAIRS = 1_000_000

_codecs: dict[str, PrefixBpe] = {}


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in files of byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class SuffixAutomaton:
    """Of a set of byte strings. ``tokens[state]`` lists (length, id) of the
    strings that belong to the state, longest first; ``up[state]`` is the next
    state on the way to shorter suffixes that has any."""

    def __init__(self, strings: list[bytes]):
        self.next: dict[int, int] = {}  # state << 8 | byte
        self.link, self.length = [-1], [0]
        out: list[list[int]] = [[]]  # bytes on which a state has a transition
        place = []
        for string in strings:
            last = 0
            for c in string:
                last = self._extend(last, c, out)
            place.append(last)
        self.tokens: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for i, (state, string) in enumerate(zip(place, strings)):
            # A later string may have split off the state of an earlier one.
            state = self._walk(string)
            self.tokens[state] = tuple(sorted((*self.tokens[state], (len(string), i)), reverse=True))
        self.up = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            parent = self.link[state]
            self.up[state] = parent if self.tokens[parent] else self.up[parent]

    def _walk(self, string: bytes) -> int:
        state = 0
        for c in string:
            state = self.next[state << 8 | c]
        return state

    def _new(self, length: int, out: list[list[int]], like: int | None = None) -> int:
        state = len(self.link)
        self.length.append(length)
        self.link.append(-1 if like is None else self.link[like])
        out.append([] if like is None else list(out[like]))
        if like is not None:
            for c in out[like]:
                self.next[state << 8 | c] = self.next[like << 8 | c]
        return state

    def _extend(self, last: int, c: int, out: list[list[int]]) -> int:
        found = self.next.get(last << 8 | c)
        if found is not None:
            if self.length[found] == self.length[last] + 1:
                return found
            return self._split(last, c, found, out)
        state = self._new(self.length[last] + 1, out)
        p = last
        while p != -1 and p << 8 | c not in self.next:
            self.next[p << 8 | c] = state
            out[p].append(c)
            p = self.link[p]
        if p == -1:
            self.link[state] = 0
        else:
            found = self.next[p << 8 | c]
            fits = self.length[found] == self.length[p] + 1
            self.link[state] = found if fits else self._split(p, c, found, out)
        return state

    def _split(self, p: int, c: int, found: int, out: list[list[int]]) -> int:
        copy = self._new(self.length[p] + 1, out, like=found)
        self.link[found] = copy
        while p != -1 and self.next.get(p << 8 | c) == found:
            self.next[p << 8 | c] = copy
            p = self.link[p]
        return copy


class PrefixBpe:
    """Encodes and decodes as the byte-level vocabulary in ``path``."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items() if t not in self.special}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for i, t in names.items()}
        # Merges by order; a byte has order -1. The pair tests compare orders, not ids.
        self.order: dict[int, int] = dict.fromkeys(self.bytes_of, -1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for order, pair in enumerate(spec["model"]["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = vocab[names[a] + names[b]]
            self.order[whole], self.halves[whole], self.merged[a, b] = order, (a, b), order
        ids = sorted(i for i, b in self.bytes_of.items() if self._stands(i))
        self.ids = ids
        self.automaton = SuffixAutomaton([self.bytes_of[i] for i in ids])
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.cut = regex.compile(PATTERN).findall
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        run = rf"(?:[{LETTERS}]++|[0-9]++|[{SIGNS}]++)(?=[{LETTERS}0-9{SIGNS}{SPACE}]|\Z)"
        self.runs = re.compile(f" ?{run}| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]").findall
        self.decode_bytes = dict(self.bytes_of) | {i: t.encode() for t, i in self.special.items()}

    def _stands(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token itself."""
        halves = self.halves.get(token)
        return halves is None or (self._stands(halves[0]) and self._stands(halves[1]) and self._compatible(*halves, self.order[token]))

    def _compatible(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether no merge ever joins the two tokens (before step ``limit``).

        Undoes the merge made last on either side of the seam: had the two parts
        then at the seam an earlier merge together, it would have been made. Of
        equal merges the left one is made first.
        """
        order, halves, merged = self.order, self.halves, self.merged
        ceiling = len(merged) + 1 if limit is None else limit
        while True:
            together = merged.get((a, b))
            if together is not None and together < ceiling:
                return False
            x, y = order[a], order[b]
            if x < 0 and y < 0:
                return True
            if x > y:
                ceiling, a = min(ceiling, x), halves[a][1]
            else:
                ceiling, b = min(ceiling, y + 1), halves[b][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        step, up, tokens, length = self.automaton.next, self.automaton.up, self.automaton.tokens, self.automaton.length
        link, ids, pairs = self.automaton.link, self.ids, self.pairs
        if len(pairs) > MAX_PAIRS:
            pairs.clear()
        last = [-1] * (len(piece) + 1)
        back = [0] * (len(piece) + 1)
        state = matched = 0
        for end, c in enumerate(piece, 1):
            key = state << 8 | c
            while key not in step:
                state = link[state]
                matched = length[state]
                key = state << 8 | c
            state = step[key]
            matched += 1
            at = state
            while last[end] < 0:
                for size, i in tokens[at]:
                    if size <= matched:
                        token, before = ids[i], end - size
                        if before:
                            pair = (last[before], token)
                            fits = pairs.get(pair)
                            if fits is None:
                                fits = pairs[pair] = self._compatible(*pair)
                            if not fits:
                                continue
                        last[end], back[end] = token, before
                        break
                else:
                    at = up[at]
        found = []
        end = len(piece)
        while end:
            found.append(last[end])
            end = back[end]
        return found[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split_special and any(s in text for s in self.special):
            parts = self.split_special(text)
        else:
            parts = [text]
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._plain(part) for part in parts
        )

    def _plain(self, text: str) -> bytes:
        known = self.pieces
        pieces = self.cut(text) if unusual(text) else self.runs(text)
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if len(known) > MAX_PIECES:
            known.clear()
        for piece in pieces:
            if piece not in known:
                ids = [t for part in self.cut(piece) for t in self.encode_piece(part.encode())]
                known[piece] = np.array(ids, "<u4").tobytes()
        return b"".join(map(known.__getitem__, pieces))

    def decode(self, ids: bytes) -> str:
        """The bytes of all tokens; what is not valid UTF-8 becomes U+FFFD."""
        raw = b"".join(map(self.decode_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")


def codec(path: str) -> PrefixBpe:
    """One per Python worker and file."""
    if path not in _codecs:
        _codecs[path] = PrefixBpe(path)
    return _codecs[path]


def encode_decode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Digests of each document's ids and of the text decoded from them."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([sha(x) for x in ids], pa.string()),
                pa.array([sha(own.decode(x).encode()) for x in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_batches, run, SCHEMA)


def encoded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id`` and the ids themselves."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = [np.frombuffer(own.encode(t or ""), "<u4").astype("i8") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_batches, run, "doc_id long, ids array<long>")
