"""Token ids of whole texts from a public tokenizer file, with a cache of pieces.

A text is cut only where the tokenizer itself always starts a new piece: between
runs of letters, digits, punctuation and white space of well-known characters.
Whatever else stands in a text is handed over in one piece up to the next white
space, and a text with a special token or unusual white space is handed over
whole. So the ids are those of encoding the whole text, while frequent pieces
are encoded once per Python worker.

Where a vocabulary drops white space, texts are first split there, and words that
were seen before are found in a table (by Arrow) instead of being cut into pieces
again. Plain pieces that differ in case only are encoded once if the tokenizer
lower-cases.

The caches are emptied when they are full and when their worker goes on to other
work; they never change a result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marquee.llm.shipping import emptied_between

# Without U+0130, whose lower case ends in a mark that is no letter.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
SIGNS = r"!-&(-/:-@\[-`{-~"
SPACE = r"\t-\r "
UNUSUAL_ASCII = "\x1c\x1d\x1e\x1f"
UNUSUAL = UNUSUAL_ASCII + "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
MAX_PIECES = 1_000_000
MAX_WORDS = 2_000_000  # of a few dozen bytes each
#: Characters that a text put into lower case may have besides white space. A mark would
#: be another matter: some letters join with it in one case only.
FOLDED = "".join(c for c in map(chr, (*range(0x130), *range(0x131, 0x250), *range(0x2010, 0x2028))) if not c.isspace())
unfolded = re.compile(r"[^\x00-\u012f\u0131-\u024f\u2010-\u2027]").search

_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """The tokenizer of a file, without truncation and padding, single-threaded."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def unusual(text: str) -> bool:
    """Whether a text has white space that the pieces below don't know; searching
    for one character at a time is several times faster than a pattern."""
    return any(c in text for c in (UNUSUAL_ASCII if text.isascii() else UNUSUAL))


class PieceEncoder:
    """``spaces``: whether a space belongs to the piece after it (byte-level
    vocabularies) or is dropped (vocabularies with word ends)."""

    def __init__(self, path: str, spaces: bool):
        self.tokenizer = load(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.separator, self.separator_id = next((t.content, i) for i, t in added.items() if t.special)
        run = rf"(?:[{LETTERS}]++|[0-9]{'++' if spaces else ''}|[{SIGNS}]++)(?=[{LETTERS}0-9{SIGNS}{SPACE}]|\Z)"
        blanks = rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]"
        self.pieces = re.compile(f" ?{run}| ?[^{SPACE}]+{blanks}" if spaces else rf"{run}|[^{SPACE}]+|\n").findall
        # Vocabularies with word ends say themselves where a plain piece ends.
        self.plain = None if spaces else re.compile(rf"[{LETTERS}]+|[0-9]|[{SIGNS}]+").fullmatch
        self.word_ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.word_ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        # Texts and plain pieces in lower case, where the normalizer makes that of them and nothing else.
        normalizer = None if spaces else self.tokenizer.normalizer
        self.folds = normalizer is not None and normalizer.normalize_str(FOLDED) == FOLDED.lower()
        self.folded = self.tokenizer
        if self.folds:
            self.folded = type(self.tokenizer)(self.tokenizer.model)
            self.folded.pre_tokenizer = self.tokenizer.pre_tokenizer
        self.cache: dict[str, bytes] = {}
        self.forget_words()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        read = [t if unfolded(t) else t.lower() for t in texts] if self.folds else texts
        whole = [unusual(t) or any(s in t for s in self.special) for t in read]
        if self.plain:
            encoded = self._words(["" if w else t for t, w in zip(read, whole)])
        else:
            encoded = self._looked_up([[] if w else self.pieces(t) for t, w in zip(read, whole)])
        return [self._whole(t) if w else ids for t, w, ids in zip(texts, whole, encoded)]

    def _know(self, distinct: set[str]) -> None:
        """Sees to it that the cache has these pieces."""
        missing = distinct.difference(self.cache)
        if len(self.cache) + len(missing) > MAX_PIECES:
            self.cache.clear()
            missing = distinct
        self._add(list(missing))

    def _looked_up(self, cut: list[list[str]]) -> list[bytes]:
        """Ids of each list of pieces."""
        self._know(set().union(*cut))
        found = self.cache.__getitem__
        return [b"".join(map(found, pieces)) for pieces in cut]

    def _words(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, put together from those of its words."""
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary
        known = pc.index_in(distinct, value_set=self.words)
        if len(self.words) + known.null_count > MAX_WORDS:
            self.forget_words()
            known = pc.index_in(distinct, value_set=self.words)
        new, place = known.is_null(), known.fill_null(0).to_numpy().astype(np.int64)
        place[new.to_numpy(zero_copy_only=False)] = np.arange(len(self.words), len(self.words) + known.null_count)
        self._add_words(distinct.filter(new))
        word = place[numbered.indices.to_numpy()]
        ids = pa.LargeListArray.from_arrays(self.word_bounds, self.word_ids).take(pa.array(word))
        found = ids.flatten().to_numpy()
        bounds = ids.offsets.to_numpy()[cut.offsets.to_numpy()].tolist()
        return [found[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def _add_words(self, new: pa.Array) -> None:
        """Cuts these words, one a line, and puts them into the table."""
        pieces = self.pieces("".join([f"{word}\n" for word in new.to_numpy(zero_copy_only=False).tolist()]))
        self._know({*pieces} - {"\n"})
        self.cache["\n"] = b""
        ids = list(map(self.cache.__getitem__, pieces))
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))[np.fromiter(map("\n".__eq__, pieces), bool, len(ids))]
        self.words = pa.concat_arrays([self.words, new])
        self.word_bounds = np.concatenate((self.word_bounds, self.word_bounds[-1] + ends // 4))
        self.word_ids = np.concatenate((self.word_ids, np.frombuffer(b"".join(ids), "<u4")))

    def forget_words(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.word_bounds, self.word_ids = np.zeros(1, np.int64), np.zeros(0, "<u4")

    def forget(self) -> None:
        self.cache = {}  # a cleared dictionary would keep its table
        self.forget_words()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _add(self, pieces: list[str]) -> None:
        if self.plain:
            plain = list(filter(self.plain, pieces))
            if self.folds:
                lower = [p.lower() for p in plain]
                self._add_joined(list(set(lower).difference(self.cache)), " ")
                self.cache.update((p, self.cache[x]) for p, x in zip(plain, lower))
            else:
                self._add_joined(plain, " ")
            pieces = [p for p in pieces if p not in self.cache]
        self._add_joined(pieces, self.separator)

    def _add_joined(self, pieces: list[str], between: str, at_once: int = 256) -> None:
        """Encodes pieces with something between them that keeps them apart: a
        special token, or a space where word ends tell them from each other."""
        parts = [pieces[i : i + at_once] for i in range(0, len(pieces), at_once)]
        tokenizer = self.tokenizer if between == self.separator else self.folded
        encoded = tokenizer.encode_batch_fast([between.join(p) for p in parts], add_special_tokens=False)
        for some, found in zip(parts, encoded):
            ids = np.array(found.ids, "<u4")
            if between == self.separator:
                ends = np.append(np.flatnonzero(ids == self.separator_id), len(ids))
                starts = np.concatenate(([0], ends[:-1] + 1))
            else:
                ends = np.flatnonzero(self.word_ends[ids]) + 1
                starts = np.concatenate(([0], ends[:-1]))
            if len(ends) != len(some):
                if len(some) == 1:
                    self.cache[some[0]] = self._whole(some[0])
                else:
                    self._add_joined(some, between, 1)
                continue
            raw = ids.tobytes()
            self.cache.update(zip(some, [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]))


def encoder(path: str, spaces: bool) -> PieceEncoder:
    """One encoder per Python worker and file."""
    if (path, spaces) not in _encoders:
        _encoders[path, spaces] = PieceEncoder(path, spaces)
    return _encoders[path, spaces]


@emptied_between
def empty_caches() -> None:
    for each in _encoders.values():
        each.forget()


def groups(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts of about ``chars`` characters together."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
