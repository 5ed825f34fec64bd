"""Token ids of many texts with a public tokenizer file.

The file's pre-tokenizer drops white space and its normaliser and merges never
look across it, so a text is split at white space (a safe boundary, also for
very long texts) and its ids are those of its words, one after another. Each
worker keeps the ids of words it has met, up to a fixed number, and asks the
library for the new words of a slice only.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from wattspan.llm.batches import HELD, IS_SPACE, bounds, ragged, runs, sums, word_hashes

WORD_FILE = "word_bpe_49k.json"
SLOTS = 1 << 21
MOST_WORDS = 3 << 18
MOST_IDS = 6 << 20
MOST_PIECES = 200_000
BATCH_BYTES = 1 << 18

# The file's own pattern, for lower-cased ASCII.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")

_U = np.uint64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_FILE)


class WordEncoder:
    """Ids by word, looked up by the word's 64-bit hash in an open-addressing table."""

    def __init__(self, path: str):
        # Spark runs one worker per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(SLOTS, _U)
        self.at = np.full(SLOTS, -1, np.int32)
        self.start = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.int32)
        self.words = self.used = 0
        self.pieces: dict[str, list[int]] = {}

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Number of each known word, -1 for new ones."""
        found = np.full(len(h), -1, np.int32)
        open_ = np.arange(len(h))
        slot = (h >> _U(43)).astype(np.int64)
        while len(open_):
            at = self.at[slot]
            hit = (self.keys[slot] == h[open_]) & (at >= 0)
            found[open_[hit]] = at[hit]
            more = ~hit & (at >= 0)
            open_, slot = open_[more], (slot[more] + 1) & (SLOTS - 1)
        return found

    def _place(self, h: np.ndarray, numbers: np.ndarray) -> None:
        """Puts distinct new keys into free slots."""
        slot = (h >> _U(43)).astype(np.int64)
        while len(h):
            free = self.at[slot] < 0
            _, one = np.unique(slot[free], return_index=True)
            winners = np.flatnonzero(free)[one]
            self.keys[slot[winners]], self.at[slot[winners]] = h[winners], numbers[winners]
            rest = np.ones(len(h), bool)
            rest[winners] = False
            h, numbers, slot = h[rest], numbers[rest], (slot[rest] + 1) & (SLOTS - 1)

    def _ascii(self, word: str) -> list[int]:
        """A plain word by the file's own pieces; each piece goes to the library's model once."""
        got = [self._piece(p) for p in _ASCII_PIECES.findall(word)]
        return got[0] if len(got) == 1 else list(chain.from_iterable(got))

    def _piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = [x.id for x in self.model.tokenize(piece)]
            if len(piece) <= 64:
                if len(self.pieces) >= MOST_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def _encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of new words; all but plain ASCII ones in library batches of bounded bytes."""
        out: list = [None] * len(words)
        batch: list[int] = []
        size = 0

        def flush():
            texts = [words[i].decode("utf-8", "replace") for i in batch]
            for i, e in zip(batch, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                out[i] = e.ids
            batch.clear()

        for i, w in enumerate(words):
            # A special string, a control character or a letter beyond ASCII needs the whole tokenizer.
            if w.isascii() and b"<|" not in w:
                word = w.decode("ascii")
                if word.isprintable():
                    out[i] = self._ascii(word.lower())
                    continue
            batch.append(i)
            size += len(w)
            if size >= BATCH_BYTES:
                flush()
                size = 0
        flush()
        return out

    def _learn(self, h: np.ndarray, words: list[bytes]) -> None:
        got = self._encode(words)
        counts = np.fromiter(map(len, got), np.int32, len(got))
        total = int(counts.sum())
        while self.words + len(h) > len(self.start):
            self.start, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(got), np.int32, total)
        new = slice(self.words, self.words + len(h))
        self.count[new] = counts
        self.start[new] = self.used + np.cumsum(counts) - counts
        self._place(h, np.arange(self.words, self.words + len(h), dtype=np.int32))
        self.words += len(h)
        self.used += total

    def numbers(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words, and the first word of each text."""
        starts, ends = runs(~IS_SPACE[data], off)
        h = word_hashes(data, starts, ends)
        found = self._find(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            distinct, first, back = np.unique(h[new], return_index=True, return_inverse=True)
            if self.words and (self.words + len(distinct) > MOST_WORDS or self.used > MOST_IDS):
                self.clear()
                return self.numbers(data, off)
            at = new[first]
            base = self.words
            raw = data.tobytes()
            self._learn(distinct, [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            found[new] = base + back.astype(np.int32)
        return found, bounds(starts, off)

    def lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Number of tokens of each text."""
        numbers, first = self.numbers(data, off)
        return sums(self.count[numbers], first)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the offsets of the texts in them."""
        numbers, first = self.numbers(data, off)
        counts = self.count[numbers].astype(np.int64)
        ids = self.ids[ragged(self.start[numbers], counts)]
        ends = np.zeros(len(first), np.int64)
        np.cumsum(sums(counts, first), out=ends[1:])
        return ids, ends


_ENCODERS: dict[str, WordEncoder] = {}
HELD.append(_ENCODERS)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder; a worker that is used again keeps its words."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
