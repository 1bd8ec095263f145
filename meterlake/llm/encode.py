"""Whole-text token ids from a public tokenizer file, a batch at a time.

The tokenizer drops white space and never joins across it, so a text's ids are
its words' ids in order; each distinct word is encoded once per worker and
kept in a cache of bounded size."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 500_000
TOKENIZER_FILE = "word_bpe_49k.json"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


class _Index(dict):
    """word -> place; a new word gets the next place and waits to be encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes a byte as itself where it prints, else as the
    next code point from 256 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in printing else chr(next(rest)) for b in range(256)}


_LETTERS = _byte_letters()


def plain_letters(word: bytes) -> str | None:
    """The word as the merge model reads it, if it is one run of lower-case
    Latin letters, which normalising and splitting leave as they are."""
    if word.isalpha():
        return word.decode() if word.islower() else None
    text = word.decode()
    if text.isalpha() and max(text) < "\u0100" and text.islower() and "\u00aa" not in text \
            and "\u00ba" not in text:
        return word.decode("latin-1").translate(_LETTERS)
    return None


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.index = _Index()
        self.counts = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode_new(self) -> None:
        words, self.index.new = self.index.new, []
        # A sign after a letter or digit is a token run of its own.
        stems = [w[:-1] if len(w) > 1 and w[-1] in b".," and w[-2:-1].isalnum() else w
                 for w in words]
        todo = dict.fromkeys([*stems, b".", b","])
        plain = {w: s for w in todo if (s := plain_letters(w))}
        for w, s in plain.items():
            todo[w] = [t.id for t in self.tokenizer.model.tokenize(s)]
        other = [w for w in todo if w not in plain]
        got = self.tokenizer.encode_batch_fast([w.decode() for w in other],
                                               add_special_tokens=False)
        for w, e in zip(other, got):
            todo[w] = e.ids
        ids = [todo[s] if len(s) == len(w) else todo[s] + todo[w[-1:]]
               for s, w in zip(stems, words)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        starts = len(self.flat) + np.cumsum(counts) - counts
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(counts.sum()))
        self.counts = np.concatenate([self.counts, counts])
        self.starts = np.concatenate([self.starts, starts])
        self.flat = np.concatenate([self.flat, flat])

    def places(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word places of all texts in a row, and words per text."""
        if len(self.index) > CACHE_WORDS:
            self._clear()
        at = self.index.__getitem__
        parts = []
        for t in texts:
            # Control strings are matched by case; other texts are lowered
            # here, as the tokenizer would, to meet more of the cache.
            words = ((t or b"") if b"<|" in (t or b"") else (t or b"").lower()).split()
            parts.append(np.fromiter(map(at, words), np.int64, len(words)))
        if self.index.new:
            self._encode_new()
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), n

    def lengths(self, texts: list[bytes | None]) -> np.ndarray:
        """Number of ids per text."""
        where, n = self.places(texts)
        total = np.concatenate([[0], np.cumsum(self.counts[where])]) if len(where) else np.zeros(1, np.int64)
        ends = np.cumsum(n)
        return total[ends] - total[ends - n]

    def ids(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and ids per text."""
        where, n = self.places(texts)
        if not len(where):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        counts = self.counts[where]
        ends = np.cumsum(counts)
        take = np.repeat(self.starts[where] - (ends - counts), counts) + np.arange(ends[-1])
        total = np.concatenate([[0], ends])
        upto = np.cumsum(n)
        return self.flat[take], total[upto] - total[upto - n]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file, so its cache serves all tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def slices(texts: pa.Array, max_bytes: int = 4 << 20):
    """(start, stop, texts) of runs of about ``max_bytes``, so that arrays stay
    small whatever the batch; a longer text is a run by itself."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start, size = 0, 0
    for i, n in enumerate([*sizes, max_bytes + 1]):
        if i > start and size + n > max_bytes:
            yield start, i, texts.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += n
