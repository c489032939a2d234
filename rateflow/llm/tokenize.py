"""Token ids of whole texts for the lower-casing BPE vocabulary ``word_bpe_49k.json``.

The vocabulary's rules split a text at white space and never look across it, so ids are
looked up word by word: each worker keeps bounded caches from the bytes of a word and of
its pieces (letters, punctuation) to ids, and asks the tokenizers library only for pieces
that it hasn't met. Those are encoded many at a time; every piece ends in a token that
ends a word, and the count of such tokens shows whether each was one piece to the library.
Where it was not, and for texts with characters that lower-casing or normalising could change
together with their neighbours, each is encoded on its own.

How a text is cut follows from the text alone, and pieces and whole words have caches of their
own, so ids don't depend on what a worker has met before.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np

# Pieces of a lower-cased text as the vocabulary's own rules cut it. Bytes of other
# characters count as letters in the second pattern, which holds for a piece that is all
# letters; the third keeps every word with other characters whole.
# Letters, which are most, are tried first; no other rule begins with one.
_ASCII = re.compile(rb"[a-z]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\sa-z0-9]+")
_LETTERS = re.compile(rb"[a-z\x80-\xff]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\sa-z0-9\x80-\xff]+")
_WORDS = re.compile(rb"[^\s\x80-\xff]*[\x80-\xff]\S*|'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9\x80-\xff]+")
# Lead bytes of the combining marks U+0300 to U+036F, and U+0130, whose lower case has such a mark:
# with them, lower-casing first could change how a text is normalised. Control characters but
# blanks are dropped or kept by the library's own rules.
_MARKS = re.compile(rb"[\xcc\xcd]|\xc4\xb0")
_ASCII_BYTES = bytes(range(128))
_CONTROLS = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f]")
_ID = np.dtype("<u4")


class WordEncoder:
    """encode(text bytes) -> ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache_size: int = 300_000, batch: int = 256):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.cache_size, self.batch = cache_size, batch
        self.ids: dict[bytes, bytes] = {}  # of pieces
        self.words: dict[bytes, bytes] = {}  # of words that are encoded whole

    def _one(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, _ID).tobytes()

    def _plain(self, pieces: list[bytes]) -> None:
        """Pieces that should be one word each to the library."""
        into = self.ids
        for i in range(0, len(pieces), self.batch):
            part = pieces[i: i + self.batch]
            ids = np.array(self.tokenizer.encode_batch_fast(
                [b" ".join(part).decode("utf-8", "replace")], add_special_tokens=False)[0].ids, _ID)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                into.update((p, self._one(p)) for p in part)
                continue
            raw, at = ids.tobytes(), (cuts * 4).tolist()
            into.update((p, raw[a:b]) for p, a, b in zip(part, [0, *at], at))

    def _cut(self, text: bytes) -> tuple[list[bytes] | None, bool]:
        """Pieces of the text; words, if it has other characters beyond ASCII than letters (True);
        None if it has to be encoded as a whole."""
        if b"<|" in text or _CONTROLS.search(text):
            return None, False  # may begin a special token
        if text.isascii():
            return _ASCII.findall(text.lower()), False
        if _MARKS.search(text):
            return None, False
        lower = text.lower()
        beyond = lower.translate(None, _ASCII_BYTES).decode("utf-8", "replace")
        return (_LETTERS.findall(lower), False) if beyond.isalpha() else (_WORDS.findall(lower), True)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.ids) + len(self.words) > self.cache_size:
            self.ids, self.words = {}, {}
        ids, words = self.ids, self.words
        cut = [self._cut(t) for t in texts]
        get = ids.__getitem__
        done: list[bytes | None] = []
        new: set[bytes] = set()
        for pieces, whole in cut:
            done.append(None)
            if whole:
                for p in set(pieces):
                    if p.isascii():
                        new.add(p)
                    elif p not in words:
                        words[p] = self._one(p)
            elif pieces is not None:
                try:
                    done[-1] = b"".join(map(get, pieces))
                except KeyError:
                    new.update(pieces)
        self._plain([p for p in new if p not in ids])

        def joined(text: bytes, pieces: list[bytes] | None, whole: bool) -> bytes:
            if pieces is None:
                return self._one(text)
            if whole:
                return b"".join(ids[p] if p.isascii() else words[p] for p in pieces)
            return b"".join(map(get, pieces))

        return [joined(t, *c) if d is None else d for t, c, d in zip(texts, cut, done)]


@cache
def encoder(path: str) -> WordEncoder:
    """One for each Python worker, which runs many tasks."""
    return WordEncoder(path)
