"""Token ids by the ``tokenizers`` library, with a bounded cache of words.

Where a text may be cut without changing its ids, the pieces between cuts
are encoded once per worker and looked up after that; other texts are
encoded whole. Most pieces are letters with punctuation behind: how the
tokenizers split these is plain, so they go to the tokenizer's model
directly, without its normaliser and pre-tokenizer, which cost several times
as much. All ways give the ids of one call on the whole text.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np

#: White space before a space: there a cut could change a byte-level tokenizer's ids.
_RUN = re.compile(r" (?<=\s )")  # looks at the spaces only
#: Letters that every Unicode version knows, then punctuation (no apostrophe: contractions).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()
_SPACE = _BYTE_LETTERS[32]


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=4)
def encoder(path: str, drops_space: bool) -> Encoder:
    """The worker process's encoder: its cache lasts from task to task."""
    return Encoder(path, drops_space)


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes.

    drops_space: the tokenizer drops white space, so every space may be cut
    at; otherwise (byte-level) a cut before a space that follows a word.
    cache_words bounds the cache; it is emptied when full.
    """

    def __init__(self, path: str, drops_space: bool, cache_words: int = 600_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A text that holds the string of an added token is encoded whole: the library cuts it there.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = os.path.commonprefix(self.added)
        self.model = self.tokenizer.model  # the attribute makes a new object each time
        self.drops_space, self.cache_words = drops_space, cache_words
        #: what stands between two spaces -> its ids, with the space before it where the tokenizer keeps it
        self.cache: dict[str, bytes] = {}
        self.space = "" if drops_space else " "
        #: ids of punctuation behind a word; there are few kinds
        self.marks = lru_cache(maxsize=4096)(self._model_ids)

    def _fill(self, pieces: set[str]) -> None:
        new = pieces.difference(self.cache)
        if len(self.cache) + len(new) > self.cache_words:
            self.cache = {p: self.cache[p] for p in pieces if p in self.cache}
        other = []
        for piece in new:
            plain = _PLAIN.fullmatch(piece)
            if plain:
                letters, marks = plain.groups()
                word = self.cache.get(letters)  # the word without punctuation is a piece, too
                if word is None:
                    word = self.cache[letters] = self._model_ids(self.space + letters)
                if marks:
                    self.cache[piece] = word + self.marks(marks)
            else:
                other.append(piece)
        for i in range(0, len(other), 10_000):
            part = other[i:i + 10_000]
            for piece, enc in zip(part, self.tokenizer.encode_batch_fast(
                    [self.space + p for p in part], add_special_tokens=False)):
                self.cache[piece] = _bytes(enc.ids)

    def _model_ids(self, word: str) -> bytes:
        if self.drops_space:
            word = word.lower()
        if not word.isascii():
            word = "".join(map(_BYTE_LETTERS.__getitem__, word.encode()))
        elif word[0] == " ":  # of the ASCII characters in a plain word only the space has another letter
            word = _SPACE + word[1:]
        return _bytes([token.id for token in self.model.tokenize(word)])

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _can_be_cut(self, text: str) -> bool:
        if self.added and self.mark in text and any(a in text for a in self.added):
            return False
        return self.drops_space or not _RUN.search(text) and not text[0].isspace()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cuts = [t.split(" ") if t and self._can_be_cut(t) else None for t in texts]
        # A byte-level text's first piece has no space before it.
        heads = [b"" if self.drops_space or c is None else self._whole(c.pop(0)) for c in cuts]
        self._fill(set().union(*(c for c in cuts if c)))
        get = self.cache.__getitem__
        return [(self._whole(t) if t else b"") if c is None else head + b"".join(map(get, c))
                for t, c, head in zip(texts, cuts, heads)]


def public_path(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
