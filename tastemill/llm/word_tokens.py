"""Encoding of texts with a vocabulary file whose pre-tokens never cross white space, one distinct word at a time."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np

#: Words held in memory by a worker are at most twice as many; the older half is dropped.
WORDS_HELD = 300_000
#: Letters whose normal form and lower case are the plain ones, then marks that are neither letter, digit nor
#: apostrophe: such a word is one pre-token of letters and at most one of marks.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*+)([!-&(-/:-@\[-`{-~]*+)")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: visible Latin-1 as it is, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class _Words(dict):
    """Ids of words as bytes; a missing word is encoded, or taken from the older half."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(self) >= WORDS_HELD:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    """bytes of a text -> bytes of its ids, as ``encode(text, add_special_tokens=False)`` gives them.

    Only for vocabularies that drop white space before the merges; then words can be encoded one by one. Plain words
    go straight to the file's merges, all others through the whole of its steps.
    """

    def __init__(self, path: str):
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        self.merge = self.whole.model.tokenize
        self.code = "H" if self.whole.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype(self.code).newbyteorder("<")
        self.letters = _byte_letters()
        self.words = _Words(self._word)
        self.marks: dict[str, list[int]] = {}

    def _pre_token(self, token: str) -> list[int]:
        if not token.isascii():
            token = token.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.merge(token)]

    def _word(self, raw: bytes) -> bytes:
        if raw.isalpha():  # ASCII letters only
            return array(self.code, [t.id for t in self.merge(raw.lower().decode())]).tobytes()
        word = raw.decode()
        plain = _PLAIN.fullmatch(word)
        if plain is None or "<|" in word:
            ids = self.whole.encode(word, add_special_tokens=False).ids
        else:
            letters, marks = plain.groups()
            ids = self._pre_token(letters.lower()) if letters else []
            if marks:
                if marks not in self.marks:
                    if len(self.marks) > WORDS_HELD:
                        self.marks.clear()
                    self.marks[marks] = self._pre_token(marks)
                ids = ids + self.marks[marks]
        return array(self.code, ids).tobytes()

    def __call__(self, text: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, text.split()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)
