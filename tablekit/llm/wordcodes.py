"""Token ids of whole texts with a per-worker memory of words already seen.

The tokenizer (a ``tokenizers`` JSON file) works word by word: white space
never lies inside a token, and neither its normaliser nor its pattern looks
across an ASCII blank.  So a text's ids are the ids of its blank-separated
words in order, and each distinct word is encoded once per Python worker.
Memories are bounded by ``MEMORY`` words; beyond that, words are encoded
again each time, with the same result.
"""

from __future__ import annotations

import re

import numpy as np

MEMORY = 400_000

# ASCII and the accented Latin letters that normalisation only lower-cases
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_PIECES = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
_open: dict[str, "WordCodes"] = {}


def codes_for(path: str) -> "WordCodes":
    """This worker's encoder of the tokenizer file at ``path``."""
    if path not in _open:
        _open[path] = WordCodes(path)
    return _open[path]


class WordCodes:
    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        kept = list(range(0x21, 0x7F)) + list(range(0xA1, 0xAD)) + list(range(0xAE, 0x100))
        shifted = iter(range(256, 512))
        # the byte-level alphabet: printable bytes stand for themselves, others follow from 256 on
        self.alphabet = "".join(chr(b) if b in kept else chr(next(shifted)) for b in range(256))

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        code = self.pieces.get(piece)
        if code is None:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
            code = np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], dtype="<u4").tobytes()
            if len(self.pieces) < MEMORY:
                self.pieces[piece] = code
        return code

    def _word(self, word: str, plain: bool) -> bytes:
        if plain and "<|" not in word:
            code = b"".join(map(self._piece, _PIECES.findall(word)))
        else:
            code = self._whole(word)
        if len(self.words) < MEMORY:
            self.words[word] = code
        return code

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        plain = _PLAIN.fullmatch(text) is not None and "<|" not in text
        if not plain:
            # other scripts and special-token strings: the tokenizer itself, on the whole text
            return self._whole(text)
        words = text.lower().split()
        codes = list(map(self.words.get, words))
        if None in codes:
            codes = [self._word(w, True) if c is None else c for w, c in zip(words, codes)]
        return b"".join(codes)
