"""Token ids of whole texts, with a bounded per-worker memo of words.

The tokenizer drops white space and never merges across it, so a text's ids are the ids of its
white-space separated words, one after the other. Only words not seen before reach the tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

MEMO_WORDS = 300_000
BLOCK = 1 << 20
SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
#: Punctuation that, standing last in a word after a letter or digit, is a token run of its own.
TAIL = b",.;:!?$&%*#"


def byte_symbols() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Memo(dict):
    """Ids of words, made when first asked for; what an older memo knew is taken over."""

    def __init__(self, make, older: dict[bytes, bytes]):
        super().__init__()
        self.make, self.older = make, older

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.older.get(word) or self.make(word)
        return ids


class WordIds:
    """encode_all(texts) -> little-endian uint32 ids, as bytes; equal to encoding the whole texts.

    Words of Latin-1 letters go straight to the vocabulary's merge model: they are in normal form, so only
    lower case and the byte alphabet are left to do. Other words go through the whole tokenizer. The memo
    has two generations, so its size is bounded and frequent words stay.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.words = Memo(self._ids, {})
        self.tails: dict[bytes, bytes] = {b"": b""}

    def _whole(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _letters(self, text: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(text)])

    def _ids(self, word: bytes) -> bytes:
        core = word.rstrip(TAIL)
        tail = word[len(core) :]
        if core.isalpha():
            ids = self._letters(core.lower().decode())
        elif core and (text := core.decode()).isalpha() and max(text) <= "\u00ff":
            ids = self._letters("".join([self.symbols[b] for b in text.lower().encode()]))
        else:
            return self._whole(word)
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {b"": b""}
            self.tails[tail] = self._whole(tail)
        return ids + self.tails[tail]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for text in texts:
            parts = []
            for block in blocks(text):
                if len(self.words) > MEMO_WORDS:
                    self.words.older = {}
                    self.words = Memo(self._ids, self.words)
                parts.append(b"".join(map(self.words.__getitem__, block.split())))
            out.append(parts[0] if len(parts) == 1 else b"".join(parts))
        return out


def blocks(text: bytes) -> Iterator[bytes]:
    """A text in parts of about BLOCK bytes that end at white space."""
    at = 0
    while len(text) - at > BLOCK and (space := SPACE.search(text, at + BLOCK)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:] if at else text


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This worker's encoder for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
