"""Token ids of whole texts with a public tokenizer, one small dictionary per Python worker."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS_KEPT = 300_000   # entries of a worker's dictionary before it starts anew; only speed depends on it
LONG_CHUNK = 80

# What the tokenizer does to a chunk between white space, for plain letters; other chunks go to it whole.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
ODD_SPACE = re.compile("[\x1c-\x1f]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Chunks(dict):
    """Chunk between white space -> its ids as little-endian uint32 bytes."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.model, self.words, self.letters = tokenizer, tokenizer.model, {}, _byte_letters()

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > LONG_CHUNK or "<|" in chunk or not PLAIN.fullmatch(chunk):
            out = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
        else:
            out = b"".join([self.words.get(w) or self._word(w) for w in SPLIT.findall(chunk.lower())])
        if len(self) >= WORDS_KEPT:
            self.clear()
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = out
        return out

    def _word(self, word: str) -> bytes:
        text = "".join([self.letters[b] for b in word.encode()])
        out = np.array([t.id for t in self.model.tokenize(text)], dtype="<u4").tobytes()
        if len(self.words) >= WORDS_KEPT:
            self.words.clear()
        self.words[word] = out
        return out


def encoder(path: str, plain_specials: bool = False) -> Callable[[str | None], bytes]:
    """Text -> token ids as little-endian uint32 bytes; NULL has none.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its
    chunks in turn. `plain_specials` reads the special tokens' strings as ordinary text.
    """
    from tokenizers import Tokenizer

    # functions that travel by value have no lasting globals; a worker serves many tasks
    held = sys.__dict__.setdefault("_orograd_tokens", {})
    if (path, plain_specials) not in held:
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = plain_specials
        held[path, plain_specials] = _Chunks(t)
    chunks = held[path, plain_specials]

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if ODD_SPACE.search(text):  # white space to Python alone
            return np.array(chunks.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(chunks.__getitem__, text.split()))

    return encode
