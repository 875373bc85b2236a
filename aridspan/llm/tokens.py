"""Token ids by a public tokenizer file, cached by word.

The tokenizer used for packing lower-cases, drops white space and never joins across it, so the ids of a
text are those of its words one after another. Words of Latin letters go straight to the vocabulary's
merges; all others go through the whole tokenizer. Each worker remembers a bounded number of short words.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache

from aridspan.llm.common import Recent

#: Letters whose normal form is one character, the same in every library.
LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
MARKS = b".,;:!?"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """The file's place among the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(Recent):
    """The ids of a word (bytes) as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        super().__init__(150_000)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.table = byte_letters()

    def make(self, word: bytes) -> bytes:
        core = word.rstrip(MARKS)
        low = core.decode().lower()
        if not LETTERS.fullmatch(low):
            return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        ids = self.get(core) or self.old.get(core)
        if ids is None:
            pieces = self.model.tokenize(low if low.isascii() else low.encode().decode("latin-1").translate(self.table))
            ids = array("I", [p.id for p in pieces]).tobytes()
        return ids if core == word else ids + self[word[len(core) :]]


@cache
def loaded(path: str) -> WordIds:
    return WordIds(path)


def encode_block(texts: list[bytes | None], path: str) -> list[bytes]:
    """The ids of each text (null: none). Only a text that may hold a special token keeps its capitals."""
    known = loaded(path)
    words = (t.split() if b"<|" in t else t.lower().split() for t in (t or b"" for t in texts))
    return [b"".join(map(known.__getitem__, ws)) for ws in words]
