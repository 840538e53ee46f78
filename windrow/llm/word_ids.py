"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once per worker.

The tokenizers used here drop white space and never join across it, so a text's ids are those of its
ASCII-space separated words in order. Words wholly of letters, or of printable ASCII, are lower-cased here, skip the library's normaliser and go
straight to its BPE model; all others take the library's whole path.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterable

_WORKER: dict[str, "WordIds"] = {}


def worker_ids(path: str) -> "WordIds":
    """The encoder of this Python worker; its words stay known from task to task."""
    if path not in _WORKER:
        _WORKER[path] = WordIds(path)
    return _WORKER[path]


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    #: Words kept at a time; a bound of memory, not of results.
    MOST = 200_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}
        #: The vocabulary's own split, as it reads on lower-case printable ASCII.
        self.ascii_parts = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall

    def _letters_only(self, word: str) -> list[int] | None:
        if word.isascii():
            return [t.id for t in self.model.tokenize(word.lower())]
        if unicodedata.is_normalized("NFC", word) and word.lower() == word:
            return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]
        return None

    def _encode(self, raw: bytes) -> bytes:
        word = raw.decode()
        ids = None
        if word.isalpha():
            ids = self._letters_only(word)
        elif word.isascii() and word.isprintable() and "<|" not in word:
            ids = [t.id for part in self.ascii_parts(word.lower()) for t in self.model.tokenize(part)]
        if ids is None:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def packed(self, texts: Iterable[str | None]) -> Iterable[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        known = self.known
        for text in texts:
            if not text:
                yield b""
                continue
            raw = text.encode("utf-8", "replace")
            # only ASCII letters: the tokenizer lower-cases anyway, and special tokens are told from their case
            words = (raw if b"<|" in raw else raw.lower()).split()
            try:
                yield b"".join(map(known.__getitem__, words))
            except KeyError:
                if len(known) > self.MOST:
                    known.clear()
                for w in words:
                    if w not in known:
                        known[w] = self._encode(w)
                yield b"".join(map(known.__getitem__, words))
