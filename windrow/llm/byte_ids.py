"""Token ids of whole texts by byte-level vocabularies of the ``tokenizers`` library, the parts of a text encoded once per worker.

Byte-level vocabularies split a text before merging, and never between a character that is no white space and a space after it, or
between white space and a single space before a word. Texts are cut at such spaces, and distinct parts encoded by the library. Files
whose normaliser, split or added tokens are of another kind, and texts with an added token, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterable

from windrow.llm.word_ids import _byte_letters

_WORKER: dict[str, "ByteIds"] = {}


def worker_ids(path: str) -> "ByteIds":
    """The encoder of this Python worker; its parts stay known from task to task."""
    if path not in _WORKER:
        _WORKER[path] = ByteIds(path)
    return _WORKER[path]


def _merger(model: dict) -> Callable[[str], list[int]] | None:
    """A faster way to the ids of a text that the split leaves whole, where the file's merges go by the order of their results' ids, as ranks do."""
    import tiktoken

    byte = {c: b for b, c in _byte_letters().items()}
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    results = [vocab.get(a + b) for a, b in merges]
    singles = sorted(vocab[c] for c in byte if c in vocab)
    if len(singles) < 256 or None in results or [*singles, *results] != sorted({*singles, *results}):
        return None
    made = {c: vocab[c] for c in byte} | {a + b: i for (a, b), i in zip(merges, results, strict=True)}
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks={bytes(byte[c] for c in w): i for w, i in made.items()}, special_tokens={}).encode_ordinary


class ByteIds:
    #: Parts kept at a time, and the longest that is kept: bounds of memory, not of results.
    MOST, LONGEST = 1_000_000, 100
    #: A space within white space, at which no text may be cut, and spaces at which any may.
    INSIDE, CUT = re.compile(r"\s \s|\s \Z"), re.compile(r"(?<!\s) | (?=\S)")

    #: A word of Latin letters, and marks behind it, which any byte-level split parts from it and keeps together.
    WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        split = kind.get("pre_tokenizer") or {}
        self.cuts = (
            kind.get("normalizer") is None
            and kind.get("truncation") is None
            and (split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True)) == ("ByteLevel", False, True)
            and not (kind["model"].get("dropout") or kind["model"].get("continuing_subword_prefix") or kind["model"].get("end_of_word_suffix"))
        )
        added = [t["content"] for t in kind.get("added_tokens", [])]
        self.cuts = self.cuts and not any(t[k] for t in kind.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.words = _merger(kind["model"]) if self.cuts else None

    def _library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def packed(self, texts: Iterable[str | None]) -> Iterable[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        known = self.known
        for text in texts:
            if not text:
                yield b""
            elif not self.cuts or (self.special and self.special.search(text)):
                yield self._library(text)
            else:
                first, *rest = self.CUT.split(text) if self.INSIDE.search(text) else text.split(" ")
                head = self._library(first) if first else b""
                yield head + b"".join(map(self._knowing(rest).__getitem__, rest))

    def _knowing(self, parts: list[str]) -> dict[str, bytes]:
        """What is known, with the ids of each of ``parts`` and the space before it."""
        known = self.known
        new = set(parts).difference(known)
        if len(known) + len(new) > self.MOST:
            known.clear()
            new = set(parts)
        long = {p: self._word(p) for p in new if len(p) > self.LONGEST}
        known.update((p, self._word(p)) for p in new if len(p) <= self.LONGEST)
        return {**{p: known[p] for p in set(parts).difference(long)}, **long} if long else known

    def _word(self, p: str) -> bytes:
        """The ids of a part and the space before it; words of Latin letters take a shorter way to the same ids."""
        hit = self.WORD.fullmatch(p)
        if not hit or not self.words or len(p) > self.LONGEST:
            return self._library(f" {p}")
        word, marks = hit.groups()
        ids = self.marks.get(marks)
        if ids is None:
            ids = self._library(marks)
            if len(self.marks) < self.MOST:
                self.marks[marks] = ids
        own = self.known.get(word) if marks else None
        if own is None:
            own = array("I", self.words(f" {word}")).tobytes()
        return own + ids
