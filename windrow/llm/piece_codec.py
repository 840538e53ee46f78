"""SentencePiece (merge type) encoding by backtracking, and decoding.

The encoding of a text under merges is the one sequence of pieces in which every adjacent pair is
compatible: merging the pair's text afresh gives that pair again. So instead of simulating all merges,

* an Aho-Corasick automaton over the reachable pieces gives all pieces that start at each position;
* the longest goes first, if it is compatible with the piece before it (re-merged once, then remembered);
* a position from which nothing led on is marked in a bitfield and never tried again.

No piece of the supported models holds a space mark after another character, so a text's encoding
is that of its space-led words in order, and each worker encodes a distinct word once.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_WORKER: dict[str, "PieceCodec"] = {}


def worker_codec(path: str) -> "PieceCodec":
    """The codec of this Python worker; its words stay known from task to task."""
    if path not in _WORKER:
        _WORKER[path] = PieceCodec(path)
    return _WORKER[path]


class PieceCodec:
    #: Words kept at a time; a bound of memory, not of results.
    MOST = 400_000

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        pieces = [(p.piece, p.score, p.type) for p in model.pieces]
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == _NORMAL}
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only merge models with an identity normaliser and a dummy prefix are supported")
        if {kind for _, _, kind in pieces} - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("user-defined pieces, unused pieces, and marks within a piece are not supported")
        self.score = {p: pieces[i][1] for p, i in self.ids.items()}
        self.pieces = [p for p, _, _ in pieces]
        self.kinds = [kind for _, _, kind in pieces]
        self.byte_ids = [0] * 256
        self.byte_of: dict[int, int] = {}
        for i, (p, _, kind) in enumerate(pieces):
            if kind == _BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
                self.byte_of[i] = int(p[1:-1], 16)
        if len(self.byte_of) != 256:
            raise ValueError("only models with byte fallback are supported")
        reachable = [p for p in self.ids if self.merge(p) == [p]]
        self.chars = {p for p in reachable if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p in reachable:
            self.automaton.add_word(p, self.ids[p])
        self.automaton.make_automaton()
        self.plain = set(self.ids.values())
        self.size = [len(p) for p in self.pieces]
        self.pairs: dict[int, bool] = {}
        self.ids_of: dict[str, bytes] = {}
        self.text_of: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of ``text`` by merging the best scored adjacent pair, leftmost first, until none is a piece."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            if both in self.score:
                heapq.heappush(heap, (-self.score[both], i, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def _fits(self, a: int, b: int) -> bool:
        fit = self.pairs.get(a << 32 | b)
        if fit is None:
            if len(self.pairs) > 4 * self.MOST:
                self.pairs.clear()
            one, two = self.pieces[a], self.pieces[b]
            fit = self.pairs[a << 32 | b] = self.merge(one + two) == [one, two]
        return fit

    def backtrack(self, text: str) -> list[int]:
        """The ids of ``text``, all of whose characters are pieces."""
        greedy = [i for _, i in self.automaton.iter_long(text)]
        # nothing to go back on where the longest matches cover the text and fit one another
        if sum([self.size[i] for i in greedy]) == len(text) and all(map(self._fits, greedy, greedy[1:])):
            return greedy
        starts: list[list[int]] = [[] for _ in text]
        for end, i in self.automaton.iter(text):
            starts[end + 1 - self.size[i]].append(i)  # shorter ones come first or, for equal ends, last
        for s in starts:
            s.sort(key=self.size.__getitem__)
        n, at, dead = len(text), 0, bytearray(len(text) + 1)
        done: list[tuple[int, int]] = []  # ids, and how many shorter ones are left to try there
        left = len(starts[0])
        while at < n:
            last = done[-1][0] if done else None
            while left:
                left -= 1
                i = starts[at][left]
                if not dead[at + self.size[i]] and (last is None or self._fits(last, i)):
                    done.append((i, left))
                    at += self.size[i]
                    left = len(starts[at]) if at < n else 0
                    break
            else:
                dead[at] = 1
                i, left = done.pop()
                at -= self.size[i]
        return [i for i, _ in done]

    def _word_ids(self, word: str) -> list[int]:
        """The ids of a stretch of text in which no space mark follows another character."""
        if self.chars.issuperset(word):
            return self.backtrack(word)
        out, run = [], ""
        for c in word:
            if c in self.chars:
                run += c
                continue
            if run:
                out += self.backtrack(run)
                run = ""
            out += [self.byte_ids[b] for b in c.encode("utf-8", "replace")]
        return out + (self.backtrack(run) if run else [])

    #: Space marks and what follows them.
    _WORDS = re.compile(f"{MARK}+[^{MARK}]*")

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        return [i for w in self._WORDS.findall(MARK + text.replace(" ", MARK)) for i in self._word_ids(w)]

    def decode(self, ids: list[int]) -> str:
        if self.plain.issuperset(ids):
            text = "".join(map(self.pieces.__getitem__, ids))
            return (text[1:] if text[:1] == MARK else text).replace(MARK, " ")
        out, raw, bare = [], bytearray(), True
        for i in [*ids, None]:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(_characters(bytes(raw)))
                raw.clear()
                bare = False
            if i is None or self.kinds[i] == _CONTROL:
                continue
            if self.kinds[i] == _UNKNOWN:
                out.append(" ⁇ ")
            else:
                piece = self.pieces[i]
                out.append((piece[1:] if bare and piece.startswith(MARK) else piece).replace(MARK, " "))
            bare = False
        return "".join(out)

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """The number of ids of a text, the digest of the ids, and that of the decoded text."""
        if not text:
            return 0, _EMPTY, _EMPTY
        words = self._keys(text)
        try:
            ids = b",".join(map(self.ids_of.__getitem__, words))
        except KeyError:
            if len(self.ids_of) > self.MOST:
                self.ids_of.clear()
                self.text_of.clear()
            for w in words:
                if w not in self.ids_of:
                    self._learn(w)
            ids = b",".join(map(self.ids_of.__getitem__, words))
        decoded = b"".join(map(self.text_of.__getitem__, words))[1:]
        return ids.count(b",") + 1, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    def _keys(self, text: str) -> list[str]:
        """The stretches of a text: one that opens with a mark or a line end as it is, one led by a lone mark without it."""
        if "  " in text or " \n" in text or MARK in text or text[0] in " \n":
            return [w[1:] if w[1:2] not in (MARK, "\n") else w for w in self._WORDS.findall(MARK + text.replace(" ", MARK))]
        return text.replace("\n", " \n").split(" ")

    def _learn(self, key: str) -> None:
        ids = self._word_ids(key if key[:1] in (MARK, "\n") else MARK + key)
        self.ids_of[key] = ",".join(map(str, ids)).encode()
        # a mark of its own is put before and dropped again, as the decoder drops only the first of a text
        self.text_of[key] = self.decode([self.ids[MARK], *ids]).encode()


_EMPTY = hashlib.sha256(b"").hexdigest()


def _characters(raw: bytes) -> str:
    """UTF-8, each byte that is no part of a character as U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each row; a null or empty text has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(model)
        for batch in batches:
            ids = [codec.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of each row of (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(model)
        for batch in batches:
            texts = [codec.decode(i.as_py() or []) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def digest_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: each text encoded whole, and decoded again.

    Null texts count as empty (no ids). Null ids and repeated rows give a row each; no shuffle takes place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(model)
        for batch in batches:
            rows = [codec.digest(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
