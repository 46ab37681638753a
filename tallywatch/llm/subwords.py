"""SentencePiece-style encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Spaces become the marker U+2581 and one stands before the text. The segmentation with the highest sum of log scores
is chosen, by dynamic programming over the trie; of equal ones, that whose last piece starts first, at every end. A
character that no piece covers falls back to the pieces of its UTF-8 bytes. Pieces hold the marker only at their front,
so words (a marker run and what follows, cut again behind letters if no piece goes on from letters to other characters) are segmented alone
and kept; a vocabulary with other pieces is applied to whole texts.

A BPE vocabulary has merge ranks and no probabilities: its pieces get the log scores of a Zipf-Mandelbrot law over
their ranks, unless scores are given. Null and empty texts give no pieces. A text's own U+2581 decodes to a space.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import texts_of

MARK = "▁"
#: Latin letters, as a range of characters.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Words that a worker keeps, the longest of them, and what an uncovered character costs below the lowest score.
KEPT, KEPT_LENGTH, UNKNOWN = 1_000_000, 48, 10.0


class DoubleArray:
    """A trie over bytes in two arrays: a child by byte b of node s is base[s] + b + 1 if check there is s."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value
        self._lists = (base.tolist(), check.tolist(), value.tolist())

    def __reduce__(self):
        return DoubleArray, (self.base, self.check, self.value)

    @classmethod
    def build(cls, keys: dict[bytes, int]) -> DoubleArray:
        tree: dict = {}
        for key, number in keys.items():
            node = tree
            for b in key:
                node = node.setdefault(b, {})
            node[-1] = number
        base, check, value = [0], [0], [-1]
        todo, free, later = [(0, tree)], 257, 257  # cells from 257 to `free` are taken; nodes of several children go on from `later`
        while todo:
            state, node = todo.pop()
            value[state] = node.get(-1, -1)
            children = sorted(b for b in node if b >= 0)
            if not children:
                continue
            start = max((free if len(children) == 1 else max(free, later)) - children[0] - 1, 0)
            while True:
                top = start + children[-1] + 2
                if top > len(check):
                    grow = top - len(check) + 256
                    base += [0] * grow
                    check += [-1] * grow
                    value += [-1] * grow
                if all(check[start + b + 1] < 0 for b in children):
                    break
                start += 1
            base[state] = start
            if len(children) > 1:
                later = start + children[0] + 1
            for b in children:
                check[start + b + 1] = state
                todo.append((start + b + 1, node[b]))
            while free < len(check) and check[free] >= 0:
                free += 1
        return cls(*(np.array(x, np.int32) for x in (base, check, value)))

    def prefixes(self, key: bytes, at: int) -> Iterator[tuple[int, int]]:
        """(end, number) of the keys that key[at:] starts with, shortest first."""
        base, check, value = self._lists
        state, n = 0, len(check)
        for i in range(at, len(key)):
            child = base[state] + key[i] + 1
            if child >= n or check[child] != state or not child:
                return
            state = child
            if value[state] >= 0:
                yield i + 1, value[state]


class Unigram:
    """Pieces with log scores; `byte` are the ids of the 256 byte pieces."""

    def __init__(self, pieces: list[str], scores: list[float], normal: list[int], byte: list[int]):
        self.pieces, self.scores, self.normal, self.byte = pieces, scores, normal, byte
        self.trie = DoubleArray.build({pieces[i].encode(): i for i in normal if pieces[i]})
        # In steps of 2^-32, so that sums of the same scores are equal in any order.
        self.steps = [round(x * 2.0**32) for x in scores]
        self.lowest = min((self.steps[i] for i in normal), default=0) - round(UNKNOWN * 2.0**32)
        self.alone = not any(MARK in pieces[i].lstrip(MARK) for i in normal)
        of_byte = {i: bytes([b]) for b, i in enumerate(byte)}
        plain = set(normal)
        self.surface = [of_byte.get(i) or (p.replace(MARK, " ").encode() if i in plain else b"") for i, p in enumerate(pieces)]
        self._words: dict[str, bytes] = {}
        # Words start at a marker, and are cut behind letters where no piece goes on from a letter to another kind.
        further = any(re.search(f"[{LETTERS}][^{LETTERS}{MARK}]", pieces[i]) for i in normal)
        self.cuts = re.compile(
            f"{MARK}+[^{MARK}]*|[^{MARK}]+" if further else
            f"{MARK}+[^{LETTERS}{MARK}]*[{LETTERS}]*|[^{LETTERS}{MARK}]+[{LETTERS}]*|[{LETTERS}]+")

    def __reduce__(self):
        return Unigram, (self.pieces, self.scores, self.normal, self.byte)

    @classmethod
    def load(cls, path: str, scores: list[float] | None = None) -> Unigram:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if scores is None:
            scores = [0.0] * n
            for rank, i in enumerate(normal):
                scores[i] = -math.log(rank + 2.7)
        return cls([model.id_to_piece(i) for i in range(n)], scores, normal, [byte[b] for b in range(256)])

    def segment(self, marked: str) -> list[int]:
        """Ids of the best segmentation of a text with markers."""
        key = marked.encode()
        n = len(key)
        base, check, value = self.trie._lists
        steps, cells = self.steps, len(check)
        best, back, used = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0
        at = 0
        while at < n:
            byte, here = key[at], best[at]
            after = at + (1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4)
            single, state, end = False, 0, at
            while end < n:
                child = base[state] + key[end] + 1
                if child >= cells or check[child] != state:
                    break
                state = child
                end += 1
                number = value[state]
                if number >= 0:
                    score = here + steps[number]
                    if score > best[end]:
                        best[end], back[end], used[end] = score, at, number
                    if end == after:
                        single = True
            if not single and here + self.lowest > best[after]:
                best[after], back[after], used[after] = here + self.lowest, at, -1
            at = after
        out: list[int] = []
        end = n
        while end:
            start, number = back[end], used[end]
            out += [number] if number >= 0 else [self.byte[b] for b in reversed(key[start:end])]
            end = start
        return out[::-1]

    def _word(self, word: str) -> bytes:
        found = self._words.get(word)
        if found is None:
            found = np.array(self.segment(word), "<u4").tobytes()
            if len(word) <= KEPT_LENGTH:
                if len(self._words) >= KEPT:
                    self._words.clear()
                self._words[word] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        marked = MARK + text.replace(" ", MARK)
        if not self.alone:
            return np.array(self.segment(marked), "<u4")
        return np.frombuffer(b"".join(map(self._word, self.cuts.findall(marked))), "<u4")

    def decode(self, ids: list[int]) -> str:
        """Byte pieces join to characters (U+FFFD where they aren't UTF-8); the first space goes."""
        return b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ").removeprefix(" ")


def encoded(docs: DataFrame, path: str | None = None, scores: list[float] | None = None) -> DataFrame:
    """doc_id, ids of every text."""
    model = docs.sparkSession.sparkContext.broadcast(Unigram.load(path or public_tokenizers.path("piece_bpe_32k.model"), scores))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [model.value.encode(t) for t in batch.column("text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, flat)], ["doc_id", "ids"])

    return texts_of(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(encode, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of every list of ids."""
    model = ids.sparkSession.sparkContext.broadcast(Unigram.load(path or public_tokenizers.path("piece_bpe_32k.model")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.value.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.select(F.col("doc_id").cast("long"), "ids").mapInArrow(decode, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_pieces, n_bytes (pieces that are single bytes), ids_crc32, decoded_sha256 of every text."""
    model = docs.sparkSession.sparkContext.broadcast(Unigram.load(path or public_tokenizers.path("piece_bpe_32k.model")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = np.zeros(len(model.value.pieces), bool)
        single[model.value.byte] = True
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                ids = model.value.encode(text)
                back = model.value.decode(ids.tolist())
                out.append((len(ids), int(single[ids].sum()), zlib.crc32(ids.tobytes()), hashlib.sha256(back.encode()).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, kinds))],
                ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "decoded_sha256"])

    schema = "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, decoded_sha256 string"
    return texts_of(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(digest, schema)
