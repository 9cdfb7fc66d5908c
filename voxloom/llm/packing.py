"""Vector bin packing of token sequences for instruction data.

Every sequence has three limits at once: tokens, segments (pieces of examples) and loss-bearing tokens. A piece goes, by the
dot-product heuristic, to the open sequence whose free room points most in the direction of the piece's needs: the largest
scalar product of needs and room, both as shares of the limits, among those it fits. A piece that fits nowhere is cut:
the sequence with most room takes what it can and is closed, the rest goes on. What is open at the end of a partition
is packed anew with cuts, so a partition leaves little more than one partly filled sequence.

Packing needs no other rows, so every task packs the rows of its own partition in one pass: no shuffle, at most ``open``
unfinished sequences and one text in memory. Sequence numbers hold the partition number. The order of rows in a file
decides, so a task that is run again makes the same sequences.

The defaults hold 4096 tokens, 16 segments and 4000 loss-bearing tokens, so each limit closes sequences of its own: the last
96 tokens are for prompts, and short examples share a sequence with at most 15 others.

Tokens come from a public tokenizer file; its path is a parameter. The tokenizer works word by word between white space, so
a word's ids are kept in a bounded cache that serves all tasks of a worker.

Defined results: null and empty texts are one piece, the end id. Equal rows are packed each. A document longer than a
sequence is cut. ``start`` counts the ids of the document before the piece; ``offset`` is its place in the sequence.
"""

from __future__ import annotations

import os
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 2
#: Words kept with their ids per worker, in two halves: when the newer is full the older is forgotten, and a word that is met
#: again moves to the newer. Which words are kept changes no result.
CACHE_WORDS = 1_000_000
#: Letters whose lower case depends on what stands around them or has another length.
ODD_CAPITALS = frozenset("\u03a3\u0130")
#: The last letter (Cyrillic) on which all tables of letters agree; words with later ones take the whole way.
LAST_PLAIN = "\u052f"
#: Control characters that Python splits at and the tokenizer does not.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


#: Letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: Words that show whether a tokenizer treats letters in that way.
SAMPLES = ("letters", "größe", "équeelle", "niño", "слово", "語")


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 16
    loss: int = 4000

    def array(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], dtype=np.int64)


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        # asking the model itself is for tokenizers that work on lower-case letters standing for bytes
        steps = [self._tokenizer.encode(t, add_special_tokens=False).ids for t in SAMPLES]
        self._by_bytes = True
        self._by_bytes = [struct.unpack(f"<{len(x) // 4}I", x) for x in map(self._plain, SAMPLES)] == [tuple(s) for s in steps]
        self.most_words = CACHE_WORDS
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _plain(self, word: str) -> bytes:
        """A word of letters only, asked of the model itself: it is one unit, so what remains of the steps before the model
        is lower case and the letters that stand for bytes."""
        if not word.isascii():
            if max(word) > LAST_PLAIN or ODD_CAPITALS.intersection(word) or not unicodedata.is_normalized("NFC", word):
                return self._direct(word)
            word = word.lower().encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = [token.id for token in self._model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, words: Iterable[str]) -> None:
        if len(self._cache) > self.most_words // 2:
            self._older, self._cache = self._cache, {}
        cache, older = self._cache, self._older
        for word in words:
            if word in cache:
                continue
            ids = older.get(word)
            if ids is not None:
                cache[word] = ids
                continue
            core, mark = word, ""
            whole = word.isalpha()
            if not whole and word[-1] in ".," and word[:-1].isalpha() and word[-2].isascii():
                core, mark, whole = word[:-1], word[-1], True
            if whole and core.isascii():
                # only A-Z is lowered here, which the tokenizer would do as well
                core = core.lower()
            ids = cache.get(core) or older.get(core)
            if ids is None:
                ids = cache[core] = self._plain(core) if whole and self._by_bytes and core.lower().isalpha() else self._direct(core)
            if mark:
                if mark not in cache:
                    cache[mark] = self._direct(mark)
                ids += cache[mark]
            cache[word] = ids

    def encode(self, text: str) -> tuple[bytes, int]:
        """Ids with the end id, and how many of them belong to the first line where there are more lines."""
        end = END_ID.to_bytes(4, "little")
        head, line, _ = text.partition("\n")
        if any(mark in text for mark in SEPARATORS):
            return self._direct(text) + end, len(self._direct(head)) // 4 if line else 0
        words = text.split()
        cache = self._cache
        try:
            ids = b"".join([cache[word] for word in words])
        except KeyError:
            self.learn(words)
            cache = self._cache
            ids = b"".join([cache[word] for word in words])
        prompt = sum(len(cache[word]) for word in head.split()) // 4 if line else 0
        return ids + end, prompt


_loaded: dict[str, WordTokenizer] = {}


def worker_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process, so that its words serve the tasks that follow."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


@dataclass
class Piece:
    """Ids ``start`` to ``start + length`` of a document; ids from ``prompt`` on bear loss."""

    doc: object
    ids: bytes
    prompt: int
    start: int
    length: int

    def need(self) -> np.ndarray:
        return np.array([self.length, 1, self.loss(self.length)], dtype=np.int64)

    def loss(self, length: int) -> int:
        return max(0, self.start + length - max(self.start, self.prompt))

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest beginning within so many tokens and loss-bearing tokens."""
        before = max(0, self.prompt - self.start)
        return min(self.length, tokens, before + loss)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        rest = Piece(self.doc, self.ids, self.prompt, self.start + length, self.length - length)
        return Piece(self.doc, self.ids, self.prompt, self.start, length), rest


@dataclass
class Packer:
    limits: Limits
    open: int = 16
    _room: np.ndarray = field(init=False)
    _bins: list[list[Piece]] = field(init=False, default_factory=list)

    def __post_init__(self):
        self._full = self.limits.array()
        if (self._full < 1).any():
            raise ValueError("limits must be positive")
        self._room = np.zeros((0, 3), dtype=np.int64)

    def _new(self) -> int:
        self._bins.append([])
        self._room = np.vstack([self._room, self._full])
        return len(self._bins) - 1

    def _close(self, k: int) -> list[Piece]:
        self._room = np.delete(self._room, k, axis=0)
        return self._bins.pop(k)

    def _put(self, k: int, piece: Piece, need: np.ndarray) -> None:
        self._bins[k].append(piece)
        self._room[k] -= need

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Sequences that this piece completes."""
        while piece.length:
            need = piece.need()
            fits = (self._room >= need).all(axis=1) if self._bins else np.zeros(0, dtype=bool)
            if fits.any():
                product = (self._room / self._full) @ (need / self._full)
                k = int(np.where(fits, product, -1.0).argmax())
                self._put(k, piece, need)
                if self._room[k, 0] == 0:
                    yield self._close(k)
                return
            if len(self._bins) < self.open:
                k = self._new()
                if (need <= self._full).all():
                    self._put(k, piece, need)
                    return
            else:
                k = int(self._room[:, 0].argmax())
            length = piece.fitting(int(self._room[k, 0]), int(self._room[k, 2])) if self._room[k, 1] else 0
            if length:
                first, piece = piece.cut(length)
                self._put(k, first, first.need())
            yield self._close(k)

    def finish(self) -> Iterator[list[Piece]]:
        """The open sequences, packed anew one after another."""
        pieces = sorted((p for b in self._bins for p in b), key=lambda p: -p.length)
        last = Packer(self.limits, open=1)
        for piece in pieces:
            yield from last.add(piece)
        yield from (b for b in last._bins if b)


def pack_partition(
    rows: Iterable[tuple[object, str | None]], tokenizer: WordTokenizer, limits: Limits, open_bins: int
) -> Iterator[list[Piece]]:
    packer = Packer(limits, open_bins)
    for doc, text in rows:
        ids, prompt = tokenizer.encode(text or "")
        yield from packer.add(Piece(doc, ids, prompt, 0, len(ids) // 4))
    yield from packer.finish()


def pack(
    df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", limits: Limits = Limits(), open_bins: int = 16,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """(key, start, length, doc_tokens, loss_tokens, sequence_id, segment, offset, ids): one row per piece, ``ids`` its
    token ids as little-endian unsigned 32-bit bytes. All three limits hold in every sequence. ``cache_words`` bounds the words
    a worker remembers (about 200 bytes each) and changes no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = worker_tokenizer(tokenizer_path)
        tokenizer.most_words = cache_words
        first = TaskContext.get().partitionId() << 40
        kind: list[pa.DataType] = []

        def rows() -> Iterator[tuple[object, str | None]]:
            for batch in batches:
                kind[:] = [batch.schema.field(0).type]
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        def table(out: list[tuple]) -> pa.RecordBatch:
            kinds = [kind[0], *[pa.int64()] * 7, pa.binary()]
            columns = [pa.array(c, type=t) for c, t in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        out: list[tuple] = []
        size = 0
        for number, pieces in enumerate(pack_partition(rows(), tokenizer, limits, open_bins)):
            offset = 0
            for segment, p in enumerate(pieces):
                data = p.ids[4 * p.start : 4 * (p.start + p.length)]
                whole = len(p.ids) // 4
                out.append((p.doc, p.start, p.length, whole, p.loss(p.length), first + number, segment, offset, data))
                offset += p.length
                size += len(data) + 64
            if size > 1 << 22:
                yield table(out)
                out, size = [], 0
        if out:
            yield table(out)

    names = ["key", "start", "length", "doc_tokens", "loss_tokens", "sequence_id", "segment", "offset", "ids"]
    kind_of_key = df.schema[key].dataType.simpleString()
    schema = f"key {kind_of_key}, " + ", ".join(f"{n} bigint" for n in names[1:-1]) + ", ids binary"
    packed = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    return packed.withColumnRenamed("key", key)


# --- the query -------------------------------------------------------------------------------------------------------


def query(docs: DataFrame) -> DataFrame:
    """The pieces of all documents, with the checksum of the ids. A document's first line is the prompt of the example."""
    import public_tokenizers

    rows = pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "segment",
        "loss_tokens",
    )
