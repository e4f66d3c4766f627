"""Bounded-space online packing of token sequences.

Every partition keeps a fixed number of open windows. A document goes whole into
the window that it fills best. When none has room for it, the fullest one is closed;
its gap is filled with the head of the document, if the gap is worth a cut. What is
still open at the end of a partition is merged with the leftovers of other partitions.

Defined cases: a null or empty text is the end id alone; a document of the window's
length or more fills windows by itself and its rest is placed; of windows that a document
fills equally well it takes the first; repeated rows and null
ids are packed each on its own; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, WordCache, arrow_schema, batches, with_workers

WINDOW = 2048
OPEN_WINDOWS = 64
#: A gap below so many tokens is padded, a larger one is filled by cutting a document.
LEAST_CUT = 16
#: So many partitions' leftovers, each of at most OPEN_WINDOWS windows, are merged by one task.
MERGE = 32
END_ID = 1
#: Words in each of two generations of the cache.
CACHE_WORDS = 400_000

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
STAGED = PIECES + ", part int, ids binary"


class WordIds:
    """Ids of texts by a public tokenizer, word by word.

    The tokenizer never joins characters across ASCII white space, so the ids of a text
    are those of its words in order. Nor does it join letters with a comma or full stop,
    so a word's letters are encoded by its model alone: lower case in normal form, which
    is all that its normaliser would do, as the byte alphabet of its vocabulary. Any
    other word takes the whole tokenizer. Words are looked up in a bounded cache.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in plain)
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.known = WordCache(self._encode, most=cache_words)

    def _encode(self, word: bytes) -> bytes:
        if b"<|" in word:  # a special token is known by its own spelling only
            ids = self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids
            return array("I", ids).tobytes()
        low = word.lower() if word.isascii() else word
        core = low.rstrip(b".,")
        if core != word and core:
            if core == low:
                return self.known[low]
            if unicodedata.normalize("NFC", core.decode("utf-8")).lower().isalpha():
                return self.known[core] + self.known[low[len(core):]]
        text = low.decode("utf-8")
        if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
            ids = [t.id for t in self.model.tokenize(low.decode("latin-1").translate(self.alphabet))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        known = self.known = self.known.renewed()
        return b"".join([known[w] for w in (text or "").encode("utf-8").split()])


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer and cache for each worker process."""
    if path not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


class Piece(tuple):
    """(doc_id, start, doc_tokens, ids)"""

    __slots__ = ()

    def cut(self, at: int) -> tuple[Piece, Piece]:
        doc_id, start, doc_tokens, ids = self
        return (Piece((doc_id, start, doc_tokens, ids[:4 * at])),
                Piece((doc_id, start + at, doc_tokens, ids[4 * at:])))

    @property
    def size(self) -> int:
        return len(self[3]) // 4


class Windows:
    """A bounded set of open windows, filled best fit."""

    def __init__(self, window: int, most: int, least_cut: int):
        self.window, self.most, self.least_cut = window, most, least_cut
        self.open: list[list[Piece]] = []
        self.free: list[int] = []

    def _close(self, k: int) -> list[Piece]:
        self.free[k] = self.free[-1]
        self.free.pop()
        closed, self.open[k] = self.open[k], self.open[-1]
        self.open.pop()
        return closed

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Give the windows that are closed."""
        while piece.size >= self.window:
            head, piece = piece.cut(self.window)
            yield [head]
        while piece.size:
            size = piece.size
            fits = min((f for f in self.free if f >= size), default=None)
            if fits is None and len(self.open) < self.most:
                self.open.append([])
                self.free.append(self.window)
                fits = self.window
            if fits is not None:
                k = self.free.index(fits)
                self.open[k].append(piece)
                self.free[k] -= size
                if not self.free[k]:
                    yield self._close(k)
                return
            gap = min(self.free)
            k = self.free.index(gap)
            if gap >= self.least_cut:
                head, piece = piece.cut(gap)
                self.open[k].append(head)
            yield self._close(k)


def _rows(sequence: int, pieces: list[Piece], part: int, leftover: bool) -> Iterator[tuple]:
    offset = 0
    for piece in pieces:
        doc_id, start, doc_tokens, ids = piece
        yield (doc_id, start, piece.size, zlib.crc32(ids), doc_tokens, sequence, offset,
               part if leftover else None, ids if leftover else None)
        offset += piece.size


def _fill(path: str, window: int, most: int, least_cut: int):
    schema = arrow_schema(STAGED)
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def run(incoming):
        part = TaskContext.get().partitionId()
        tokenizer, windows, count = word_ids(path), Windows(window, most, least_cut), 0

        def rows():
            nonlocal count
            for batch in incoming:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = tokenizer.ids(text.as_py()) + end
                    for closed in windows.place(Piece((doc_id, 0, len(ids) // 4, ids))):
                        yield from _rows((part << 32) + count, closed, part, False)
                        count += 1
            for left in windows.open:
                yield from _rows((part << 32) + count, left, part, True)
                count += 1

        yield from batches(rows(), schema)

    return run


def merged(pieces: list[Piece], window: int, least_cut: int) -> list[list[Piece]]:
    """Leftover pieces as sequences: best fit by falling size, then the windows that are
    far from full are run together and cut; the last one is cut at powers of two, which
    need no padding."""
    windows = Windows(window, len(pieces), least_cut)
    done = [w for p in sorted(pieces, key=lambda p: -p.size) for w in windows.place(p)]
    loose: list[Piece] = []
    for held, free in zip(windows.open, windows.free):
        if free < least_cut:
            done.append(held)
        else:
            loose.extend(held)
    while left := sum(p.size for p in loose):
        room = min(window, 1 << (left.bit_length() - 1))
        taken: list[Piece] = []
        while room:
            head, rest = loose[0].cut(room)
            taken.append(head)
            room -= head.size
            loose[:1] = [rest] if rest.size else []
        done.append(taken)
    return done


def _merge(window: int, least_cut: int):
    schema = arrow_schema(PIECES)

    def run(key, rows):
        columns = [rows.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")]
        order = np.lexsort([rows.column(c).to_numpy() for c in ("offset", "sequence_id")])
        pieces = [Piece(tuple(c[i] for c in columns)) for i in order]
        group = key[0].as_py()

        def out():
            for n, held in enumerate(merged(pieces, window, least_cut)):
                for row in _rows(((1 << 30) + group << 32) + n, held, 0, False):
                    yield row[:7]

        import pyarrow as pa

        return pa.Table.from_batches(list(batches(out(), schema)), schema)

    return run


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, least_cut: int = LEAST_CUT) -> DataFrame:
    """Pieces of all documents with the sequence and the place in it that they take."""
    with_workers(spark)
    scratch = Scratch(spark, "packing")
    staged = scratch.keep(docs.select("doc_id", "text").mapInArrow(
        _fill(tokenizer, window, open_windows, least_cut), STAGED))
    names = [f.name for f in staged.schema.fields[:7]]
    left = (
        staged.filter("ids IS NOT NULL")
        .groupBy(F.floor(F.col("part") / MERGE).cast("long").alias("merge_group"))
        .applyInArrow(_merge(window, least_cut), PIECES)
    )
    return staged.filter("ids IS NULL").select(*names).unionByName(left.select(*names))
