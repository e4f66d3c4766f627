"""Benchmark decontamination: enough shared word pairs close together, then local alignment.

Smith-Waterman alignment of a test item with a document gives the score: matched words score 1,
mismatches and gaps cost, and the best local score is divided by the item's length. Copies,
edited copies and long parts of items score high.

An alignment of a given score holds a number of word pairs of the item unchanged, however
its edits lie, and these are not far apart, as gaps cost. Documents that hold so many pairs
of an item so close together are aligned with it around them; no other can reach the score. Items
too short for one sure pair go by their single words. How common a pair is does not matter.

Test items are taken in blocks of a bounded number of words, which bounds what is sent
to every task; each block meets all documents.

Defined cases: null and empty texts and items match nothing; equal items and repeated rows are reported each; of alignments with
equal scores the first that is found is reported; a text of any length is searched to its end; empty
tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_schema, batches, filter_texts, with_workers

SEED_WORDS = 2
#: Share of an item's best possible score from which a document is contaminated.
LEAST_SCORE = 0.5
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.7
BLOCK_WORDS = 200_000
#: Cells of one alignment batch in a task.
CELLS = 4_000_000

COLUMNS = ("doc_id bigint, item_id bigint, seeds bigint, score double, matched_from bigint, "
           "matched_to bigint")

#: Bytes of ASCII letters and digits, in lower case, and of other characters; the rest part words.
PARTED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Signs and spaces beyond ASCII that part words too.
SIGNS = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f\uff00-\uff0f]")


def words_of(text: str | None) -> list[bytes]:
    text = (text or "").lower()
    if not text.isascii():
        text = SIGNS.sub(" ", text)
    return text.encode("utf-8").translate(PARTED).split()


class Coded:
    """Word sequences as numbers: the words of the items are numbered from 1, others are 0.

    A sequence is one number in a system with as many digits as there are words, which
    is exact; a block's words keep it below 2**63.
    """

    def __init__(self, items: list[list[bytes]]):
        self.numbers: dict[bytes, int] = {}
        for words in items:
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
        self.base = len(self.numbers) + 1

    def words(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))

    def sequences(self, codes: np.ndarray, size: int) -> np.ndarray:
        """One number for each place; 0 where a word is not of the items."""
        n = len(codes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        out, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(size):
            part = codes[k:k + n]
            out = out * self.base + part
            known &= part > 0
        return np.where(known, out, 0)


def _inside(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys among the sorted keys, -1 where absent."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def sure_seeds(length: int, least: float) -> tuple[int, int]:
    """Words of a seed and the fewest seeds that an alignment of the score keeps.

    Of ``m`` matched words, edits part at most one more run than there are edits, and a run
    of n words holds n - 1 pairs. The most edits are the mismatches that the item has
    words for, as they cost less, then gaps.
    """
    fewest, fewest_words = length, length
    for m in range(1, length + 1):
        spare = m * MATCH - least * length * MATCH + 1e-9
        if spare < 0:
            continue
        mismatches = min(length - m, int(spare / -MISMATCH))
        gaps = int((spare + mismatches * MISMATCH) / -GAP)
        fewest, fewest_words = min(fewest, m - 1 - mismatches - gaps), min(fewest_words, m)
    return (SEED_WORDS, fewest) if fewest > 0 else (1, max(1, fewest_words))


def reach_of(length: int, least: float) -> int:
    """The most words of a text that an alignment of the score spans."""
    return int(length * (1 + max(0.0, 1 - least) * MATCH / -GAP)) + 1


def align(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each row of items with that of texts.

    Words are numbers, 0 in items and -1 in texts where a row is shorter; 0 never matches. Gives the
    scores and the first and last places in the texts.
    """
    count, width = texts.shape
    slope = -GAP * np.arange(width + 1)
    row = np.zeros((count, width + 1))
    origin = np.broadcast_to(np.arange(width + 1), row.shape).copy()
    best, first, last = np.zeros(count), np.zeros(count, int), np.zeros(count, int)
    every = np.arange(count)[:, None]
    places = np.broadcast_to(np.arange(width + 1), row.shape)
    for k in range(items.shape[1]):
        word = items[:, k:k + 1]
        step = np.where((texts == word) & (word != 0), MATCH, MISMATCH)
        new = np.zeros_like(row)
        new[:, 1:] = row[:, :-1] + step
        up = row + GAP
        came = places.copy()
        came[:, 1:] = origin[:, :-1]
        came = np.where(up > new, origin, came)
        new = np.maximum(new, up)
        came = np.where(new <= 0, places, came)
        new = np.maximum(new, 0)
        # A gap in the item carries the best score to the left along the row.
        lifted = new + slope
        top = np.maximum.accumulate(lifted, axis=1)
        at = np.maximum.accumulate(np.where(lifted >= top, places, 0), axis=1)
        row = top - slope
        origin = came[every, at]
        peak = row.argmax(axis=1)
        value = row[every[:, 0], peak]
        better = value > best
        best = np.where(better, value, best)
        last = np.where(better, peak, last)
        first = np.where(better, origin[every[:, 0], peak], first)
    return best, first, last


def _regions(first: list[int], last: list[int], reach: int, end: int) -> list[tuple[int, int]]:
    """Stretches of the text around seeds, run together where they meet."""
    out: list[list[int]] = []
    for p, q in zip(first, last):
        low, high = max(0, p - reach), min(end, q + SEED_WORDS + reach)
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [tuple(r) for r in out]


class Block:
    """A bounded number of items with their seeds."""

    def __init__(self, ids: list, words: list[list[bytes]], least: float):
        self.ids, self.least, self.coded = ids, least, Coded(words)
        self.items = [self.coded.words(w) for w in words]
        sure = [sure_seeds(len(w), least) for w in words]
        self.fewest = np.array([n for _, n in sure], np.int64)
        self.reach = np.array([reach_of(len(w), least) for w in words], np.int64)
        #: For each size the seeds, where the items of each begin, and the items.
        self.holders: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in {size for size, _ in sure}:
            held = [np.unique(self.coded.sequences(codes, size)) if size == wanted else np.zeros(0, np.int64)
                    for codes, (wanted, _) in zip(self.items, sure)]
            seeds, items = np.concatenate(held), np.repeat(np.arange(len(held)), [len(h) for h in held])
            order = np.argsort(seeds, kind="stable")
            keys, begins = np.unique(seeds[order], return_index=True)
            if len(keys):
                self.holders[size] = keys, np.append(begins, len(seeds)), items[order]

    def _seeds(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and places of the seeds in a text, by item and place."""
        items, places = [], []
        for size, (keys, begins, holders) in self.holders.items():
            at = _inside(keys, self.coded.sequences(codes, size))
            place = np.flatnonzero(at >= 0)
            at = at[place]
            times = begins[at + 1] - begins[at]
            before = np.cumsum(times) - times
            items.append(holders[np.repeat(begins[at] - before, times) + np.arange(times.sum())])
            places.append(np.repeat(place, times))
        item, place = np.concatenate(items), np.concatenate(places)
        order = np.lexsort((place, item))
        return item[order], place[order]

    def _stretches(self, codes: np.ndarray):
        """(item, seeds, first word, end) wherever enough seeds of an item are close together."""
        item, place = self._seeds(codes)
        here = np.arange(len(item))
        there = here + self.fewest[item] - 1
        here, there = here[there < len(item)], there[there < len(item)]
        ok = (item[there] == item[here]) & (place[there] - place[here] <= self.reach[item[here]])
        here, there = here[ok], there[ok]
        for k in np.unique(item[here]).tolist():
            mine = item[here] == k
            hits = int(np.searchsorted(item, k, side="right") - np.searchsorted(item, k))
            for low, high in _regions(place[here[mine]].tolist(), place[there[mine]].tolist(),
                                      int(self.reach[k]), len(codes)):
                yield k, hits, low, high

    def _score(self, waiting: list[tuple], best: dict[tuple, tuple]) -> None:
        """Align stretches (text, item, seeds, place, words), wide and narrow ones apart."""
        waiting.sort(key=lambda w: len(w[4]))
        while waiting:
            wide = len(waiting[-1][4])
            part = waiting[-max(1, CELLS // 20 // wide):]
            del waiting[-len(part):]
            long = max(len(self.items[k]) for _, k, *_ in part)
            left, right = np.zeros((len(part), long), int), np.full((len(part), wide), -1)
            for r, (_, k, _, _, text) in enumerate(part):
                left[r, :len(self.items[k])] = self.items[k]
                right[r, :len(text)] = text
            for (n, k, hits, low, _), score, first, last in zip(part, *align(left, right)):
                share = float(score) / (MATCH * len(self.items[k]))
                if share > best.get((n, k), (0, -1.0))[1]:
                    best[n, k] = (hits, share, low + int(first), low + int(last))

    def matches(self, texts: list[str | None]) -> list[tuple]:
        """(text, item, seeds, score, first word, end) of all pairs that reach the score."""
        best: dict[tuple, tuple] = {}
        waiting: list[tuple] = []
        cells = 0
        for n, text in enumerate(texts):
            codes = self.coded.words(words_of(text))
            for k, hits, low, high in self._stretches(codes):
                waiting.append((n, k, hits, low, codes[low:high]))
                cells += (high - low) * len(self.items[k])
            if cells >= CELLS:
                self._score(waiting, best)
                cells = 0
        self._score(waiting, best)
        return [(n, k, *found) for (n, k), found in sorted(best.items()) if found[1] >= self.least - 1e-9]


def _find(shared):
    def run(rows):
        block = shared.value

        def out():
            for batch in rows:
                ids = batch.column(0).to_pylist()
                for n, k, *found in block.matches(batch.column(1).to_pylist()):
                    yield (ids[n], block.ids[k], *found)

        yield from batches(out(), arrow_schema(COLUMNS))

    return run


def blocks(spark: SparkSession, benchmark: DataFrame, least: float) -> list:
    """The items in blocks, as broadcast variables."""
    with_workers(spark)
    scratch = Scratch(spark, "decontamination")
    items = scratch.keep(benchmark.select(
        "item_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), r"[\W_]+")).alias("words")))
    total = items.agg(F.sum("words")).first()[0] or 0
    count, out = -(-total // BLOCK_WORDS), []
    for number in range(count):
        # The words of a block are bounded, for items are dealt out evenly by hash.
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).collect()
        words = [words_of(r.text) for r in part]
        if any(words):
            out.append(spark.sparkContext.broadcast(Block([r.item_id for r in part], words, least)))
    return out


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
             least: float = LEAST_SCORE) -> DataFrame:
    """(document, item) pairs whose alignment reaches the score."""
    out = spark.createDataFrame([], COLUMNS)
    for block in blocks(spark, benchmark, least):
        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(_find(block), COLUMNS))
    return out


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
          least: float = LEAST_SCORE) -> DataFrame:
    """Documents that hold no benchmark item, with all columns."""
    out = docs
    for shared in blocks(spark, benchmark, least):
        def make(shared=shared):
            def passes(texts):
                ok = np.ones(len(texts), bool)
                ok[[m[0] for m in shared.value.matches(texts)]] = False
                return ok

            return passes

        out = filter_texts(out, make)
    return out
