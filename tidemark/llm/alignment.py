"""Cross-tokenizer alignment by counting spilled runs.

A text is cut into tokens by two public tokenizers. Tokens of the one and the other that
share bytes are linked; places where both end part the text into groups. How often a pair
of ids is linked in the whole corpus tells which translation of an id is the usual one.

1. Every task aligns its texts. What it links is gathered up to a bound, sorted by pair
   and document and spilled as one run: for each radix of the second id one compressed
   stream of counted pairs and one of (pair, document, links).
2. Runs of a radix meet in units of bounded size, so that a radix of any weight is dealt
   over many tasks. A unit merges its counted pairs by a heap of the runs' next blocks;
   Spark adds up the units and takes the largest count of each second id.
3. A unit goes through its runs once more, in the same order beside the pairs' totals,
   and gives back what each document's links are worth.

Both tokenizers work on stretches that neither of them looks beyond: a run of white
space and what follows it, cut where the white space begins with a space or line feed.
So stretches are aligned once and looked up in a bounded cache.

Defined cases: a null or empty text, or one that the tokens of either side do not give
back byte by byte, has no tokens; null ids and repeated rows count each by itself; a text
of any length is aligned whole, its links spread over several runs; equal counts are all
the largest; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_schema, with_workers

#: Second ids are dealt out by their last four bits.
RADIX_BITS = 4
#: Bits of a first and a second id in a pair's code.
FIRST_BITS, SECOND_BITS = 16, 16
#: Links that a task gathers before it spills a run.
LINKS = 4_000_000
#: Compressed bytes of runs that one task merges.
UNIT_BYTES = 32 << 20
#: Counted pairs that are read from a run at once.
BLOCK = 1 << 15
#: Stretches of a text that are looked up at once, and those in each of two generations of the cache.
TOGETHER, CACHED = 50_000, 300_000
#: Characters from which on the stretches of a text are not all held at once.
LONG = 1 << 20

# White space as both tokenizers see it.
_BREAK, _OTHER = " \n", "\t\x0b\x0c\r\x85\xa0  -     　"
_GAP, _FULL = f"[{_BREAK}{_OTHER}]", f"[^{_BREAK}{_OTHER}]"
STRETCH = re.compile(
    f"{_GAP}*{_FULL}+(?:[{_OTHER}]{_GAP}*{_FULL}+)*(?:[{_OTHER}]{_GAP}*)?|{_GAP}+")

COUNTED = np.dtype([("pair", "<u4"), ("n", "<i8")])

DOCUMENT = ("row_no bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
            "groups_sha256 string")
RUN = "radix int, first_row bigint, bytes bigint, pairs binary, postings binary"


def pair_code(first, second):
    """Radix of the second id, the rest of it, the first id: one radix is one stretch of codes."""
    radix = second & ((1 << RADIX_BITS) - 1)
    return (radix << SECOND_BITS - RADIX_BITS | second >> RADIX_BITS) << FIRST_BITS | first


def second_of(code: np.ndarray) -> np.ndarray:
    high = code.astype(np.int64) >> FIRST_BITS
    rest = SECOND_BITS - RADIX_BITS
    return (high & ((1 << rest) - 1)) << RADIX_BITS | high >> rest


def byte_level(path: str) -> tuple[list[bytes], Callable[[str], list[int]]]:
    """Bytes of the tokens of a byte-level vocabulary, and its encoder of plain text.

    Where ids follow the order of merges, they are ranks, and a quicker library can merge
    by them; the ids are the same.
    """
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings are plain text
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    tokens: list[bytes] = [b""] * tokenizer.get_vocab_size()
    for token, at in tokenizer.get_vocab().items():
        tokens[at] = token.encode() if token in special else bytes(letters[c] for c in token)
    with open(path, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if all(tokenizer.token_to_id(left + right) == 256 + k for k, (left, right) in enumerate(pairs)):
        ranks = {t: k for k, t in enumerate(tokens[:256 + len(pairs)])}
        return tokens, tiktoken.Encoding(
            "ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return tokens, lambda text: tokenizer.encode(text, add_special_tokens=False).ids


#: (tokens of a, tokens of b, groups, codes of the links, groups as text, each with ";" at its end)
Aligned = tuple[int, int, int, bytes, str]

#: How byte-level vocabularies of this family part a text before they merge.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Aligner:
    """Both tokenizers, the bytes of their tokens and the stretches met lately."""

    def __init__(self, byte_path: str, piece_path: str, cached: int = CACHED):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.first_bytes, self._encode = byte_level(byte_path)
        self.second_bytes = [self._piece_bytes(k) for k in range(self.pieces.get_piece_size())]
        self.space = self.pieces.piece_to_id("▁")
        if len(self.first_bytes) - 1 >> FIRST_BITS or len(self.second_bytes) - 1 >> SECOND_BITS:
            raise ValueError("the ids of a tokenizer take more bits than a pair's code has")
        names = [self.pieces.id_to_piece(k) for k in range(len(self.second_bytes))]
        self.parted = not any("\n" in n or "▁" in n.lstrip("▁") or " " in n for n in names)
        self.sizes = [np.array(list(map(len, x)), np.int64) for x in (self.first_bytes, self.second_bytes)]
        self.texts = [[np.array([f"{k}{end}" for k in range(len(x))], object) for end in ends]
                      for x, ends in ((self.first_bytes, ",|"), (self.second_bytes, ",;"))]
        self.now: dict[str, Aligned | None] = {}
        self.before: dict[str, Aligned | None] = {}
        self.cached = cached

    def _piece_bytes(self, at: int) -> bytes:
        piece = self.pieces.id_to_piece(at)
        if self.pieces.is_byte(at):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def _align(self, stretches: list[str]) -> Iterator[tuple[str, Aligned | None]]:
        # The second tokenizer puts a space before its text.
        seconds = self.pieces.encode([s[s[0] == " ":] for s in stretches], num_threads=1)
        whole, firsts, kept = [], [], []
        for stretch, second in zip(stretches, seconds):
            if stretch[0] != " ":
                if second[0] != self.space:
                    raise ValueError("a stretch is not parted from what is before it")
                second = second[1:]
            elif stretch == " ":
                second = [self.space]  # it puts none before an empty text
            first, text = self._encode(stretch), stretch.encode("utf-8")
            if (b"".join(map(self.second_bytes.__getitem__, second)) == text
                    and b"".join(map(self.first_bytes.__getitem__, first)) == text):
                whole.append(stretch)
                firsts.append(first)
                kept.append(second)
            else:
                yield stretch, None
        if whole:
            yield from zip(whole, self._aligned(firsts, kept))

    def _aligned(self, firsts: list[list[int]], seconds: list[list[int]]) -> Iterator[Aligned]:
        """Links and groups of token sequences that are the same bytes, all in one line."""
        (a, size_a), (b, size_b) = (
            (np.fromiter(chain.from_iterable(ids), np.int64), np.array(list(map(len, ids))))
            for ids in (firsts, seconds))
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        last = end_a[np.cumsum(size_a) - 1]  # where each stretch ends
        # Every place where a token ends closes one link: that of the tokens which are over it.
        ends = np.union1d(end_a, end_b)
        codes = pair_code(a[np.searchsorted(end_a, ends)], b[np.searchsorted(end_b, ends)]).astype("<u4").tobytes()
        links = np.searchsorted(ends, last, side="right")
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        groups = np.searchsorted(both, last, side="right")
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        # The tokens of each group in order, those of the first side before those of the second.
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        text = np.empty(len(a) + len(b), object)
        for side, ids, place, closes in ((0, a, place_a, end_a == both[group_a]),
                                         (1, b, place_b, end_b == both[group_b])):
            inner, outer = self.texts[side]
            text[place] = np.where(closes, outer[ids], inner[ids])
        text = text.tolist()
        token = link = group = 0
        for n_a, n_b, link_end, group_end in zip(
                size_a.tolist(), size_b.tolist(), links.tolist(), groups.tolist()):
            yield (n_a, n_b, group_end - group, codes[4 * link:4 * link_end],
                   "".join(text[token:token + n_a + n_b]))
            token, link, group = token + n_a + n_b, link_end, group_end

    def look_up(self, stretches: list[str]) -> list[Aligned | None]:
        missing = [s for s in set(stretches).difference(self.now)]
        fresh = []
        for s in missing:
            if s in self.before:
                self.now[s] = self.before[s]
            else:
                fresh.append(s)
        if fresh:
            self.now.update(self._align(fresh))
        found = list(map(self.now.__getitem__, stretches))
        if len(self.now) > self.cached:
            self.before, self.now = self.now, {}
        return found

    def document(self, text: str | None) -> tuple[int, int, int, bytes, str]:
        """(tokens of a, tokens of b, groups, codes of all links, digest of the groups)."""
        nothing = (0, 0, 0, b"", "")
        if not text:
            return nothing
        text = " " + text
        if not self.parted:
            parts = iter([text])
        elif len(text) < LONG:
            parts = iter(STRETCH.findall(text))
        else:
            parts = (m.group() for m in STRETCH.finditer(text))
        counts, codes, digest = [0, 0, 0], [], hashlib.sha256()
        while stretches := list(islice(parts, TOGETHER)):
            found = self.look_up(stretches)
            if None in found:
                return nothing
            n_a, n_b, n_groups, links, groups = zip(*found)
            if codes:
                digest.update(b";")
            digest.update("".join(groups)[:-1].encode())
            codes.append(b"".join(links))
            for k, n in enumerate((n_a, n_b, n_groups)):
                counts[k] += sum(n)
        return (*counts, b"".join(codes), digest.hexdigest())


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _small(numbers: np.ndarray) -> tuple[str, bytes]:
    top = int(numbers.max(initial=0))
    kind = "<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4"
    return kind, numbers.astype(kind).tobytes()


def postings(pairs: np.ndarray, docs: np.ndarray, n: np.ndarray) -> bytes:
    """Records sorted by (pair, document) as one compressed text."""
    begins = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, int)
    steps = np.diff(docs, prepend=0)
    steps[begins] = docs[begins]
    packed = [_small(x) for x in (np.diff(pairs[begins], prepend=0),
                                  np.diff(begins, append=len(pairs)), steps, n)]
    head = " ".join(f"{kind}:{len(data)}" for kind, data in packed).encode() + b"\n"
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(data for _, data in packed))


def read_postings(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(different pairs, place of each record's pair among them, documents, links)."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at = raw.index(b"\n") + 1
    parts = []
    for part in raw[:at].decode().split():
        kind, size = part.split(":")
        parts.append(np.frombuffer(raw, kind, int(size) // int(kind[-1]), at).astype(np.int64))
        at += int(size)
    steps, sizes, docs, n = parts
    place = np.repeat(np.arange(len(steps)), sizes)
    total = np.cumsum(docs)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    docs = total - np.repeat(total[begins] - docs[begins], sizes)
    return np.cumsum(steps), place, docs, n


def counted(pairs: np.ndarray, n: np.ndarray) -> bytes:
    rows = np.empty(len(pairs), COUNTED)
    rows["pair"], rows["n"] = pairs, n
    return zstandard.ZstdCompressor(level=3).compress(rows.tobytes())


def read_counted(blob: bytes, block: int = BLOCK) -> Iterator[np.ndarray]:
    """A run of counted pairs, a block at a time."""
    with zstandard.ZstdDecompressor().stream_reader(blob) as stream:
        while data := stream.read(block * COUNTED.itemsize):
            yield np.frombuffer(data, COUNTED)


def merge(runs: list[Iterator[np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts of all pairs in order, from runs in order.

    The heap holds the last pair of every run's block: up to the least of them all runs
    are known, so that much is added up and that run's next block is read.
    """
    blocks: dict[int, np.ndarray] = {}
    heap: list[tuple[int, int]] = []

    def read(k: int) -> None:
        block = next(runs[k], None)
        if block is not None:
            blocks[k] = block
            heapq.heappush(heap, (int(block["pair"][-1]), k))

    for k in range(len(runs)):
        read(k)
    while heap:
        upto = heap[0][0]
        taken = []
        for k, block in blocks.items():
            end = int(np.searchsorted(block["pair"], upto, side="right"))
            taken.append(block[:end])
            blocks[k] = block[end:]
        while heap and heap[0][0] == upto:
            k = heapq.heappop(heap)[1]
            del blocks[k]
            read(k)
        both = np.concatenate(taken)
        both = both[np.argsort(both["pair"], kind="stable")]
        begins = np.flatnonzero(np.concatenate([[True], both["pair"][1:] != both["pair"][:-1]]))
        yield both["pair"][begins], np.add.reduceat(both["n"], begins)


def spilled(codes: np.ndarray, docs: np.ndarray, first_row: int) -> Iterator[tuple]:
    """One run: for each radix its counted pairs and its postings."""
    keys = np.sort(codes.astype(np.uint64) << np.uint64(32) | docs.astype(np.uint64))
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.diff(begins, append=len(keys))
    keys = keys[begins]
    pairs, docs = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    shift = FIRST_BITS + SECOND_BITS - RADIX_BITS
    edges = np.searchsorted(pairs, np.arange((1 << RADIX_BITS) + 1) << shift)
    for radix, (at, end) in enumerate(zip(edges[:-1], edges[1:])):
        if at == end:
            continue
        here = pairs[at:end]
        starts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
        counts = counted(here[starts], np.add.reduceat(n[at:end], starts))
        posted = postings(here, docs[at:end], n[at:end])
        yield radix, first_row, len(counts) + len(posted), counts, posted


def _spill(byte_path: str, piece_path: str, links: int):
    columns = f"{DOCUMENT}, {RUN}"
    schema = arrow_schema(columns)
    own, run_own = len(DOCUMENT.split(", ")), len(RUN.split(", "))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(incoming):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = byte_path, piece_path
        if key not in _ALIGNERS:
            _ALIGNERS[key] = Aligner(*key)
        aligner = _ALIGNERS[key]
        row_no = first_row = TaskContext.get().partitionId() << 33
        held: list[np.ndarray] = []
        owners: list[tuple[int, int]] = []
        size = 0

        def runs():
            nonlocal held, owners, size
            if size:
                codes = np.concatenate(held)
                docs = np.repeat(*np.array(owners).T)
                for radix_run in spilled(codes, docs, first_row):
                    yield batch([(None,) * own + radix_run])
            held, owners, size = [], [], 0

        for rows in incoming:
            out = []
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                n_a, n_b, n_groups, codes, digest = aligner.document(text.as_py())
                out.append((row_no, doc_id, n_a, n_b, n_groups, len(codes) // 4, digest) + (None,) * run_own)
                codes = np.frombuffer(codes, "<u4")
                while len(codes):
                    part, codes = codes[:links - size], codes[links - size:]
                    held.append(part)
                    owners.append((row_no - first_row, len(part)))
                    size += len(part)
                    if size >= links:
                        yield from runs()
                        first_row = row_no
                row_no += 1
            if out:
                yield batch(out)
        yield from runs()

    return run, columns


def _merge_unit(key, rows):
    """Counts of the pairs of one unit's runs."""
    parts = list(merge([read_counted(blob.as_py()) for blob in rows.column("pairs")]))
    pairs, n = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
    return pa.table({"second": second_of(pairs), "pair": pairs, "n": n})


def _give_back(key, runs, totals):
    """What the links of each document in a unit's runs are worth."""
    pairs, n = totals.column("pair").to_numpy(), totals.column("n").to_numpy()
    best = totals.column("best").to_numpy()
    order = np.argsort(pairs, kind="stable")
    pairs, n, best = pairs[order], n[order], best[order].astype(np.int64)
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 3]
    for first_row, blob in zip(runs.column("first_row").to_pylist(), runs.column("postings")):
        different, place, docs, links = read_postings(blob.as_py())
        at = np.searchsorted(pairs, different)[place]
        size = int(docs.max()) + 1
        sums, bests, here = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
        np.add.at(sums, docs, links * n[at])
        np.add.at(bests, docs, links * best[at])
        here[docs] = True
        held = np.flatnonzero(here)
        found.append([first_row + held, bests[held], sums[held]])
    return pa.table([np.concatenate(x) for x in zip(*found)], names=["row_no", "n_best", "count_sum"])


def align(spark: SparkSession, docs: DataFrame, byte_path: str, piece_path: str, links: int = LINKS,
          unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Alignment figures of every document."""
    with_workers(spark)
    scratch = Scratch(spark, "alignment")
    run, columns = _spill(byte_path, piece_path, links)
    staged = scratch.keep(docs.select("doc_id", "text").mapInArrow(run, columns), "runs")
    texts = staged.filter("radix IS NULL").select(*[c.split()[0] for c in DOCUMENT.split(", ")])
    runs = staged.filter("radix IS NOT NULL")
    # One row for each radix.
    units = {r.radix: -(-r.bytes // unit_bytes)
             for r in runs.groupBy("radix").agg(F.sum("bytes").alias("bytes")).collect()}
    if not units:
        return texts.select(*_columns(F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))
    share = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(units.items()) for x in pair]), F.col("radix"))
    runs = runs.withColumn("unit", F.pmod(F.xxhash64("first_row", "bytes"), share.cast("bigint")).cast("int"))
    counts = (
        runs.select("radix", "unit", "pairs").groupBy("radix", "unit")
        .applyInArrow(_merge_unit, "second bigint, pair bigint, n bigint")
        .groupBy("second", "pair").agg(F.sum("n").alias("n"))
    )
    counts = scratch.keep(counts, "counts")
    most = counts.groupBy("second").agg(F.max("n").alias("most"))
    totals = (
        counts.join(most, "second")
        .withColumn("radix", F.col("second").bitwiseAND((1 << RADIX_BITS) - 1).cast("int"))
        .withColumn("unit", F.explode(F.sequence(F.lit(0), (share - 1).cast("int"))))
        .select("radix", "unit", "pair", "n", (F.col("n") == F.col("most")).alias("best"))
    )
    worth = (
        runs.select("radix", "unit", "first_row", "postings").groupBy("radix", "unit")
        .cogroup(totals.groupBy("radix", "unit"))
        .applyInArrow(_give_back, "row_no bigint, n_best bigint, count_sum bigint")
    )
    # A document's own row and what came back for it meet in one aggregate.
    stacked = texts.unionByName(worth, allowMissingColumns=True)
    zero = F.lit(0).cast("bigint")
    one = [F.max(c).alias(c) for c in texts.columns if c != "row_no"]
    return stacked.groupBy("row_no").agg(
        *one, *[F.sum(F.coalesce(c, zero)).alias(c) for c in ("n_best", "count_sum")]
    ).select(*_columns(F.col("n_best"), F.col("count_sum")))


def _columns(n_best, count_sum):
    return ["doc_id", "n_a", "n_b", "n_groups", "n_links", n_best.alias("n_best"),
            count_sum.alias("count_sum"), "groups_sha256"]
