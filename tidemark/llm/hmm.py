"""Hidden Markov language model over whole texts.

The hidden states emit classes of words: a class is one frequent word, or the rare
words that end alike. Within a class words are drawn by their training counts, one
share being kept for words never met in each class of rare words. So the table of
emissions is bounded, and every text has an exact probability:

    score = log10 P(classes), by the scaled forward recursion
          + sum over tokens of log10((c + 1) / mass of the token's class)

Baum-Welch: every partition adds up the expected uses of transitions and emissions,
Spark sums them, and the driver, whose share is bounded by states x classes, divides.
Every round counts all training texts, each whole: a long one in blocks, between which
states are passed on by products of matrices.

Counts of frequent words are known to every task (a word that makes up a millionth of
all tokens or more, so at most a million); those of other words are joined, and none
of these can weigh on one task.

Defined cases: a null or empty text is its end alone; null ids learn and are scored like
any other; repeated rows count each time; a text of any length is learned and scored
whole; words of equal counts are numbered by their bytes; without training texts all
counts are 0; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_schema, batches, id_crc, with_workers

FOLDS, HELD_OUT = 7, 2
STATES = 8
#: Words of this share of all tokens are known to every task, so they are at most as many.
KNOWN = 1 << 20
#: Words of this share have classes of their own, so they are at most as many.
OWN = 1 << 14
#: Classes of other words, by their last bytes.
ENDINGS, ENDING_BYTES = 1 << 14, 4
CLASSES = OWN + ENDINGS
#: Rounds of training, each on all training texts.
ROUNDS = 8
#: Weight of the overall distribution in each state's emissions, in tokens.
PRIOR = 100.0
STAY = 0.95
#: Longer texts are worked in blocks of so many tokens, which are joined exactly.
BLOCK = 2048
TOGETHER, SCORED_TOGETHER = 4_000_000, 4_000_000
#: Texts side by side that need not be cut in blocks.
UNCUT = 16
#: Tokens worked at once, and columns there should be at least.
CACHED, SIDE_BY_SIDE = 160_000, 300
#: Tokens whose shares are turned at once, and blocks whose matrices are made at once.
CHUNK, ASIDE = 8192, 4096
#: Steps between two rescalings: scaled emissions shrink weights by a small factor a step.
RESCALED = 16
#: Divisors are never less.
LEAST = 1e-200
LONGEST_WORD = 64
#: Bytes of texts that are counted at once.
COUNTED = 32 << 20
END = b""


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all texts in lower case (A-Z): each word once, its number for every token, and
    where each text's tokens begin and the last one's end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets, words = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
    # White space at the ends of a text leaves an empty word there.
    empty = np.flatnonzero(pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False))
    coded = words.dictionary_encode()
    return (coded.dictionary, np.delete(coded.indices.to_numpy(), empty),
            offsets - np.searchsorted(empty, offsets))


def key_of(word: bytes) -> bytes:
    """A word, or the digest of a long one, which is longer than any word left as it is."""
    return word if len(word) <= LONGEST_WORD else b"#" + hashlib.sha256(word).hexdigest().encode()


def ending_class(key: bytes) -> int:
    return zlib.crc32(key[-ENDING_BYTES:]) % ENDINGS


def _keys(words: pa.Array) -> pa.Array:
    keys = words.cast(pa.binary())
    long = pc.greater(pc.binary_length(keys), LONGEST_WORD)
    if pc.any(long).as_py():
        keys = pc.replace_with_mask(
            keys, long, pa.array(map(key_of, keys.filter(long).to_pylist()), pa.binary()))
    return keys


def _count(rows):
    """Counts of words, added up within a partition as far as memory should go."""
    schema = arrow_schema("word binary, c bigint")
    held: list[pa.Array] = []

    def given():
        words, places, _ = words_of(pa.concat_arrays(held))
        c = np.bincount(places, minlength=len(words))
        found = pa.RecordBatch.from_arrays([_keys(words), pa.array(c, pa.int64())], schema=schema)
        found = found.filter(pa.array(c > 0))
        yield from (found.slice(k, 50_000) for k in range(0, len(found), 50_000))
        yield from batches([(END, sum(map(len, held)))], schema)
        held.clear()

    for batch in rows:
        if held and batch.nbytes + sum(texts.nbytes for texts in held) > COUNTED:
            yield from given()
        held.append(batch.column(0))
    if held:
        yield from given()


class Vocabulary:
    """Frequent words by number, with their counts and classes."""

    def __init__(self, known: list[tuple[bytes, int]], own_from: float):
        """``known`` falls by count; those of ``own_from`` or more have their own class."""
        self.place = {word: k for k, (word, _) in enumerate(known)}
        self.logs = np.concatenate([np.log10([c + 1.0 for _, c in known]), np.zeros(ENDINGS)])
        self.classes = np.concatenate([
            np.array([k if c >= own_from else OWN + ending_class(w) for k, (w, c) in enumerate(known)], int),
            OWN + np.arange(ENDINGS)]).astype("<u2")
        self.size = len(known)

    def number(self, word: bytes) -> int:
        """Place of a frequent word; for another the number of known words and its ending."""
        key = key_of(word)
        at = self.place.get(key)
        return self.size + ending_class(key) if at is None else at

    def numbers(self, keys: pa.Array) -> np.ndarray:
        """The same for many keys."""
        words = keys.to_numpy(zero_copy_only=False)
        at = np.fromiter(map(self.place.get, words.tolist(), repeat(-1)), np.int64, len(words))
        rare = np.flatnonzero(at < 0)
        at[rare] = self.size + np.fromiter(map(ending_class, words[rare].tolist()), np.int64, len(rare))
        return at


CODED = ("row_no bigint, doc_id bigint, held_out boolean, n_tokens bigint, known_here bigint, "
         "logs_here double, codes binary, rare array<struct<word:binary,n:bigint>>")


def _lists(ends: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], ends]), pa.int32())


def _encode(shared):
    """Classes of the tokens of each text, and its rare words with their times."""
    def run(rows):
        vocabulary = shared.value
        end = vocabulary.number(END)
        for batch in rows:
            if not len(batch):
                continue
            words, places, begins = words_of(batch.column(3))
            keys = _keys(words)
            number = vocabulary.numbers(keys)
            at = np.insert(number[places], begins[1:], end)
            begins_at = begins[:-1] + np.arange(len(batch))
            # Each rare word of a text once: texts and words as one number.
            texts = np.repeat(np.arange(len(batch)), np.diff(begins))
            rare = np.flatnonzero(number[places] >= vocabulary.size)
            pairs, times = np.unique(texts[rare] * len(keys) + places[rare], return_counts=True)
            text_of, word_of = np.divmod(pairs, max(1, len(keys)))
            rare_words = pa.ListArray.from_arrays(
                _lists(np.searchsorted(text_of, np.arange(len(batch)), side="right")),
                pa.StructArray.from_arrays([keys.take(pa.array(word_of)), pa.array(times, pa.int64())], ["word", "n"]))
            sizes = np.diff(begins) + 1
            codes = pa.Array.from_buffers(pa.binary(), len(batch), [
                None, _lists(2 * np.cumsum(sizes)).buffers()[1], pa.py_buffer(vocabulary.classes[at])])
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array(sizes, pa.int64()),
                pa.array(np.add.reduceat(at < vocabulary.size, begins_at, dtype=np.int64)),
                pa.array(np.add.reduceat(vocabulary.logs[at], begins_at)), codes, rare_words],
                [c.split()[0] for c in CODED.split(", ")])

    return run


def _class_mass(shared):
    """Sums of c + 1 over the words of each class."""
    def run(rows):
        vocabulary, mass = shared.value, np.zeros(CLASSES)
        for batch in rows:
            mass += np.bincount(vocabulary.classes[vocabulary.numbers(_keys(batch.column(0)))],
                                batch.column(1).to_numpy() + 1, CLASSES)
        yield from batches(((int(k), float(mass[k])) for k in np.flatnonzero(mass)),
                           arrow_schema("class int, mass double"))

    return run


class Model:
    """Start, transitions, emissions by class and state."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, emits: np.ndarray):
        self.start, self.moves, self.emits = start, moves, emits

    @staticmethod
    def first(overall: np.ndarray, states: int = STATES) -> Model:
        """States that differ by chance and are kept for a while."""
        draw = np.random.default_rng(7)
        emits = overall[:, None] * np.exp(draw.normal(0, 1, (len(overall), states)))
        moves = np.full((states, states), (1 - STAY) / max(1, states - 1))
        np.fill_diagonal(moves, STAY if states > 1 else 1.0)
        return Model(np.full(states, 1 / states), moves, emits / emits.sum(axis=0))


def _columns(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences side by side, longest first: their order, the classes one step after
    another and where each step begins. Step t holds the sequences longer than t, in order."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    left = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max()), side="right")
    begins = np.concatenate([[0], np.cumsum(left)])
    flat = np.empty(begins[-1], np.int64)
    for rank, k in enumerate(order):
        flat[begins[:lengths[k]] + rank] = sequences[k]
    return order, flat, begins


def _maps(model: Model, blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each block the matrix that takes the states before it to those after it, and the
    natural logarithm of what it was divided by.

    A long text is a product of such matrices, so its blocks need not wait for each other.
    """
    states = len(model.start)
    order, flat, begins = _columns(blocks)
    at = begins.tolist()
    here, logs = np.empty((states, len(blocks), states)), np.zeros(len(blocks))
    here[:] = np.eye(states)[:, None, :]
    weights = np.empty_like(here)
    sums = np.maximum(model.emits.sum(axis=1), LEAST)
    scaled, log_sums = model.emits / sums[:, None], np.log(sums)
    for t, (begin, end) in enumerate(zip(at, at[1:])):
        now, codes = here[:, :end - begin], flat[begin:end]
        np.matmul(np.multiply(now, scaled.take(codes, axis=0), out=weights[:, :end - begin]), model.moves, out=now)
        logs[:end - begin] += log_sums[codes]
        if t % RESCALED == 0:
            most = now.max(axis=(0, 2))
            now /= most[:, None]
            logs[:end - begin] += np.log(most)
    back = np.argsort(order)
    return here.transpose(1, 0, 2)[back], logs[back]


def _block(sequences: list[np.ndarray]) -> int:
    """Length of blocks: a text need not be cut where enough others are as long, since the
    matrices of its blocks cost more than a step of few columns."""
    lengths = sorted(map(len, sequences), reverse=True)
    return max(BLOCK, lengths[UNCUT - 1]) if len(lengths) >= UNCUT else BLOCK


def _blocks(sequence: np.ndarray, size: int) -> list[np.ndarray]:
    return [sequence[k:k + size] for k in range(0, len(sequence), size)]


def _maps_of(model: Model, texts: list[list[np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Matrices and logarithms of the blocks of each text; all texts' blocks go side by side."""
    blocks = [block for text in texts for block in text]
    if blocks:
        found = [_maps(model, blocks[k:k + ASIDE]) for k in range(0, len(blocks), ASIDE)]
        matrices, logs = (np.concatenate(x) for x in zip(*found))
        ends = np.cumsum(list(map(len, texts))).tolist()
        for begin, end in zip([0, *ends], ends):
            yield matrices[begin:end], logs[begin:end]


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural logarithm of each sequence's probability, by the scaled forward recursion."""
    total, block = np.zeros(len(sequences)), _block(sequences)
    short = [k for k, s in enumerate(sequences) if len(s) <= block]
    if short:
        order, flat, begins = _columns([sequences[k] for k in short])
        at, moves = begins.tolist(), np.maximum(model.moves, LEAST)
        totals = np.maximum(model.emits.sum(axis=1), LEAST)
        emitted, logs = (model.emits / totals[:, None]).take(flat, axis=0), np.log(totals)[flat]
        sums, ones = np.zeros(len(short)), np.ones(len(model.start))
        state = np.tile(np.maximum(model.start, LEAST), (len(short), 1))
        for t, (begin, end) in enumerate(zip(at, at[1:])):
            n = end - begin
            here = emitted[begin:end]
            here *= state[:n]
            sums[:n] += logs[begin:end]
            # The sums of texts that end here are taken now, those of others where they are scaled.
            ending = n if t % RESCALED == 0 else n - at[t + 2] + end if t + 2 < len(at) else n
            scale = here[n - ending:] @ ones
            sums[n - ending:n] += np.log(scale)
            if t % RESCALED == 0:
                here /= scale[:, None]
            np.matmul(here, moves, out=state[:n])
        total[np.array(short)[order]] = sums
    long = sorted(set(range(len(sequences))) - set(short))
    for k, (matrices, logs) in zip(long, _maps_of(model, [_blocks(sequences[k], block) for k in long])):
        state = model.start
        for matrix, log in zip(matrices, logs):
            state = state @ matrix
            total[k] += log + np.log(state.sum())
            state = state / state.sum()
    return total


def expected_uses(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of the sequences (forward and backward).

    A long sequence is worked in blocks side by side, each between the states that the
    blocks before it and after it leave: the sums are those of the whole sequence.
    """
    states = len(model.start)
    parts: list[np.ndarray] = []
    before: list[np.ndarray] = []  # states before the first token, from the text's begin
    after: list[np.ndarray] = []  # what follows the last token, for each state
    inner: list[bool] = []  # whether a block of the same text comes before
    block = _block(sequences)
    texts = [_blocks(s, block) for s in sequences]
    maps_of = _maps_of(model, [blocks for blocks in texts if len(blocks) > 1])
    for blocks in texts:
        parts += blocks
        inner += [k > 0 for k in range(len(blocks))]
        if len(blocks) == 1:
            before.append(model.start)
            after.append(np.ones(states))
            continue
        maps, _ = next(maps_of)
        state = model.start
        for matrix in maps:
            before.append(state)
            state = state @ matrix
            state = state / state.sum()
        ends = [np.ones(states)]
        follows = np.ones(states)
        for matrix in maps[:0:-1]:
            follows = matrix @ follows
            follows = follows / follows.sum()
            ends.append(model.moves @ follows)
        after += ends[::-1]

    order, flat, begins = _columns(parts)
    at, ranks = begins.tolist(), np.arange(len(parts))
    moves = np.maximum(model.moves, LEAST)
    # Shares do not depend on the scale of a token's emissions, nor of a state's weights.
    forward = (model.emits / np.maximum(model.emits.sum(axis=1), LEAST)[:, None]).take(flat, axis=0)
    # Weights of the states before each token's emission; later its shares divided by these.
    entering = np.empty_like(forward)
    entering[:len(parts)] = np.maximum(np.array(before)[order], LEAST)
    ones = np.ones(states)
    for t, (begin, end) in enumerate(zip(at, at[1:])):
        here, weights = forward[begin:end], entering[begin:end]
        if t:
            np.matmul(forward[at[t - 1]:at[t - 1] + end - begin], moves, out=weights)
        here *= weights
        if t % RESCALED == 0:
            here /= (here @ ones)[:, None]
    # A token's shares come from those of the next, by the moves that lead there; the last
    # token's from what follows the block.
    shares = np.empty_like(forward)
    ends = begins[np.array(list(map(len, parts)))[order] - 1] + ranks
    last = forward[ends] * np.array(after)[order]
    shares[ends] = last / (last @ ones)[:, None]
    uses, moved = np.zeros((states, states)), np.empty((len(parts), states))
    back = np.ascontiguousarray(moves.T)
    for t in range(len(at) - 2, 0, -1):
        begin, end = at[t], at[t + 1]
        n, weights = end - begin, entering[begin:end]
        left = forward[at[t - 1]:at[t - 1] + n]
        np.divide(shares[begin:end], weights, out=weights)
        uses += left.T @ weights
        np.matmul(weights, back, out=moved[:n])
        np.multiply(left, moved[:n], out=shares[at[t - 1]:at[t - 1] + n])
    # Blocks that go on with a text are entered from the last token of the block before.
    entered = np.flatnonzero(np.array(inner)[order])
    place = np.argsort(order)
    left = forward[ends[place[order[entered] - 1]]]
    uses += left.T @ (shares[entered] / (left @ moves))
    starts = np.ones(len(parts), bool)
    starts[entered] = False
    by_state = entering.reshape(states, len(flat))  # in the place of what is no longer used
    for k in range(0, len(flat), CHUNK):
        by_state[:, k:k + CHUNK] = shares[k:k + CHUNK].T
    emits = np.stack([np.bincount(flat, share, len(model.emits)) for share in by_state], axis=1)
    return shares[:len(parts)][starts].sum(axis=0), uses * moves, emits


def _alike(sequences: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Sequences of like length together: as many as fit a processor's cache, or more where
    that would leave few side by side."""
    group: list[np.ndarray] = []
    size = 0
    for sequence in sorted(sequences, key=len):
        if size + len(sequence) > max(CACHED, SIDE_BY_SIDE * min(len(sequence), BLOCK)) and group:
            yield group
            group, size = [], 0
        group.append(sequence)
        size += len(sequence)
    if group:
        yield group


def _uses(shared, states: int):
    """Rows (place, uses by state): classes by number, moves and starts before 0."""
    names = ", ".join(f"s{z} double" for z in range(states))

    def run(rows):
        model, total = shared.value, None
        waiting: list[np.ndarray] = []
        size = 0

        def add():
            nonlocal total, size
            for group in _alike(waiting):
                found = expected_uses(model, group)
                total = found if total is None else tuple(a + b for a, b in zip(total, found))
            waiting.clear()
            size = 0

        for batch in rows:
            for codes in batch.column(0):
                waiting.append(np.frombuffer(codes.as_py(), "<u2"))
                size += len(waiting[-1])
                if size > TOGETHER:
                    add()
        if waiting:
            add()
        if total is not None:
            start, moves, emits = total
            used = np.flatnonzero(emits.any(axis=1))
            places = np.concatenate([[-states - 1], np.arange(-states, 0), used])
            table = np.vstack([start[None, :], moves, emits[used]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), *(pa.array(table[:, z]) for z in range(states))],
                schema=arrow_schema(f"place int, {names}"))

    return run, f"place int, {names}"


def train(spark: SparkSession, coded: DataFrame, overall: np.ndarray, states: int = STATES,
          rounds: int = ROUNDS) -> Model:
    """Baum-Welch on all training texts of a coded table."""
    learning = coded.filter("NOT held_out")
    model = Model.first(overall, states)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        run, schema = _uses(shared, states)
        summed = (
            learning.select("codes").mapInArrow(run, schema)
            .groupBy("place").agg(*[F.sum(f"s{z}").alias(f"s{z}") for z in range(states)])
            .collect()  # at most classes + states + 1 rows
        )
        shared.unpersist()
        if not summed:
            continue
        uses = np.zeros((CLASSES + states + 1, states))
        for place, *values in summed:
            uses[place + states + 1] = values
        start, moves, emits = uses[0] + 1, uses[1:states + 1], uses[states + 1:]
        moves = moves + 1 + 20 * np.eye(states)
        model = Model(
            start / start.sum(), moves / moves.sum(axis=1, keepdims=True),
            (emits + PRIOR * overall[:, None]) / (emits.sum(axis=0) + PRIOR))
    return model


SCORED = "row_no bigint, doc_id bigint, held_out boolean, n_tokens bigint, known_here bigint, logs_here double, classes double"


def _score(shared):
    """log10 P(classes) less the log10 mass of the classes, for each whole text."""
    def run(rows):
        model, log_mass = shared.value
        schema = arrow_schema(SCORED)
        held: list[tuple] = []
        waiting: list[np.ndarray] = []
        size = 0

        def out():
            found = np.empty(len(waiting))
            found[sorted(range(len(waiting)), key=lambda k: len(waiting[k]))] = np.concatenate(
                [log_likelihoods(model, group) for group in _alike(waiting)])
            for h, s, f in zip(held, waiting, found / np.log(10)):
                yield (*h, float(f - log_mass[s].sum()))
            held.clear()
            waiting.clear()

        for batch in rows:
            for *h, codes in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(tuple(h))
                waiting.append(np.frombuffer(codes, "<u2"))
                size += len(waiting[-1])
                if size > SCORED_TOGETHER:
                    yield from batches(out(), schema)
                    size = 0
        if held:
            yield from batches(out(), schema)

    return run


def score(spark: SparkSession, docs: DataFrame, states: int = STATES) -> DataFrame:
    """Scores of all texts by the unigram base and by the model, learned outside the held-out fold."""
    with_workers(spark)
    scratch = Scratch(spark, "hmm")
    docs = docs.select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id",
        (id_crc(F.col("doc_id")) % FOLDS == HELD_OUT).alias("held_out"), "text")
    counts = scratch.keep(
        docs.filter("NOT held_out").select("text").mapInArrow(_count, "word binary, c bigint")
        .groupBy("word").agg(F.sum("c").alias("c")), "counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("c")).first()
    # The end of a text is numbered however rare it is: it is no word and has no other name.
    frequent = (F.col("c") >= max(1, tokens / KNOWN)) | (F.length("word") == 0)
    known = sorted(((bytes(r.word), r.c) for r in counts.filter(frequent).collect()),
                   key=lambda r: (-r[1], r[0]))  # at most KNOWN words of bounded length, and the end
    vocabulary = Vocabulary(known, max(1, tokens / OWN))
    shared = spark.sparkContext.broadcast(vocabulary)
    mass = np.zeros(CLASSES)
    mass[OWN:] = 1  # words never met
    for place, more in counts.mapInArrow(_class_mass(shared), "class int, mass double").groupBy(
            "class").agg(F.sum("mass").alias("mass")).collect():  # at most CLASSES rows
        mass[place] += more
    coded = scratch.keep(docs.mapInArrow(_encode(shared), CODED), "coded")
    model = train(spark, coded, mass / mass.sum(), states)
    tables = spark.sparkContext.broadcast((model, np.log10(np.maximum(mass, 1))))
    here = coded.drop("rare").select(
        "row_no", "doc_id", "held_out", "n_tokens", "known_here", "logs_here", "codes").mapInArrow(
        _score(tables), SCORED)
    rare = (
        coded.select("row_no", F.inline("rare"))
        .join(counts.filter(~frequent), "word")
        .groupBy("row_no").agg(F.sum("n").alias("known_rare"),
                               F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs_rare"))
    )
    logs = F.col("logs_here") + F.coalesce("logs_rare", F.lit(0.0))
    return here.join(rare, "row_no", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known_here") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(tokens + distinct + 1))).alias("base_score"),
        (logs + F.col("classes")).alias("score"))
