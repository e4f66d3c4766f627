"""Toxicity: a linear classifier that is kept blind to who is mentioned.

A text is the set of its words; a word is hashed as itself, by its beginnings and by
its inner letter groups. Features that the labels do not clearly favour are left out.
For labelled texts that name a group of people, a copy with the group's name swapped
is made, and training penalises the square of the change in score.

Defined cases: a text and its words count whole, however long; null and empty texts get the score of no evidence (the intercept); a
repeated row is scored like the first; without labels of both kinds every score is
the share of label 1 (0.5 without labels). Other columns are never read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm.common import Scratch, WordCache, arrow_schema, batches, filter_texts, with_workers

BUCKETS = 1 << 18
#: A feature is used if its share differs between the labels by so many standard errors.
LEAST_Z = 6.0
LEAST_TEXTS = 5
STEPS, RATE, RIDGE = 30, 0.4, 1e-4
#: Weight of the squared score change under a swap, against the mean log loss.
COUNTERFACTUAL = 4.0
PARTS = 12
LONGEST_KEPT = 64
THRESHOLD = 0.5

# Names of groups of people that may stand for each other.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "american", "arab"),
    ("immigrants", "refugees", "natives", "foreigners"), ("old", "young"), ("deaf", "blind", "disabled"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("ausländer", "deutsche"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"),
)
SWAP = {w: g[(k + 1) % len(g)] for g in IDENTITY_GROUPS for k, w in enumerate(g)}

WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def swapped(words: set[str]) -> set[str] | None:
    """The words after every group name gives way to the next of its kind."""
    named = words & SWAP.keys()
    return {SWAP.get(w, w) for w in words} if named else None


def features(word: str) -> list[int]:
    """Buckets of a whole word, of its beginnings and of all its inner letter groups."""
    def bucket(part: str) -> int:
        return zlib.crc32(part.encode("utf-8")) % BUCKETS

    found = {bucket(f"w{word}")}
    found.update(bucket(f"b{word[:k]}") for k in (4, 5, 6) if len(word) > k)
    found.update(bucket(f"g{word[k:k + 5]}") for k in range(len(word) - 4))
    return sorted(found)


def _encode(rows):
    """(label, features, features after the swap)"""
    schema = arrow_schema("label int, found array<int>, swapped array<int>")

    def out():
        for batch in rows:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                other = swapped(words)
                yield (label, sorted({f for w in words for f in features(w)}),
                       None if other is None else sorted({f for w in other for f in features(w)}))

    yield from batches(out(), schema, 512)


def _only(chosen: frozenset[int]):
    """Rows with the chosen features alone."""
    schema = arrow_schema("label int, found array<int>, swapped array<int>")

    def run(rows):
        for batch in rows:
            yield from batches(
                ((label, *(f and [x for x in f if x in chosen] for f in both))
                 for label, *both in zip(*(c.to_pylist() for c in batch.columns))), schema, 512)

    return run


def _gradient(place: dict[int, int], weights: np.ndarray, penalty: float):
    """Sums over the rows of a partition: gradient of the log loss and of the swaps' penalty.

    Everything is bounded by the number of chosen features.
    """
    size = len(weights)

    def run(rows):
        total = np.zeros(size + 1)
        for batch in rows:
            for label, found, other in zip(*(c.to_pylist() for c in batch.columns)):
                at = [0] + [place[f] for f in found]
                score = 1 / (1 + np.exp(-np.clip(weights[at].sum(), -30, 30)))
                total[at] += score - label
                if other is not None:
                    gone = [place[f] for f in set(found) - set(other)]
                    came = [place[f] for f in set(other) - set(found)]
                    change = weights[gone].sum() - weights[came].sum()
                    total[gone] += 2 * penalty * change
                    total[came] -= 2 * penalty * change
                total[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    return run


def fit(spark: SparkSession, texts: DataFrame, penalty: float = COUNTERFACTUAL) -> dict:
    """Weights by feature from (label, text); the chosen features bound the driver's share."""
    with_workers(spark)
    scratch = Scratch(spark, "toxicity")
    rows = scratch.keep(texts.select("label", "text").repartition(PARTS).mapInArrow(
        _encode, "label int, found array<int>, swapped array<int>"))
    n1, n = rows.agg(F.sum("label"), F.count("label")).first()
    if not n or n1 in (0, n):
        share = np.clip((n1 or 0) / n, 1e-3, 1 - 1e-3) if n else 0.5
        return {"bias": float(np.log(share / (1 - share))), "weights": {}}
    counted = (
        rows.select("label", F.explode("found").alias("f")).groupBy("f")
        .agg(F.sum("label").alias("a"), F.count("label").alias("c"))
        .filter(F.col("c") >= LEAST_TEXTS)
        .withColumn("p", F.col("c") / n)
        .withColumn("z", F.try_divide(  # a feature of all texts tells nothing
            F.col("a") / n1 - (F.col("c") - F.col("a")) / (n - n1),
            F.sqrt(F.col("p") * (1 - F.col("p")) * (1 / n1 + 1 / (n - n1)))))
        .filter(F.abs("z") >= LEAST_Z)
    )
    chosen = sorted(r.f for r in counted.select("f").collect())  # at most BUCKETS
    place = {f: k + 1 for k, f in enumerate(chosen)}
    rows = scratch.keep(rows.mapInArrow(_only(frozenset(chosen)), rows.schema))
    weights = np.zeros(len(chosen) + 1)
    weights[0] = np.log(n1 / (n - n1))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1 if chosen else 0):
        sums = sum(np.frombuffer(r.total) for r in rows.mapInArrow(
            _gradient(place, weights, penalty), "total binary").collect())  # one row a partition
        slope = sums[:-1] / sums[-1] + RIDGE * weights * (np.arange(len(weights)) > 0)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        weights = weights - RATE * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return {"bias": float(weights[0]), "weights": {f: float(weights[k]) for f, k in place.items()}}


class Scorer:
    """Scores of texts; the chosen features of a word are looked up in a bounded cache."""

    def __init__(self, model: dict):
        self.bias, self.weights = model["bias"], model["weights"]
        self.known = WordCache(self.chosen)

    def chosen(self, word: str) -> tuple[int, ...]:
        return tuple(f for f in features(word) if f in self.weights)

    def __call__(self, text: str | None) -> float:
        self.known = known = self.known.renewed()
        found: set[int] = set()
        for word in words_of(text):
            # In scripts without spaces a run may be a whole text; such are not kept.
            if hit := known[word] if len(word) <= LONGEST_KEPT else self.chosen(word):
                found.update(hit)
        total = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))


def _score(model: dict):
    schema = arrow_schema("doc_id bigint, held_out boolean, score double")

    def run(rows):
        scorer = Scorer(model)
        for batch in rows:
            scores = [scorer(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], schema=schema)

    return run


def score(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    with_workers(spark)
    return (
        docs.select("doc_id", labelled.is_held_out(F.col("doc_id")).alias("held_out"), "text")
        .mapInArrow(_score(model), "doc_id bigint, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document by a model of the labelled ones."""
    sample = labelled.training_labels(labels, "toxic")
    return score(spark, docs, fit(spark, labelled.labelled_texts(docs, sample)))


def keep_civil(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that a model of the labelled ones does not call toxic, with all columns."""
    model = fit(spark, labelled.labelled_texts(docs, labelled.training_labels(labels, "toxic")))

    def make():
        scorer = Scorer(model)
        return lambda texts: np.array([scorer(t) < THRESHOLD for t in texts], bool)

    return filter_texts(docs, make)
