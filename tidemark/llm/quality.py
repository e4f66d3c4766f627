"""Quality: kernel ridge on document statistics by random Fourier features.

Fixed random cosines of the standardised statistics approximate a Gaussian kernel.
Partitions add up their parts of the normal equations, which the driver solves (their
size is fixed). A fold of its own then gives a rising step function from ridge score
to the share of good labels (isotonic regression on a histogram of fixed size).

Defined cases: null and empty texts have statistics of 0 and a score like any other;
repeated rows score alike; a text of any length is measured whole; without labels of both kinds every score is the share of
label 1 (0.5 without labels). Other columns are never read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm.common import Scratch, arrow_schema, filter_texts, id_crc, with_workers

FEATURES, RIDGE, SEED = 256, 1e-3, 20
BINS = 500
PARTS = 12
THRESHOLD = 0.3


def _kinds() -> np.ndarray:
    """Byte kinds: 1 upper, 2 lower, 3 digit, 4 stop or comma, 5 ! and ?, 6 other sign, 7 beyond ASCII."""
    kind = np.full(256, 6)
    kind[:33] = 0
    kind[127] = 0
    kind[128:] = 7
    for k, letters in ((1, range(65, 91)), (2, range(97, 123)), (3, range(48, 58)),
                       (4, b".,;:'\"()-"), (5, b"!?")):
        kind[list(letters)] = k
    return kind


KINDS = _kinds()
STATISTICS = 16


def statistics(text: str | None) -> list[float]:
    """Shape of a whole text, whatever its language."""
    text = text or ""
    data = text.encode("utf-8")
    if not data:
        return [0.0] * STATISTICS
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    by_kind = np.bincount(KINDS, weights=by_byte, minlength=8)
    size, letters = len(data), max(1.0, by_kind[1] + by_kind[2] + by_kind[7])
    words, lines = data.lower().split(), [x for x in data.split(b"\n") if x.strip()]
    n, counts = max(1, len(words)), Counter(words)
    top = counts.most_common(1)[0][1] if counts else 0
    long = sum(len(w) > 20 for w in counts) / max(1, len(counts))
    return [
        float(np.log1p(len(words))), size / n,
        float(np.log1p(len(counts)) / np.log1p(n)), top / n,
        by_kind[1] / letters, by_kind[3] / size, by_kind[4] / n, by_kind[5] / n, by_kind[6] / n,
        by_kind[7] / size, 1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))), float(by_byte[124] / n), long,
        by_kind[0] / size, float(np.std([len(w) for w in counts])) if counts else 0.0,
    ]


def _statistics_of(rows):
    for batch in rows:
        found = [statistics(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))],
            [*batch.schema.names[:-1], "x"])


class Cosines:
    """Random Fourier features of standardised statistics, with a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        draw = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.waves = draw.normal(0, 1 / np.sqrt(STATISTICS), (STATISTICS, FEATURES))
        self.phases = draw.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6) @ self.waves + self.phases
        return np.hstack([np.cos(z) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, STATISTICS)


def _normal_sums(cosines: Cosines):
    """One row for each partition: its part of the normal equations, of fixed size."""
    def run(rows):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in rows:
            if batch.num_rows:
                z, y = cosines(_matrix(batch.column(1))), np.asarray(batch.column(0), float)
                total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    return run


def _ridge_scores(cosines: Cosines, weights: np.ndarray):
    """Replace the statistics, the last column, by the ridge score."""
    def run(rows):
        for batch in rows:
            last = batch.num_columns - 1
            out = cosines(_matrix(batch.column(last))) @ weights if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.float64())], [*batch.schema.names[:-1], "raw"])

    return run


def isotonic(counts: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (bin, rows, ones): mean bins of the steps and their values."""
    steps: list[list[float]] = []
    for at, n, ones in sorted(counts):
        steps.append([at * n, n, ones])
        while len(steps) > 1 and steps[-2][2] * steps[-1][1] >= steps[-1][2] * steps[-2][1]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    return np.array([s[0] / s[1] for s in steps]), np.array([s[2] / s[1] for s in steps])


def _bin(raw):
    return F.floor((F.greatest(F.least(raw, F.lit(1.5)), F.lit(-0.5)) + 0.5) / 2 * BINS).cast("int")


def fit(spark: SparkSession, texts: DataFrame) -> dict:
    """Model from (doc_id, label, text)."""
    with_workers(spark)
    scratch = Scratch(spark, "quality")
    rows = scratch.keep(
        texts.select("label", (id_crc(F.col("doc_id")) % labelled.FOLDS == 1).alias("calibrates"), "text")
        .repartition(PARTS)
        .mapInArrow(_statistics_of, "label int, calibrates boolean, x array<double>"))
    n1, n = rows.agg(F.sum("label"), F.count("label")).first()
    if not n or n1 in (0, n):
        return {"constant": (n1 / n) if n else 0.5}
    moments = rows.agg(*[F.avg(F.col("x")[k]) for k in range(STATISTICS)],
                       *[F.stddev_pop(F.col("x")[k]) for k in range(STATISTICS)]).first()
    cosines = Cosines(np.array(moments[:STATISTICS]), np.array(moments[STATISTICS:]))
    fitted = rows.filter("NOT calibrates").select("label", "x")
    total = sum(np.frombuffer(r.total).reshape(FEATURES + 1, FEATURES + 2) for r in
                fitted.mapInArrow(_normal_sums(cosines), "total binary").collect())
    size = max(1.0, total[-1, -2])
    weights = np.linalg.solve(
        total[:, :-1] / size + RIDGE * np.diag([1.0] * FEATURES + [1e-6]), total[:, -1] / size)
    for_steps = rows.filter("calibrates")
    if not for_steps.take(1):
        for_steps = rows
    counts = (
        for_steps.select("label", "x")
        .mapInArrow(_ridge_scores(cosines, weights), "label int, raw double")
        .groupBy(_bin(F.col("raw")).alias("at")).agg(F.count("label").alias("n"), F.sum("label").alias("ones"))
        .collect()  # at most BINS + 1 rows
    )
    steps, values = isotonic([tuple(r) for r in counts])
    return {"cosines": cosines, "weights": weights, "steps": steps, "values": values}


def scores_of(model: dict, texts: list[str | None]) -> np.ndarray:
    if "constant" in model or not texts:
        return np.full(len(texts), float(model.get("constant", 0)))
    x = np.array([statistics(t) for t in texts])
    raw = np.clip(model["cosines"](x) @ model["weights"], -0.5, 1.5)
    # From one step's middle to the next the value rises evenly.
    return np.interp((raw + 0.5) / 2 * BINS, model["steps"] + 0.5, model["values"])


def _scores(model: dict):
    schema = arrow_schema("doc_id bigint, held_out boolean, score double")

    def run(rows):
        for batch in rows:
            found = scores_of(model, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], schema=schema)

    return run


def score(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    with_workers(spark)
    return (
        docs.select("doc_id", labelled.is_held_out(F.col("doc_id")).alias("held_out"), "text")
        .mapInArrow(_scores(model), "doc_id bigint, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document by a model of the labelled ones."""
    sample = labelled.training_labels(labels, "quality")
    return score(spark, docs, fit(spark, labelled.labelled_texts(docs, sample)))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that a model of the labelled ones does not reject, with all columns."""
    model = fit(spark, labelled.labelled_texts(docs, labelled.training_labels(labels, "quality")))

    def keeps(texts):
        return scores_of(model, texts) >= THRESHOLD

    return filter_texts(docs, lambda: keeps)
