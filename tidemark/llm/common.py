"""Helpers of the operators in this folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder
from tidemark.sources import files

TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of texts that are sent to a Python task at once: both sides hold a batch whole.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
                "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def with_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver did, and
    send them small batches.

    On a cluster the package is shipped with ``--py-files``.
    """
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in BATCH_LIMITS.items():
        if not 0 < size(spark.conf.get(name)) <= most:
            spark.conf.set(name, str(most))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


class Scratch:
    """Tables written to the shared folder to cut lineage, each under a path of its own."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root, self.count = spark, shared_folder(spark, purpose), 0

    def keep(self, rows: DataFrame, name: str = "t") -> DataFrame:
        """Write rows and read them back; a lost executor costs no more than its tasks."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        rows.write.parquet(path)
        kept = self.spark.read.schema(rows.schema).parquet(path)
        kept.path_written = path
        return kept

    def drop(self, *kept: DataFrame) -> None:
        for one in kept:
            files.remove(self.spark, one.path_written)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_(), "binary": pa.binary()}


def arrow_schema(columns: str) -> pa.Schema:
    """Arrow schema of "name type, ..."; can be made without a session, as in a task."""
    def kind(name: str) -> pa.DataType:
        return pa.list_(kind(name[6:-1])) if name.startswith("array<") else _ARROW[name]

    return pa.schema([(c.split()[0], kind(c.split()[1])) for c in columns.split(", ")])


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of a bounded number of rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def filter_texts(docs: DataFrame, make: Callable[[], Callable[[list], np.ndarray]]) -> DataFrame:
    """Rows whose text passes, with all columns; ``make`` is called once in each task and
    gives the test of a list of texts."""
    at = docs.columns.index("text")

    def run(rows):
        passes = make()
        for batch in rows:
            yield batch.filter(pa.array(passes(batch.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def id_crc(doc_id: Column) -> Column:
    """crc32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


class WordCache(dict):
    """Values by word, of two bounded generations: words not met lately are forgotten."""

    def __init__(self, make, before: dict | None = None, most: int = 300_000):
        super().__init__()
        self.make, self.before, self.most = make, before or {}, most

    def __missing__(self, word):
        value = self.before.get(word)
        if value is None:
            value = self.make(word)
        self[word] = value
        return value

    def renewed(self) -> WordCache:
        """The cache to go on with; call it between texts."""
        if len(self) <= self.most:
            return self
        self.before = {}
        return WordCache(self.make, self, self.most)
