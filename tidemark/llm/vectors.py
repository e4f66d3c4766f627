"""Near-duplicate vectors by sorted projection passes.

Each sorted pass orders the distinct vectors by a chain of random hashes (the sides of random
planes, concatenated) and compares every vector with its neighbours in a window of
that order. That a pair is far apart there says nothing, so further passes compare
all vectors on the same sides of RUN_PLANES planes, block against block, however many they are:
two vectors at the cosine share a side with chance 1 - arccos(COSINE) / pi = 0.899, so
all RUN_PASSES passes part them with chance (1 - 0.899^RUN_PLANES)^RUN_PASSES < 1e-4, whatever
the number and the density of the vectors. What reaches the cosine is united across passes. An
exact count of the links inside every component follows, block by block.

Equal vectors are one until the end, so copies cost nothing.

Defined cases: a vector that is null, empty, zero or holds a null, a NaN or an infinity
links with nothing, nor does one without an id; vectors of different lengths never link; rows that
share an id and a vector count as two vectors; equal sort keys stand in any order, for what they
miss is found by whole runs; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_schema, with_workers
from tidemark.llm.components import components

COSINE = 0.95
PASSES = 8
#: Planes in a chain; one number holds their sides.
PLANES = 60
#: Neighbours on each side in the order.
WINDOW = 128
#: Planes whose sides make a run, all pairs of which are compared, and passes of them.
RUN_PLANES, RUN_PASSES = 12, 29
#: Vectors of a block when runs are compared and links are counted.
BLOCK = 1024


def _units(column) -> np.ndarray:
    """Unit rows in double precision; all vectors are of one length."""
    values = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _by_length(batch: pa.RecordBatch):
    lengths = np.asarray(pa.compute.list_value_length(batch.column("embedding")))
    for n in np.unique(lengths):
        yield int(n), batch.take(pa.array(np.flatnonzero(lengths == n)))


def _chains(number: int):
    """Add the chain of a pass."""
    def run(rows):
        for batch in rows:
            for length, part in _by_length(batch):
                planes = np.random.default_rng([number, length]).normal(size=(length, PLANES))
                sides = (_units(part.column("embedding")) @ planes > 0).astype(np.int64)
                chain = (sides << np.arange(PLANES - 1, -1, -1)).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("embedding"), pa.array(np.full(len(chain), length), pa.int32()),
                     pa.array(chain, pa.int64())], ["node", "embedding", "length", "chain"])

    return run


def _stars(nodes: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a small matrix as (node, smallest node of its part)."""
    label = np.arange(len(nodes))
    linked = linked | linked.T | np.eye(len(nodes), dtype=bool)
    while True:
        new = np.where(linked, label[None, :], len(nodes)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(int(nodes[k]), int(nodes[r])) for k, r in enumerate(label) if nodes[k] != nodes[r]]


def _neighbours(window: int, cosine: float):
    """Links between rows at most ``window`` apart in a sorted partition.

    A partition's edge parts neighbours in one pass; the other passes cut elsewhere.
    """
    schema = arrow_schema("a bigint, b bigint")

    def compare(nodes, units, fresh):
        near = units @ units.T >= cosine
        place = np.arange(len(nodes))
        near &= np.abs(place[:, None] - place[None, :]) <= window
        near[:len(nodes) - fresh, :len(nodes) - fresh] = False  # compared before
        return _stars(nodes, near)

    def run(rows):
        held_nodes, held, length = np.zeros(0, np.int64), None, None
        for batch in rows:
            for n, part in _by_length(batch):
                nodes, units = np.asarray(part.column("node")), _units(part.column("embedding"))
                if n != length:
                    held_nodes, held, length = nodes[:0], units[:0], n
                found: list[tuple[int, int]] = []
                for at in range(0, len(nodes), 2 * window):
                    some_nodes, some = nodes[at:at + 2 * window], units[at:at + 2 * window]
                    held_nodes, held = np.concatenate([held_nodes, some_nodes]), np.concatenate([held, some])
                    found += compare(held_nodes, held, len(some))
                    held_nodes, held = held_nodes[-window:], held[-window:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=schema)

    return run


def _runs(planes: int, passes: int):
    """The run of each vector in each pass: its length, the pass and its sides, as one number."""
    schema = arrow_schema("node bigint, run bigint")

    def run(rows):
        for batch in rows:
            for length, part in _by_length(batch):
                nodes, units = np.asarray(part.column("node")), _units(part.column("embedding"))
                for number in range(passes):
                    normals = np.random.default_rng([number, length, planes]).normal(size=(length, planes))
                    sides = ((units @ normals > 0).astype(np.int64) << np.arange(planes)).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes), pa.array(((length * passes + number) << planes) + sides)], schema=schema)

    return run


def _link_block(cosine: float):
    """Links between two blocks of each run of a group, as stars."""
    schema = arrow_schema("a bigint, b bigint")

    def run(key, rows):
        i, j = key[1].as_py(), key[2].as_py()
        rows = rows.combine_chunks().sort_by("run")
        runs, nodes, block = (np.asarray(rows.column(c)) for c in ("run", "node", "block"))
        embeddings = rows.column("embedding").combine_chunks()
        if isinstance(embeddings, pa.ChunkedArray):
            embeddings = pa.concat_arrays(embeddings.chunks)
        begins = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
        found: list[tuple[int, int]] = []
        for low, high in zip(begins, [*begins[1:], len(runs)]):
            units, here = _units(embeddings.slice(low, high - low)), block[low:high]
            a, b = np.flatnonzero(here == i), np.flatnonzero(here == j)
            near = units[a] @ units[b].T >= cosine
            near &= a[:, None] != b[None, :]
            at, to = a[near.any(axis=1)], b[near.any(axis=0)]
            if len(at):
                linked = np.union1d(at, to)
                square = np.zeros((len(linked), len(linked)), bool)
                square[np.ix_(np.searchsorted(linked, at), np.searchsorted(linked, to))] = (
                    near[near.any(axis=1)][:, near.any(axis=0)])
                order = np.argsort(nodes[low + linked])
                found += _stars(nodes[low + linked[order]], square[np.ix_(order, order)])
        return pa.Table.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=schema)

    return run


def _meeting(members: DataFrame, group: str, tasks: int) -> DataFrame:
    """Members of groups of known size, once for each pair of blocks that they take part in.

    A group is dealt out over blocks of bounded size and every two blocks meet in a
    task (task, i, j) of their own; small groups share tasks.
    """
    return (
        members.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("task", F.when(F.col("blocks") == 1, F.concat(F.lit("s"), F.pmod(F.xxhash64(group), F.lit(tasks))))
                    .otherwise(F.concat(F.lit("r"), F.col(group))))
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        .drop("size", "blocks", "other")
    )


def _in_runs(scratch: Scratch, classes: DataFrame, cosine: float, planes: int, passes: int) -> DataFrame:
    """Links between vectors of one run, as many as join what they join."""
    classes = classes.select("node", "embedding")
    keys = scratch.keep(classes.mapInArrow(_runs(planes, passes), "node bigint, run bigint"), "runs")
    sizes = keys.groupBy("run").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    tasks = max(1, keys.count() // BLOCK)
    members = keys.join(sizes, "run").join(classes, "node")
    links = scratch.keep(
        _meeting(members, "run", tasks).groupBy("task", "i", "j")
        .applyInArrow(_link_block(cosine), "a bigint, b bigint"), "links")
    scratch.drop(keys)
    return links


def _count_block(cosine: float):
    """For each vector of a group, the vectors that link with it, copies included."""
    schema = arrow_schema("node bigint, links bigint")

    def run(key, rows):
        i, j = key[1].as_py(), key[2].as_py()
        out: dict[int, int] = {}
        rows = rows.combine_chunks()
        lengths = np.asarray(pa.compute.list_value_length(rows.column("embedding")))
        for n in np.unique(lengths):
            part = rows.filter(pa.array(lengths == n))
            nodes, roots, copies, block = (
                np.asarray(part.column(c)) for c in ("node", "root", "copies", "block"))
            units = _units(part.column("embedding").combine_chunks())
            for left, right in {(i, j), (j, i)}:
                a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
                for at in range(0, len(a), BLOCK):
                    some = a[at:at + BLOCK]
                    near = units[some] @ units[b].T >= cosine
                    near &= roots[some][:, None] == roots[b][None, :]
                    near &= nodes[some][:, None] != nodes[b][None, :]
                    for node, links in zip(nodes[some], near @ copies[b]):
                        out[int(node)] = out.get(int(node), 0) + int(links)
        return pa.Table.from_arrays(
            [pa.array(list(out.keys()), pa.int64()), pa.array(list(out.values()), pa.int64())], schema=schema)

    return run


def _count_links(spark: SparkSession, classes: DataFrame, groups: DataFrame, cosine: float) -> DataFrame:
    """(node, links) of all vectors in components."""
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = groups.join(sizes, "root").join(classes, "node")
    meets = _meeting(members, "root", max(1, groups.count() // BLOCK))
    return (
        meets.groupBy("task", "i", "j").applyInArrow(_count_block(cosine), "node bigint, links bigint")
        .groupBy("node").agg(F.sum("links").alias("links"))
    )


def usable(embedding) -> F.Column:
    """True for a vector with a direction."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_duplicates(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE,
                    passes: int = PASSES, window: int = WINDOW, run_planes: int = RUN_PLANES,
                    run_passes: int = RUN_PASSES) -> DataFrame:
    """Links, component and survivor of every vector."""
    with_workers(spark)
    scratch = Scratch(spark, "vectors")
    vectors = vectors.select("vec_id", "embedding")
    good = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    classes = scratch.keep(good.groupBy("embedding").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "classes")
    links = [
        scratch.keep(
            classes.select("node", "embedding")
            .mapInArrow(_chains(number), "node bigint, embedding array<float>, length int, chain bigint")
            .repartitionByRange("length", "chain", "node").sortWithinPartitions("length", "chain", "node")
            .mapInArrow(_neighbours(window, cosine), "a bigint, b bigint"), f"pass{number}")
        for number in range(passes)
    ]
    links.append(_in_runs(scratch, classes, cosine, run_planes, run_passes))
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    groups = components(scratch, found)
    scratch.drop(*links)
    counted = scratch.keep(_count_links(spark, classes, groups, cosine), "counted")
    known = (
        classes.join(groups, "node", "left").join(counted, "node", "left")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("root", "node").alias("component_id"))
    )
    linked = good.join(known, "embedding").select("vec_id", "n_links", "component_id")
    alone = vectors.filter(~(usable(F.col("embedding")) & F.col("vec_id").isNotNull())).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
