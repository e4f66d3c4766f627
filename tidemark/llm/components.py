"""Connected components by hooking and pointer jumping, all in tables.

Every node points to a smaller or equal node. In each round a node and the node it
points to are hooked onto the smallest grandparent among their neighbours, and every
pointer jumps to the pointer it points to. Pointers only fall, so their sum stands
still exactly when all nodes point to the smallest node of their component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_schema, batches

#: Nodes that a task unites at once.
TOGETHER = 500_000


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, root) of every node that occurs in links (a, b); root is the smallest node.

    Links are first united within each task, which leaves a star for each part of a
    component. Hot roots are handled by joins, which Spark splits, and sums before the
    shuffle.
    """
    both = scratch.keep(links.select("a", "b").mapInArrow(_united, "a bigint, b bigint"), "links")
    points = scratch.keep(both.groupBy("a").agg(F.min("b").alias("least"))
                          .select(F.col("a").alias("node"), F.least("a", "least").alias("root")))
    total = _total(points)
    while total is not None:
        up = points.select(F.col("node").alias("up"), F.col("root").alias("grand"))
        jumped = points.join(up, F.col("root") == F.col("up")).select("node", "root", "grand")
        seen = (
            both.join(jumped.select(F.col("node").alias("b"), "grand"), "b")
            .groupBy("a").agg(F.min("grand").alias("best"))
        )
        hooked = jumped.join(seen, F.col("node") == F.col("a")).select(
            "node", "root", F.least("best", "grand").alias("best"))
        moved = scratch.keep(
            hooked.select(F.explode(F.array("node", "root")).alias("node"), "best")
            .groupBy("node").agg(F.min("best").alias("root")))
        scratch.drop(points)
        points, now = moved, _total(moved)
        if now == total:
            break
        total = now
    scratch.drop(both)
    return points


def _united(rows):
    """Links of a task as pairs, in both directions, of a node and the smallest node it is
    linked with there.

    When a task has met many nodes it gives their stars and begins anew.
    """
    schema, up = arrow_schema("a bigint, b bigint"), {}

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def given():
        pairs = [(x, top(x)) for x in up]
        up.clear()
        both = (p for x, r in pairs if x != r for p in ((x, r), (r, x)))
        return batches(both, schema, 50_000)

    for batch in rows:
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            up.setdefault(a, a)
            up.setdefault(b, b)
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
        if len(up) > TOGETHER:
            yield from given()
    yield from given()


def _total(points: DataFrame):
    return points.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
