"""Hierarchical weighted hash tree: region, rack, shard, drawn level by level.

At each node every child draws ``-ln(u) / weight`` with ``u`` hashed from the key and
the child's name; the least draw wins. The law is ``key``: the key and the tree alone
decide. A child whose weight changes moves rows only between itself and its siblings,
and below a node only what reached it is dealt again. One more shard joins as a region
of its own, so that rows move into it only.

Defined cases: a null text has no bytes and size 1; a null key is one key like any
other; repeated rows share a shard and take a slot each; of equal draws the child whose name sorts
first wins; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

#: {region: {rack: {shard: weight}}}
Tree = dict[str, dict[str, dict[int, float]]]

#: Slots are counted in so many parts of each shard.
PARTS = 4096


def tree_of(regions: int = 2, racks: int = 2, shards: int = 4) -> Tree:
    """A regular tree with shards of weight 1, numbered from 0."""
    return {
        f"region{r}": {
            f"rack{k}": {(r * racks + k) * shards + s: 1.0 for s in range(shards)}
            for k in range(racks)
        } for r in range(regions)
    }


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    shard = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return tree | {f"region{len(tree)}": {"rack0": {shard: weight}}}


def _draw(key: Column, children: dict[str, float]) -> Column:
    """Name of the child with the least weighted draw."""
    draws = []
    for name, weight in children.items():
        if weight <= 0:
            continue
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11)
        draws.append(F.struct(
            (-F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(float(weight))).alias("d"),
            F.lit(name).alias("name")))
    return F.array_min(F.array(*draws))["name"]


def _choose(at: Column, options: dict[str, Column]) -> Column:
    chosen = None
    for name, value in options.items():
        chosen = F.when(at == name, value) if chosen is None else chosen.when(at == name, value)
    return chosen


def with_shard(rows: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """Add the shard of each key; children of equal names in different nodes draw apart."""
    key_column = F.col(key)
    weights = {r: {f"{r}/{k}": sum(s.values()) for k, s in racks.items()}
               for r, racks in tree.items()}
    leaves = {f"{r}/{k}": {f"{r}/{k}/{s}": w for s, w in shards.items()}
              for r, racks in tree.items() for k, shards in racks.items()}
    region, rack = f"{out}_region", f"{out}_rack"
    return (
        rows
        .withColumn(region, _draw(key_column, {r: sum(w.values()) for r, w in weights.items()}))
        .withColumn(rack, _choose(
            F.col(region), {r: _draw(key_column, w) for r, w in weights.items()
                            if sum(w.values()) > 0}))
        .withColumn(out, F.element_at(F.split(_choose(
            F.col(rack), {k: _draw(key_column, w) for k, w in leaves.items()
                          if sum(w.values()) > 0}), "/"), -1).cast("int"))
        .drop(region, rack)
    )


def shard(spark: SparkSession, docs: DataFrame, tree: Tree | None = None) -> DataFrame:
    """Shard and slot of every document, and its shard once the tree has grown by one."""
    tree = tree or tree_of()
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    rows = with_shard(with_shard(rows, "doc_id", tree, "shard"), "doc_id", grown(tree), "grown_shard")
    kept = Scratch(spark, "sharding").keep(rows.withColumn(
        "part", F.pmod(F.xxhash64("row_no"), F.lit(PARTS)).cast("int")))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most PARTS rows for each shard.
    begins = (
        kept.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    )
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row_no"))
    return (
        kept.withColumn("place", place)
        .join(F.broadcast(begins), ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("begin") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard")
    )
