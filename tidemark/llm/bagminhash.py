"""Near-duplicate documents by BagMinHash over five-word shingles with their counts.

The weight of a shingle is how often the text holds it. Weights are split into
intervals that double in length: [0, 1), [1, 2), [2, 4), ... Each shingle has a Poisson
process over each interval, for all signature places at once; points beyond the weight
are thinned out, and a process stops as soon as its times pass the largest place of
the signature. A place keeps its earliest point, so two signatures agree at a place
with the probability of the weighted Jaccard similarity of the texts.

Signatures are cut into bands; equal bands make candidates, whose multisets are compared
exactly. In a group of equal bands every document first meets its neighbour by number and
the group's centre, the one that shares its bands most widely: most often the original of
the copies. That joins a group of near copies in about as many comparisons as it has rows.
Then, wherever a group still holds several components, all documents of different ones
meet: in small groups at once; in larger ones block against block, by their signatures
and exactly if these leave a chance: a pair of the wanted similarity lies below that bound
with a chance of 1.7e-6. So the size of its group adds that to the 5e-5 with which such a
pair shares no band; pairs of one component are not compared again, and copies are compared once.

Words are lower-cased and parted by white space; a text of fewer than five words is one
shingle. Defined cases: null, empty and blank texts are alone in their groups; rows are
told apart by their place in the table, so repeated ids and null ids are safe, and a
group is named by its smallest id (null if all are null); a text of any length is
compared whole; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, WordCache, arrow_schema, batches, with_workers
from tidemark.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
#: Rows of a group of equal bands in which all pairs of different components meet at once.
SMALL = 8
#: Documents of a block of a larger group.
BLOCK = 256
#: Standard errors that the share of equal places may lie below the similarity.
ERRORS = 5.0
#: Shingles whose processes run together in a task.
TOGETHER = 200_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _step(n: int) -> np.uint64:
    return np.uint64(int(GOLDEN) * n % 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def shingles(words: list[str], hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles and their counts; ``hashes`` gives a word's hash."""
    word = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        total = mixed(total * GOLDEN + word[k:k + n] + np.uint64(k + 1))
    return np.unique(total, return_counts=True)


def signatures(documents: list[tuple[np.ndarray, np.ndarray]], places: int) -> np.ndarray:
    """Earliest points, one row for each document of (shingles, counts)."""
    doc = np.repeat(np.arange(len(documents)), [len(d[0]) for d in documents])
    seed = np.concatenate([d[0] for d in documents])
    weight = np.concatenate([d[1] for d in documents])
    parts, begin, length = [], 0, 1
    while (inside := np.flatnonzero(weight > begin)).size:
        level = mixed(seed[inside] + _step(begin + 1))
        parts.append((level, doc[inside], weight[inside], np.full(inside.size, begin), np.full(inside.size, length)))
        begin, length = begin + length, max(1, begin + length)
    seed, doc, weight, begin, length = (np.concatenate(p) for p in zip(*parts))
    time = np.zeros(len(seed))
    earliest = np.full(len(documents) * places, np.inf)
    step = 0
    while len(seed):
        step += 1
        draw = mixed(seed + _step(2 * step))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / (places * length)
        active = time < earliest.reshape(-1, places).max(axis=1)[doc]
        seed, doc, weight, begin, length, time = (
            x[active] for x in (seed, doc, weight, begin, length, time))
        draw = mixed(seed + _step(2 * step + 1))
        place = ((draw >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)
        at = begin + ((draw & np.uint64(0xFFFFFFFF)) * length.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        kept = at < weight
        np.minimum.at(earliest, doc[kept] * places + place[kept], time[kept])
    return earliest.reshape(-1, places)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number for each band of each signature; different bands never mean the same."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2])
    for k in range(rows):
        key = mixed(key * GOLDEN + bits[:, :, k])
    return key.view(np.int64)


def similarity(a: list[str], b: list[str]) -> float:
    """Weighted Jaccard similarity of the shingles of two lists of words."""
    one, two = (Counter(tuple(w[k:k + SHINGLE]) for k in range(max(1, len(w) - SHINGLE + 1)))
                if w else Counter() for w in (a, b))
    if len(one) > len(two):
        one, two = two, one
    common = sum(min(n, two[s]) for s, n in one.items() if s in two)
    total = one.total() + two.total() - common
    return common / total if total else 0.0


SIGNED = "row_no bigint, doc_id bigint, digest binary, bands array<bigint>, places binary, size bigint"


def _sign(bands: int, rows: int):
    schema = arrow_schema(SIGNED)

    def run(incoming):
        hashes = WordCache(xxhash.xxh3_64_intdigest)
        held: list[tuple] = []
        documents: list[tuple[np.ndarray, np.ndarray]] = []

        def finish():
            found = signatures(documents, bands * rows) if documents else np.zeros((0, bands * rows))
            short = (mixed(found.view(np.uint64)) >> np.uint64(48)).astype("<u2")
            made = zip(band_keys(found, bands, rows), short, documents)
            out = []
            for h in held:
                keys, places, (_, counts) = next(made) if h[2] is not None else (None, None, (None, None))
                out.append((*h, keys, None if places is None else places.tobytes(),
                            None if counts is None else int(counts.sum())))
            held.clear()
            documents.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], schema.field(k).type) for k in range(6)], schema=schema)

        size = 0
        for batch in incoming:
            for row_no, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = words_of(text.as_py())
                hashes = hashes.renewed()
                digest = hashlib.md5(" ".join(words).encode("utf-8")).digest() if words else None
                held.append((row_no, doc_id, digest))
                if words:
                    documents.append(shingles(words, hashes))
                    size += len(documents[-1][0])
                if size > TOGETHER or len(held) >= 1000:
                    yield finish()
                    size = 0
        if held:
            yield finish()

    return run


def _chain(rows):
    """Rows of groups of two or more in a partition sorted by (band, node), with the one before.

    A partition's first and last row are always given, for their groups may go on in others.
    """
    schema = arrow_schema("band bigint, node bigint, previous bigint")
    last_band = last_node = None
    pending = False  # the last row has begun a group and is not given yet
    for batch in rows:
        if not batch.num_rows:
            continue
        band, node = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        same = np.empty(len(band), bool)
        same[0] = last_band is not None and band[0] == last_band
        same[1:] = band[1:] == band[:-1]
        before = np.concatenate([[last_node if last_node is not None else -1], node[:-1]])
        first = np.zeros(len(band), bool)
        first[:-1] = ~same[:-1] & same[1:]
        first[0] |= last_band is None
        given = np.flatnonzero(same | first)
        lead = pending and same[0]
        bands, nodes = band[given], node[given]
        previous = [int(before[k]) if same[k] else None for k in given]
        if lead:
            bands, nodes = np.concatenate([[last_band], bands]), np.concatenate([[last_node], nodes])
            previous = [None, *previous]
        pending = not (same | first)[-1]
        last_band, last_node = band[-1], node[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bands), pa.array(nodes), pa.array(previous, pa.int64())], schema=schema)
    if pending:
        yield pa.RecordBatch.from_arrays(
            [pa.array([last_band], pa.int64()), pa.array([last_node], pa.int64()), pa.array([None], pa.int64())],
            schema=schema)


def _with_centre(shared: DataFrame) -> DataFrame:
    """Pairs of each row of a group with the group's centre."""
    sizes = shared.groupBy("band").agg(F.count("node").alias("n"))
    reach = shared.join(sizes, "band").groupBy("node").agg(F.sum("n").alias("reach"))
    centres = (
        shared.join(reach, "node").groupBy("band")
        .agg(F.max(F.struct("reach", (-F.col("node")).alias("last")))["last"].alias("last"))
        .select("band", (-F.col("last")).alias("centre"))
    )
    return shared.join(centres, "band").filter("node <> centre").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))


def _across(rows):
    """All pairs of different components in small groups, sorted by (band, root, node)."""
    now, seen = None, []

    def out():
        nonlocal now, seen
        for batch in rows:
            for band, root, node in zip(*(c.to_pylist() for c in batch.columns)):
                if band != now:
                    now, seen = band, []
                for other_root, other in seen:
                    if other_root != root:
                        yield (node, other) if node < other else (other, node)
                seen.append((root, node))

    yield from batches(out(), arrow_schema("a bigint, b bigint"))


def fewest_places(least: float, places: int) -> float:
    """Equal places below which two documents of a large group are not compared exactly."""
    return places * max(0.0, least - ERRORS * np.sqrt(least * (1 - least) / places))


def _blocks(least: float, places: int):
    """Links between different components of two blocks, as many as join what they join.

    Signatures and sizes rule out most pairs; the others are compared exactly.
    """
    enough = fewest_places(least, places)

    def run(key, rows):
        i, j = key[1].as_py(), key[2].as_py()
        node, root, block, size = (rows.column(c).to_numpy() for c in ("node", "root", "block", "size"))
        seen = np.frombuffer(b"".join(rows.column("places").to_pylist()), "<u2").reshape(len(node), places)
        texts, hashes = rows.column("text"), WordCache(xxhash.xxh3_64_intdigest)
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        joined = {r: r for r in root.tolist()}

        def top(r: int) -> int:
            while joined[r] != r:
                joined[r] = r = joined[joined[r]]
            return r

        def bag(k: int) -> tuple[np.ndarray, np.ndarray]:
            if k not in known:
                known[k] = shingles(words_of(texts[k].as_py()), hashes)
            return known[k]

        def similar(x: int, y: int) -> bool:
            (a, n), (b, m) = bag(x), bag(y)
            _, at, bt = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            common = int(np.minimum(n[at], m[bt]).sum())
            return common >= least * (int(n.sum()) + int(m.sum()) - common)

        links = []
        one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
        for x in one.tolist():
            others = two[(root[two] != root[x]) & ((node[two] > node[x]) if i == j else True)]
            others = others[np.minimum(size[others], size[x]) >= least * np.maximum(size[others], size[x])]
            others = others[(seen[others] == seen[x]).sum(axis=1) >= enough]
            for y in others.tolist():
                p, q = top(int(root[x])), top(int(root[y]))
                if p != q and similar(x, y):
                    joined[max(p, q)] = min(p, q)
                    links.append((int(node[x]), int(node[y])))
        return pa.table(
            [pa.array([e[k] for e in links], pa.int64()) for k in (0, 1)], schema=arrow_schema("a bigint, b bigint"))

    return run


def _in_large_groups(scratch: Scratch, rows: DataFrame, signed: DataFrame, texts: DataFrame,
                     least: float, places: int) -> DataFrame:
    """Links between the components that meet in large groups.

    Groups that share a component are one cluster, so two documents meet once, however
    many bands they share. A cluster is dealt out over blocks and every two blocks meet in a
    task of their own, with their texts.
    """
    firsts = rows.groupBy("band").agg(F.min("root").alias("a"))
    clusters = components(
        scratch, rows.join(firsts, "band").select("a", F.col("root").alias("b")).filter("a <> b").distinct())
    placed = rows.select("node", "root").distinct().join(
        clusters.select(F.col("node").alias("root"), F.col("root").alias("cluster")), "root")
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    members = (
        placed.join(sizes, "cluster")
        .join(signed.select(F.col("row_no").alias("node"), "places", "size"), "node")
        .join(texts.withColumnRenamed("row_no", "node"), "node")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    return (
        members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "node", "root", "block", "size", "places", "text")
        .groupBy("cluster", "i", "j").applyInArrow(_blocks(least, places), "a bigint, b bigint")
    )


def _in_small_groups(rows: DataFrame) -> DataFrame:
    """Pairs of documents of different components that share a band of a small group."""
    return (
        rows.select("band", "root", "node")
        .repartitionByRange("band").sortWithinPartitions("band", "root", "node")
        .mapInArrow(_across, "a bigint, b bigint").distinct()
    )


def _verify(least: float):
    def run(rows):
        def out():
            for batch in rows:
                a, b, one, two = batch.columns
                for x, y, s, t in zip(a.to_pylist(), b.to_pylist(), one, two):
                    if similarity(words_of(s.as_py()), words_of(t.as_py())) >= least:
                        yield x, y

        yield from batches(out(), arrow_schema("a bigint, b bigint"))

    return run


def _linked(texts: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The pairs whose similarity is enough."""
    def side(name: str) -> DataFrame:
        return texts.select(F.col("row_no").alias(name), F.col("text").alias(f"text_{name}"))

    return (
        pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
        .mapInArrow(_verify(least), "a bigint, b bigint")
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, least: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(row_no, doc_id, copy_of, group_id, kept) of every row of a table that is read twice.

    ``row_no`` is ``monotonically_increasing_id`` of the table; ``copy_of`` the smallest
    id with the same words; one row of each group is kept, that of the smallest id.
    """
    with_workers(spark)
    scratch = Scratch(spark, "bagminhash")
    texts = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "text")
    signed = scratch.keep(texts.mapInArrow(_sign(bands, rows), SIGNED), "signed")
    copies = scratch.keep(
        signed.filter("digest IS NOT NULL").groupBy("digest")
        .agg(F.min("row_no").alias("node"), F.min("doc_id").alias("copy_of")), "copies")
    banded = (
        signed.join(copies.select(F.col("node").alias("row_no")), "row_no", "left_semi")
        .select(F.explode("bands").alias("band"), F.col("row_no").alias("node"))
    )
    shared = scratch.keep(
        banded.repartitionByRange("band", "node").sortWithinPartitions("band", "node")
        .mapInArrow(_chain, "band bigint, node bigint, previous bigint"), "shared")
    pairs = scratch.keep(
        shared.filter("previous IS NOT NULL").select(F.col("previous").alias("a"), F.col("node").alias("b"))
        .unionByName(_with_centre(shared)).distinct(), "pairs")
    some = scratch.keep(
        texts.join(shared.select(F.col("node").alias("row_no")).distinct(), "row_no", "left_semi")
        .select("row_no", "text"), "texts")
    links = scratch.keep(_linked(some, pairs, least), "links")
    parts = components(scratch, links)
    meeting = shared.select("band", "node").join(parts, "node", "left").select(
        "band", F.coalesce("root", "node").alias("root"), "node")
    groups = (
        meeting.groupBy("band").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count("root").alias("n"))
        .filter("low < high").select("band", "n")
    )
    meeting = scratch.keep(meeting.join(groups, "band"), "meeting")
    across = scratch.keep(_in_small_groups(meeting.filter(F.col("n") <= SMALL)).join(
        pairs, ["a", "b"], "left_anti"), "across")
    more = scratch.keep(_linked(some, across, least).unionByName(_in_large_groups(
        scratch, meeting.filter(F.col("n") > SMALL), signed, some, least, bands * rows)), "more")
    scratch.drop(shared, pairs, some, meeting, across, links)
    stars, parts = parts, components(scratch, more.unionByName(
        parts.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))))
    members = scratch.keep(
        signed.select("row_no", "doc_id", "digest").join(copies, "digest", "left")
        .join(parts, "node", "left")
        .select("row_no", "doc_id", F.coalesce("copy_of", "doc_id").alias("copy_of"),
                F.coalesce("root", "node", "row_no").alias("root")), "members")
    scratch.drop(signed, copies, more, stars, parts)
    groups = members.groupBy("root").agg(
        F.min("doc_id").alias("group_id"),
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no")))["row_no"].alias("survivor"))
    return members.join(groups, "root").select(
        "row_no", "doc_id", "copy_of", "group_id", (F.col("row_no") == F.col("survivor")).alias("kept"))


def deduplicate(spark: SparkSession, docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each group of near copies, with all its columns."""
    number, kept = "row_no", near_duplicates(spark, docs, least).filter("kept").select("row_no")
    while number in docs.columns:
        number += "_"
    numbered = docs.withColumn(number, F.monotonically_increasing_id())
    return numbered.join(
        kept.withColumnRenamed("row_no", number), number, "left_semi").drop(number)
