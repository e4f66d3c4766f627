"""Source divergence audit with late string materialization.

How far do the sources of a language differ in the words they use, and which words set a
source apart? Every group (lang, source) and every language gives each kept term a
probability in whole parts of a thousand million, and divergences are sums of
``f(p, q) = (p - q)^2 div (p + q)``: exact integers, whatever the order of addition.

1. One scan counts terms by group inside each task and writes what it found.
2. Counts meet by a digest of 64 bits; no string of a term is shuffled for them. Terms of
   too few documents of a language fall away here.
3. For the digests that are left the least and the greatest string are taken. Where they
   differ, terms share the digest: those few are counted again by their strings.
4. Strings come back only for the terms that a report prints, and for ties at its end.

The divergence of two sources runs over all kept terms, but most terms occur in few
sources, so it is summed from what differs from the value of an absent term:
``V * f0`` for all terms, a correction by source from the counted probabilities (there
are few different ones), and one more for the terms that both hold.

Defined cases: null text, lang and source are ''; a group without terms takes part with
count 0; a language without kept terms has value 0 for its pairs; equal values are ranked
by the item's bytes; repeated rows count each; a text of any length is read whole; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_schema, with_workers

PARTS = 1_000_000_000
LEAST_DOCS, MOST_TERMS = 10, 10
#: Entries of the counters of one task before it gives them away.
ENTRIES = 1_000_000
#: Bytes of a text whose terms are held at once.
STRETCH = 1 << 20
#: Pairs of holders that a task computes at once.
PAIRS = 1_000_000

OCCURRENCES = "lang string, source string, term string, found bigint, docs bigint"

# Letters and all bytes beyond ASCII stay, A to Z in lower case; the rest is a gap.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str) -> Iterator[list[bytes]]:
    """Terms of a text in lists of bounded size."""
    folded = text.encode("utf-8").translate(_FOLDED)
    at = 0
    while at < len(folded):
        end = at + STRETCH
        if end < len(folded):
            gap = folded.find(b" ", end)
            end = len(folded) if gap < 0 else gap
        yield folded[at:end].split()
        at = end


def _occurrences(rows):
    """Terms by group, added up within a task as far as memory should go."""
    schema = arrow_schema(OCCURRENCES)
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def given():
        nonlocal size
        for (lang, source), (found, docs) in groups.items():
            terms = [None, *found]
            numbers = [0, *found.values()], [0, *map(docs.__getitem__, found)]
            for k in range(0, len(terms), 50_000):
                part = terms[k:k + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.string()), *(pa.array(n[k:k + 50_000], pa.int64()) for n in numbers),
                ], schema=schema)
        groups.clear()
        size = 0

    for batch in rows:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            key = (lang or "", source or "")
            if key not in groups:
                groups[key] = Counter(), Counter()
            found, docs = groups[key]
            before, here = len(found), set()
            for terms in terms_of(text.as_py() or ""):
                found.update(terms)
                here.update(terms)
            docs.update(here)
            size += len(found) - before
            if size > ENTRIES:
                yield from given()
    yield from given()


def _holders(occurrences: DataFrame, key: str) -> DataFrame:
    """Kept terms by ``key``, each with the sources that hold it."""
    by_source = occurrences.groupBy("lang", key, "source").agg(
        F.sum("found").alias("found"), F.sum("docs").alias("docs"))
    return (
        by_source.groupBy("lang", key).agg(
            F.sum("docs").alias("docs"), F.sum("found").alias("total"),
            F.collect_list(F.struct("source", "found")).alias("holders"))
        .filter(F.col("docs") >= LEAST_DOCS).drop("docs")
    )


def _share(found: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(PARTS * (found + 2) / (total + 2 * kept))`` without overflow."""
    over = F.lit(PARTS).cast("decimal(10,0)") * (found + 2).cast("decimal(19,0)")
    # Null where a language keeps no term.
    under = F.nullif((total + 2 * kept).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.call_function("div", over, under) + 1


def _apart(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _held_by_both(rows):
    """Sums over terms of what a term held by both of two sources adds, by (lang, a, b), a < b."""
    schema = arrow_schema("lang string, a bigint, b bigint, value bigint")
    for batch in rows:
        langs = batch.column(0).to_pylist()
        lists = batch.column(1)
        sizes = np.diff(lists.offsets.to_numpy())
        held = lists.flatten()
        no, p, p0 = (held.field(k).to_numpy() for k in range(3))
        ends = np.repeat(np.cumsum(sizes), sizes)
        partners = ends - np.arange(len(no)) - 1  # holders of the same term further on
        place = {name: k for k, name in enumerate(dict.fromkeys(langs))}
        lang = np.repeat([place[name] for name in langs], sizes)
        names = list(place)
        at = 0
        upto = np.cumsum(partners)
        while at < len(no):
            done = upto[at] - partners[at]
            end = max(at + 1, int(np.searchsorted(upto, done + PAIRS, side="right")))
            left = np.repeat(np.arange(at, end), partners[at:end])
            step = np.arange(len(left)) - np.repeat(upto[at:end] - partners[at:end] - done, partners[at:end])
            at = end
            if not len(left):
                continue
            right = left + 1 + step
            value = (_far(p[left], p[right]) - _far(p[left], p0[right])
                     - _far(p0[left], p[right]) + _far(p0[left], p0[right]))
            order = np.lexsort((no[right], no[left], lang[left]))
            keys = np.stack([lang[left], no[left], no[right]])[:, order]
            begins = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            sums = np.add.reduceat(value[order], begins)
            yield pa.RecordBatch.from_arrays([
                pa.array([names[k] for k in keys[0, begins]], pa.string()),
                pa.array(keys[1, begins], pa.int64()), pa.array(keys[2, begins], pa.int64()),
                pa.array(sums, pa.int64())], schema=schema)


def kept_terms(spark: SparkSession, occurrences: DataFrame, scratch: Scratch,
               bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Kept terms with their holders, and the string of every digest.

    ``text`` is set only where terms share a digest and are told apart by their strings.
    """
    named = occurrences.filter("term IS NOT NULL").withColumn(
        "digest", F.shiftrightunsigned(F.xxhash64("term"), 64 - bits))
    terms = scratch.keep(_holders(named.drop("term"), "digest"), "terms")
    dictionary = scratch.keep(
        named.select("digest", "term")
        .join(terms.select("digest").distinct(), "digest", "left_semi")
        .groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "dictionary")
    shared = dictionary.filter("low <> high").select("digest")
    terms = terms.withColumn("text", F.lit(None).cast("string"))
    if not shared.isEmpty():
        again = _holders(named.join(shared, "digest", "left_semi").drop("digest"), "term")
        terms = terms.join(shared, "digest", "left_anti").unionByName(again.select(
            "lang", F.lit(None).cast("bigint").alias("digest"), "total", "holders",
            F.col("term").alias("text")))
        terms = scratch.keep(terms, "terms-apart")
    return terms, dictionary.select("digest", F.col("low").alias("string"))


def audit(spark: SparkSession, docs: DataFrame, most_terms: int = MOST_TERMS, bits: int = 64) -> DataFrame:
    """Divergence of each source from each other one, and the terms that set it apart."""
    with_workers(spark)
    scratch = Scratch(spark, "divergence")
    occurrences = scratch.keep(
        docs.select("lang", "source", "text").mapInArrow(_occurrences, OCCURRENCES), "occurrences")
    terms, strings = kept_terms(spark, occurrences, scratch, bits)
    held = terms.select("lang", "digest", "text", "total", F.explode("holders").alias("h")).select(
        "lang", "digest", "text", "total", "h.*")
    zero = F.lit(0).cast("bigint")
    # One row for each group, numbered within its language.
    sizes = (
        occurrences.select("lang", "source").distinct()
        .join(held.groupBy("lang", "source").agg(F.sum("found").alias("n")), ["lang", "source"], "left")
        .join(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("n_lang")),
              "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "kept", "n_lang")])
    )
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint")
    groups = scratch.keep(
        sizes.withColumn("no", number).withColumn("p0", _share(zero, F.col("n"), F.col("kept"))), "groups")
    shares = scratch.keep(
        held.join(groups, ["lang", "source"]).select(
            "lang", "source", "digest", "text", "no", "p0",
            _share(F.col("found"), F.col("n"), F.col("kept")).alias("p"),
            _share(F.col("total"), F.col("n_lang"), F.col("kept")).alias("q")), "shares")
    return _pairs(groups, shares).unionByName(_telling(shares, strings, most_terms))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    mine = groups.select("lang", F.col("no").alias("a"), F.col("p0").alias("a0"), "kept", "source")
    other = groups.select("lang", F.col("no").alias("b"), F.col("p0").alias("b0"), F.col("source").alias("item"))
    absent = mine.join(other, "lang").filter("a <> b")
    every = absent.select(
        "lang", "a", "b", F.coalesce(F.col("kept") * _apart("a0", "b0"), F.lit(0)).alias("value"))
    # A source has few different probabilities, one for each count that occurs in it.
    counted = shares.groupBy("lang", F.col("no").alias("a"), "p", F.col("p0").alias("a0")).agg(
        F.count(F.lit(1)).alias("terms"))
    own = counted.join(other, "lang").filter("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.col("terms") * (_apart("p", "b0") - _apart("a0", "b0"))).alias("value"))
    both = (
        shares.groupBy("lang", "digest", "text")
        .agg(F.sort_array(F.collect_list(F.struct("no", "p", "p0"))).alias("held"))
        .filter(F.size("held") > 1).select("lang", "held")
        .mapInArrow(_held_by_both, "lang string, a bigint, b bigint, value bigint")
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )
    swapped = [part.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value") for part in (own, both)]
    summed = (
        every.unionByName(own).unionByName(both).unionByName(swapped[0]).unionByName(swapped[1])
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return (
        summed.join(absent.select("lang", "a", "b", "source", "item"), ["lang", "a", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                F.row_number().over(ranked).alias("rank"))
    )


def _telling(shares: DataFrame, strings: DataFrame, most: int) -> DataFrame:
    """The first terms of each group by value; only these and ties at the end get strings."""
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    first = (
        shares.filter("p > q").withColumn("value", _apart("p", "q"))
        .withColumn("place", F.rank().over(by_value)).filter(F.col("place") <= most)
    )
    named = first.join(strings, "digest", "left").withColumn("item", F.coalesce("text", "string"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return (
        named.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= most)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text
  FROM documents
), words AS (
  SELECT doc, lang, source, translate(
    unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM words GROUP BY ALL
  HAVING count(DISTINCT doc) >= {LEAST_DOCS}
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), found AS (
  SELECT lang, source, term, count(*) AS found FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM d
), counts AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(f.found, 0)::HUGEINT AS found
  FROM groups g JOIN kept k USING (lang) LEFT JOIN found f USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, found, 1 + {PARTS} * (found + 2) // (sum(found) OVER (PARTITION BY lang, source) + 2 * v) AS p,
         1 + {PARTS} * (total + 2) // (n + 2 * v) AS q
  FROM counts JOIN langs USING (lang)
), pairs AS (
  SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM every
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE found > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {MOST_TERMS}"""
