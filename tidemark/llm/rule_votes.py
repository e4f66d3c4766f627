"""Quality rules that vote: weak supervision in place of rules that must all pass.

Every rule looks at a few measures of a text and votes 1 (good), 0 (bad) or abstains
(null). How far a rule can be trusted is not given but estimated: a text's quality is
a hidden class, and expectation-maximisation finds the share of good texts, how often
each rule is right on good ones and how often on bad ones. A text's posterior
probability of being good then weighs all votes; one odd rule no longer discards a text.

The texts enter the estimate by the pattern of their votes, so each round is one
aggregate over at most ``3 ** rules`` counted patterns, and its sums, a few numbers for
each rule, are the literals of the next round. Everything is built-in functions: the
measures are array functions of one row, nothing of a text is shuffled.

Defined cases: a null or empty text has no words and fails the base rules; repeated
rows and null ids are judged each by itself; a text of any length is measured whole;
equal votes give equal posteriors, and one of exactly the threshold is good; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

SPACE = r"[\x20\x09-\x0D]"
#: Words without a letter: only ASCII signs, digits and controls between white space.
SIGNS_ONLY = (r"(?<![^\x20\x09-\x0D])[\x00-\x08\x0E-\x1F\x21-\x40\x5B-\x60\x7B-\x7F]++"
              r"(?![^\x20\x09-\x0D])")
#: All but ASCII signs and capitals.
NEITHER_SIGN_NOR_CAPITAL = r"[^\x21-\x2F\x3A-\x60\x7B-\x7E]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "#*$%&|<>"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEAST_WORDS, MOST_REPEATED = 50, 50


@dataclass(frozen=True)
class Rule:
    """Conditions in SQL on the measures; a text that meets neither gets no vote."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), 0).when(F.expr(self.good), 1).cast("tinyint")


#: Whole numbers only, so that the votes are the same on every engine.
RULES = (
    Rule("length", "n_words < 50", "n_words >= 100"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words",
         "word_chars BETWEEN 4 * n_words AND 6 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "n_symbols = 0"),
    Rule("signs", "100 * n_signs > 15 * word_chars", "100 * n_signs <= 8 * word_chars"),
    Rule("lettered", "100 * n_unlettered > 20 * n_words", "100 * n_unlettered <= 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines", "n_dup_lines = 0"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    Rule("shouting", "100 * n_capitals > 20 * word_chars OR 100 * n_shouts > 20 * n_words",
         "100 * n_capitals <= 5 * word_chars AND 100 * n_shouts <= 5 * n_words"),
    Rule("sentences", "100 * n_ends < 2 * n_words OR 100 * n_ends > 50 * n_words",
         "100 * n_ends BETWEEN 4 * n_words AND 20 * n_words"),
)


@dataclass(frozen=True)
class Belief:
    """What is assumed before any vote is seen, and the weight of it as a share of all texts."""

    good_share: float = 0.8
    right_on_good: float = 0.98
    right_on_bad: float = 0.4
    share_weight: float = 0.02
    good_weight: float = 0.5
    bad_weight: float = 0.05


@dataclass(frozen=True)
class Estimate:
    """Share of good texts; by rule how often a vote is right on good and on bad texts."""

    good_share: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]


def _without(text: Column, signs: str) -> Column:
    return F.length(F.translate(text, signs, ""))


def measures(docs: DataFrame) -> DataFrame:
    """Whole-number measures of every text, beside its ``doc_id``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", text.alias("text"))
    split = read.select(
        "doc_id",
        F.array_remove(F.split("text", SPACE + "+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_replace("text", NEITHER_SIGN_NOR_CAPITAL, "").alias("signs"),
        F.regexp_count("text", F.lit(SIGNS_ONLY)).alias("n_unlettered"),
    )
    # Three-word windows in order, equal ones side by side; the place is the last part.
    windows = split.select(
        "doc_id", "signs", F.col("n_unlettered").cast("bigint"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("words") >= 3, F.sort_array(F.expr(
            "arrays_zip(slice(words, 1, size(words) - 2), slice(words, 2, size(words) - 2), "
            "slice(words, 3, size(words) - 2), sequence(1, size(words) - 2))"))).alias("windows"),
    )
    same = "(w.`{0}` = windows[i + {1}].`{0}`)"
    equal = {step: " AND ".join(same.format(k, step) for k in (0, 1, 2)) for step in (-1, 1)}
    found = windows.withColumn("found", F.expr(
        f"filter(windows, (w, i) -> (i > 0 AND {equal[-1]}) "
        f"OR (i + 1 < size(windows) AND {equal[1]}))"))
    return found.select(
        "doc_id", "n_words", "word_chars",
        (F.length("signs") - _without(F.col("signs"), SYMBOLS)).cast("bigint").alias("n_symbols"),
        "n_dup_lines",
        F.coalesce(F.size(F.array_distinct(F.flatten(F.expr(
            "transform(found, w -> array(w.`3`, w.`3` + 1, w.`3` + 2))")))), F.lit(0))
        .cast("bigint").alias("n_repeat_words"),
        "n_lines", "n_unlettered",
        _without(F.col("signs"), CAPITALS).cast("bigint").alias("n_signs"),
        (F.length("signs") - _without(F.col("signs"), CAPITALS)).cast("bigint").alias("n_capitals"),
        (F.length("signs") - _without(F.col("signs"), "!")).cast("bigint").alias("n_shouts"),
        (F.length("signs") - _without(F.col("signs"), ".!?")).cast("bigint").alias("n_ends"),
    )


def posterior(rules: tuple[Rule, ...], known: Estimate) -> Column:
    """Probability that a text with these votes is good."""
    odds = F.lit(log(known.good_share / (1 - known.good_share)))
    for rule, a, b in zip(rules, known.on_good, known.on_bad):
        odds = odds + F.when(F.col(rule.name) == 1, log(a / (1 - b))).when(
            F.col(rule.name) == 0, log((1 - a) / b)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def estimate(votes: DataFrame, scratch: Scratch, rules: tuple[Rule, ...] = RULES,
             belief: Belief = Belief(), rounds: int = 20) -> Estimate:
    """Expectation-maximisation over the counted patterns of votes."""
    names = [r.name for r in rules]
    known = Estimate(belief.good_share, (belief.right_on_good,) * len(rules),
                     (belief.right_on_bad,) * len(rules))
    # At most 3 ** rules rows; in one file and one order, so that the sums repeat.
    patterns = scratch.keep(
        votes.groupBy(*names).agg(F.count(F.lit(1)).alias("texts"))
        .coalesce(1).sortWithinPartitions(*names), "patterns")
    for _ in range(rounds):
        good, bad = F.col("texts") * F.col("good"), F.col("texts") * (1 - F.col("good"))
        sums = [F.sum("texts").alias("texts"), F.sum(good).alias("good")]
        for n in names:
            sums += [
                F.sum(F.when(F.col(n) == 1, good).otherwise(0.0)).alias(f"{n}_right_good"),
                F.sum(F.when(F.col(n).isNotNull(), good).otherwise(0.0)).alias(f"{n}_all_good"),
                F.sum(F.when(F.col(n) == 0, bad).otherwise(0.0)).alias(f"{n}_right_bad"),
                F.sum(F.when(F.col(n).isNotNull(), bad).otherwise(0.0)).alias(f"{n}_all_bad"),
            ]
        found = patterns.withColumn("good", posterior(rules, known)).coalesce(1).agg(*sums).first()
        total = found["texts"]
        if not total:
            break
        known = Estimate(
            _share(found["good"], total, belief.good_share, belief.share_weight * total),
            tuple(_share(found[f"{n}_right_good"], found[f"{n}_all_good"], belief.right_on_good,
                         belief.good_weight * total) for n in names),
            tuple(_share(found[f"{n}_right_bad"], found[f"{n}_all_bad"], belief.right_on_bad,
                         belief.bad_weight * total) for n in names))
    return known


def _share(part: float, whole: float, before: float, weight: float) -> float:
    return (part + weight * before) / (whole + weight)


def judge(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = RULES,
          belief: Belief = Belief(), threshold: float = 0.5) -> DataFrame:
    """Measures, votes, posterior and verdict of every document."""
    scratch = Scratch(spark, "rule-votes")
    voted = scratch.keep(measures(docs).select("*", *[r.vote().alias(r.name) for r in rules]), "votes")
    known = estimate(voted, scratch, rules, belief)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        voted.withColumn("posterior", posterior(rules, known))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )


def _vote_sql(rule: Rule) -> str:
    return f"CASE WHEN {rule.bad} THEN 0 WHEN {rule.good} THEN 1 END AS {rule.name}"


def _posterior_sql(rules: tuple[Rule, ...]) -> str:
    terms = [f"CASE {r.name} WHEN 1 THEN ln(a_{r.name} / (1 - b_{r.name})) "
             f"WHEN 0 THEN ln((1 - a_{r.name}) / b_{r.name}) ELSE 0 END" for r in rules]
    return "1 / (1 + exp(-(ln(share / (1 - share)) + " + " + ".join(terms) + ")))"


def oracle(rules: tuple[Rule, ...] = RULES, belief: Belief = Belief(), rounds: int = 20,
           threshold: float = 0.5) -> str:
    """The whole operator in SQL, each round of the estimate a step of its own."""
    names = [r.name for r in rules]
    before = [f"{belief.good_share}::DOUBLE AS share"]
    for n in names:
        before += [f"{belief.right_on_good}::DOUBLE AS a_{n}", f"{belief.right_on_bad}::DOUBLE AS b_{n}"]

    def share(part: str, whole: str, mean: float, weight: float) -> str:
        return f"({part} + {weight * mean!r} * sum(texts)) / ({whole} + {weight!r} * sum(texts))"

    after = [share("sum(good * texts)", "sum(texts)", belief.good_share, belief.share_weight) + " AS share"]
    for n in names:
        after += [
            share(f"coalesce(sum(good * texts) FILTER ({n} = 1), 0)",
                  f"coalesce(sum(good * texts) FILTER ({n} IS NOT NULL), 0)",
                  belief.right_on_good, belief.good_weight) + f" AS a_{n}",
            share(f"coalesce(sum((1 - good) * texts) FILTER ({n} = 0), 0)",
                  f"coalesce(sum((1 - good) * texts) FILTER ({n} IS NOT NULL), 0)",
                  belief.right_on_bad, belief.bad_weight) + f" AS b_{n}"]
    steps = [f"e0 AS MATERIALIZED (SELECT {', '.join(before)})"]
    for k in range(rounds):
        steps.append(
            f"e{k + 1} AS MATERIALIZED (SELECT {', '.join(after)} FROM "
            f"(SELECT texts, {', '.join(names)}, {_posterior_sql(rules)} AS good FROM patterns, e{k}))")
    word, kept_signs = r"[^\x20\x09-\x0D]+", r"[^\x21-\x2F\x3A-\x60\x7B-\x7E]+"
    chars = "length(signs) - length(regexp_replace(signs, '{}', '', 'g'))"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
), parts AS MATERIALIZED (
  SELECT row_no, doc_id, regexp_extract_all(text, '{word}') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         regexp_replace(text, '{kept_signs}', '', 'g') AS signs
  FROM texts
), places AS (
  SELECT row_no, words, unnest(generate_series(1, len(words) - 2)) AS i FROM parts
), windows AS (
  SELECT row_no, list(i) AS found FROM places
  GROUP BY row_no, words[i], words[i + 1], words[i + 2] HAVING count(*) > 1
), covered AS (
  SELECT row_no, count(DISTINCT i + step) AS n_repeat_words
  FROM (SELECT row_no, unnest(found) AS i FROM windows), (SELECT unnest([0, 1, 2]) AS step)
  GROUP BY row_no
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         ({chars.format('[#*$%&|<>]')})::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(words, lambda x: regexp_full_match(x, '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS n_unlettered,
         length(regexp_replace(signs, '[A-Z]', '', 'g')) AS n_signs, {chars.format('[A-Z]')} AS n_capitals,
         {chars.format('!')} AS n_shouts, {chars.format('[.!?]')} AS n_ends
  FROM parts LEFT JOIN covered USING (row_no)
), voted AS MATERIALIZED (
  SELECT *, {', '.join(map(_vote_sql, rules))} FROM measured
), patterns AS MATERIALIZED (
  SELECT {', '.join(names)}, count(*) AS texts FROM voted GROUP BY ALL
), {', '.join(steps)}, judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
         {_posterior_sql(rules)} AS good
  FROM voted, e{rounds}
)
SELECT doc_id, {', '.join(BASE)}, base_failed, NOT base_failed AND good >= {threshold} AS kept
FROM judged"""
