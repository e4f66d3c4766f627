"""Measures against a plain count, the estimate against one over all texts, and the cases."""

import random
import re
from collections import Counter
from math import exp, log

import pytest
from compare import database, spark_rows, sql_rows

from tidemark.llm import rule_votes as R
from tidemark.llm.common import Scratch
from tidemark.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    repeated = {k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated), "n_lines": len(lines),
        "n_unlettered": sum(not re.search(r"[A-Za-z\x80-\U0010ffff]", w) for w in words),
        "n_signs": len(re.findall(r"[!-/:-@\[-`{-~]", text)), "n_capitals": len(re.findall("[A-Z]", text)),
        "n_shouts": text.count("!"), "n_ends": sum(text.count(c) for c in ".!?"),
    }


def texts():
    draw = random.Random(5)
    parts = ["a", "bb", "###", "Ünï", "日本", "😀!", "X.", "12", "a\x00b", "\xa0", "\x85", "\x1c", "?", "é|", "{}"]
    gaps = [" ", "\n", "\t", "  ", "\n\n", "\r\n", "\x0b", " \n "]
    made = ["".join(draw.choice(parts) + draw.choice(gaps) for _ in range(draw.randint(0, 40))) for _ in range(300)]
    return [None, "", " \n", "a a a", "a b a b a b", "a b c", *made, "x y z " * 5000]


def test_measures(spark):
    rows = [(i, t, 7) for i, t in enumerate(texts())] + [(None, "p q r p q r", 7)]
    found = R.measures(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    assert len(found) == len(rows)
    want = {i: plain(t) for i, t, _ in rows}
    for r in found:
        assert {k: v for k, v in r.asDict().items() if k != "doc_id"} == want[r.doc_id], r.doc_id


def test_estimate_is_that_of_every_single_text(spark):
    rules = tuple(R.Rule(n, "false", "false") for n in ("a", "b", "c"))
    draw = random.Random(1)
    rows = []
    for _ in range(400):
        good = draw.random() < 0.7
        rows.append(tuple(None if draw.random() < 0.2 else int(good == (draw.random() < right))
                          for right in (0.95, 0.8, 0.7)))
    belief = R.Belief(share_weight=0.01, good_weight=0.01, bad_weight=0.01, right_on_good=0.8, right_on_bad=0.7)
    found = R.estimate(spark.createDataFrame(rows, "a int, b int, c int"), Scratch(spark, "test"), rules, belief, 12)
    n, share, a, b = len(rows), belief.good_share, [0.8] * 3, [0.7] * 3
    for _ in range(12):
        p = []
        for votes in rows:
            odds = log(share / (1 - share))
            for j, v in enumerate(votes):
                odds += 0 if v is None else log(a[j] / (1 - b[j])) if v else log((1 - a[j]) / b[j])
            p.append(1 / (1 + exp(-odds)))
        share = (sum(p) + 0.01 * n * 0.8) / (1.01 * n)
        for j in range(3):
            seen = [(q, v[j]) for q, v in zip(p, rows) if v[j] is not None]
            a[j] = (sum(q for q, v in seen if v == 1) + 0.01 * n * 0.8) / (sum(q for q, _ in seen) + 0.01 * n)
            b[j] = (sum(1 - q for q, v in seen if v == 0) + 0.01 * n * 0.7) / (
                sum(1 - q for q, _ in seen) + 0.01 * n)
    assert found.good_share == pytest.approx(share, rel=1e-9)
    assert found.on_good == pytest.approx(a, rel=1e-9) and found.on_bad == pytest.approx(b, rel=1e-9)
    assert a[0] > a[2] and b[0] > b[2]  # the better rule is trusted more


def test_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, kept string, length int")
    assert R.judge(spark, empty).count() == 0
    nulls = R.judge(spark, spark.createDataFrame(
        [(None, None, "x"), (3, None, "x"), (3, "", "x")], "doc_id long, text string, posterior string")).collect()
    assert [(r.n_words, r.base_failed, r.kept) for r in nulls] == [(0, True, False)] * 3


def test_query(spark, sf_dir):
    found = spark_rows(QUERIES["op11_rule_votes"](spark, sf_dir))
    assert found == sql_rows(database(sf_dir), ORACLES["op11_rule_votes"])


def test_junk_is_refused_and_good_texts_stay(spark):
    """Labels take no part in the estimate; they only judge it."""
    folder = "/root/testdata/sf0.01"
    judged = QUERIES["op11_rule_votes"](spark, folder).filter("NOT base_failed")
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)
