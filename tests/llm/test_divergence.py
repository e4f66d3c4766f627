"""The audit against a plain one over all terms, with digests that collide and without."""

import random
import re
from collections import Counter, defaultdict

import pytest
from compare import database, spark_rows, sql_rows

from tidemark.llm import divergence as D
from tidemark.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows):
    """Dense: every kept term of a language for every group."""
    found, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(UPPER))
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 10]

        def shares(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        whole = shares(sum((found[lang, s] for s in sources), Counter()))
        own = {s: shares(found[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum((own[s][t] - own[o][t]) ** 2 // (own[s][t] + own[o][t]) for t in kept))
                     for o in sources if o != s]
            telling = [(t, (own[s][t] - whole[t]) ** 2 // (own[s][t] + whole[t])) for t in kept
                       if found[lang, s][t] and own[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", telling, 10)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])}
    return out


def made():
    draw = random.Random(3)
    words = ["the", "The", "of", "Ünder", "ünder", "日本", "x1y", "a\x00b", "ÀB", "tie", "tye", "rare", "🙂"]
    rows = [(None, None, None), (None, "en", "empty"), ("", "en", None), ("12 !?", "zz", "none"), ("lone", "zz", "q")]
    for k in range(240):
        text = " ".join(draw.choices(words, k=draw.randint(1, 12))) + draw.choice([" tie tye", "", ". Of"])
        rows.append((text, draw.choice(["en", "en", "de", None]), draw.choice(["a", "b", "Ä", "hot", "hot", None])))
    return rows + rows[:7]


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                  "text string, lang string, source string, total int, digest string")
    out = D.audit(spark, frame, **options).collect()
    assert len(out) == len(set(out))
    return {tuple(r) for r in out}


@pytest.mark.parametrize("bits", [64, 2, 1])
def test_audit(spark, bits):
    """With a digest of one bit nearly all terms share theirs and are told apart by strings."""
    rows = made()
    assert run(spark, rows, bits=bits) == plain(rows)


def test_small_stretches_and_counters(spark, monkeypatch):
    text = "Aa" * 50 + " bB " * 40 + "é" * 30
    monkeypatch.setattr(D, "STRETCH", 16)
    assert [w for part in D.terms_of(text) for w in part] == [
        w.encode() for w in TERM.findall(text.translate(UPPER))]


def test_both_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(D, "PAIRS", 3)
    import pyarrow as pa

    held = [[(1, 50, 7), (2, 90, 8), (4, 30, 9)], [(2, 60, 8), (4, 61, 9)], [(1, 10, 7), (2, 11, 8), (4, 13, 9)]]
    kind = pa.list_(pa.struct([("no", pa.int64()), ("p", pa.int64()), ("p0", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([
        pa.array(["en", "en", "de"]),
        pa.array([[dict(zip(("no", "p", "p0"), h)) for h in x] for x in held], kind)], names=["lang", "held"])
    got = Counter()
    for out in D._held_by_both(iter([batch])):
        for r in out.to_pylist():
            got[r["lang"], r["a"], r["b"]] += r["value"]
    want = Counter()

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    for lang, x in zip(["en", "en", "de"], held):
        for i, (a, p, p0) in enumerate(x):
            for b, q, q0 in x[i + 1:]:
                want[lang, a, b] += f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_empty(spark):
    assert run(spark, []) == set()


def test_query(spark, sf_dir):
    found = spark_rows(QUERIES["op12_divergence"](spark, sf_dir))
    assert found == sql_rows(database(sf_dir), ORACLES["op12_divergence"])
