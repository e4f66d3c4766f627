"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import zlib

import pytest

from tidemark.llm import (
    bagminhash, decontamination, hmm, html_text, licenses, packing, quality, sharding, toxicity, vectors)
from tidemark.llm.queries import tokenizer_path

WORDS = "der hund und the cat sat on a mat while rain fell over old stone roofs near grey hills".split()
LONG = " ".join(WORDS[k * k % 17] + str(k % 97) for k in range(30_000))
CLASH = ("row_no long, node long, start long, score double, label int, band long, shard int, root long, "
         "sequence_id long, size long, key string, part int")
CLASH_VALUES = (7, 7, 7, 0.5, 1, 7, 3, 7, 7, 7, "k", 1)
ROWS = [(1, "the cat sat on a mat while rain fell"), (2, None), (3, ""), (4, " \n\t "), (5, LONG),
        (1, "the cat sat on a mat while rain fell"), (None, "the cat sat on a mat while rain fell"),
        (None, None), (8, "Ünïcode “quotes” 日本   x"), (9, "a" * 500)]


def made(spark, rows, extra=True):
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(i, t, *CLASH_VALUES) for i, t in rows],
                                 f"doc_id long, text string, {CLASH}")


@pytest.fixture(scope="module")
def odd(spark):
    return made(spark, ROWS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 0), (8, 0, 1), (99, 1, 1), (4, 0, 0)],
        "doc_id long, quality int, toxic int")


def test_packing(spark, odd):
    path = tokenizer_path("word_bpe_49k.json")
    out = packing.pack(spark, odd, path).collect()
    assert sum(r.length for r in out if r.doc_id == 2) == 1  # the end alone
    assert sum(r.length for r in out if r.doc_id == 1) == 2 * next(r for r in out if r.doc_id == 1).doc_tokens
    assert sum(r.length for r in out if r.doc_id is None) == 1 + next(
        r for r in out if r.doc_id == 1).doc_tokens
    assert max(r.length for r in out) == 2048
    assert packing.pack(spark, made(spark, []), path).count() == 0


def test_hidden_markov(spark, odd):
    out = hmm.score(spark, odd, states=2).collect()
    assert len(out) == len(ROWS)
    alone = [r for r in out if r.doc_id in (2, 3, 4)]
    assert {(r.n_tokens, round(r.base_score, 9), r.n_known) for r in alone} == {
        (1, round(alone[0].base_score, 9), 1)}
    same = {round(r.score, 9) for r in out if r.doc_id == 1}
    assert len(same) == 1
    assert hmm.score(spark, made(spark, []), states=2).count() == 0
    lone = hmm.score(spark, made(spark, [(i, "x y") for i in range(60)
                                        if zlib.crc32(str(i).encode()) % 7 == 2]), states=2).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in lone} == {(0, 0, 0.0)}


def test_embeddings(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (8, [2.0, 0.1]), (8, [2.0, 0.1]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]),
            (10, [-1.0, 0.0]), (11, [1e30, 1e28])]
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                                  "vec_id long, embedding array<float>, root long, links long, copies int")
    out = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(spark, table).collect()}
    assert out == {(1, 3, 1, True), (8, 3, 1, False), (11, 3, 1, False), (10, 0, 10, True), (9, 0, 9, True),
                   (None, 0, None, True)} | {(k, 0, k, True) for k in range(2, 8)}
    assert vectors.near_duplicates(spark, table.limit(0)).count() == 0


def test_minhash(spark, odd):
    out = bagminhash.near_duplicates(spark, odd).collect()
    assert len(out) == len(ROWS)
    copies = [r for r in out if r.doc_id == 1] + [r for r in out if r.doc_id is None and r.group_id == 1]
    assert len(copies) == 3 and {r.group_id for r in copies} == {1} and sum(r.kept for r in copies) == 1
    assert all(r.kept and r.group_id == r.doc_id for r in out if r.doc_id in (2, 3, 4, 5, 8, 9))
    kept = bagminhash.deduplicate(spark, odd)
    assert kept.columns == odd.columns and kept.count() == len(ROWS) - 2
    assert bagminhash.near_duplicates(spark, made(spark, [])).count() == 0


def test_toxicity(spark, odd, labels):
    out = toxicity.classify(spark, odd, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (2, 3, 4)}) == 1
    assert toxicity.classify(spark, made(spark, []), labels).count() == 0
    none = toxicity.classify(spark, odd, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.keep_civil(spark, odd, labels.limit(0)).columns == odd.columns


def test_quality(spark, odd, labels):
    out = quality.classify(spark, odd, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (2, 3)}) == 1
    assert quality.classify(spark, made(spark, []), labels).count() == 0
    assert {r.score for r in quality.classify(spark, odd, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(spark, odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == len(ROWS)


def test_html(spark):
    pages = spark.createDataFrame(
        [(1, None, None, "t"), (2, "u", "", "t"), (None, None, "<p>one</p>", "t"), (4, "u", "a &lt; b", "t"),
         (5, "u", "<b>" * 5000 + "deep" + "<div>" * 5000, "t"), (6, "u", "<" * 1000 + '<p a="' * 500, "t"),
         (4, "u", "a &lt; b", "t")], "page_id long, url string, html string, text string")
    out = [tuple(r) for r in html_text.extract(spark, pages).collect()]
    assert out[:5] == [(1, None, "", 0), (2, "u", "", 0), (None, None, "one", 3), (4, "u", "a < b", 5),
                       (5, "u", "deep", 4)]
    assert out[6] == out[3] and len(out) == 7
    assert html_text.extract(spark, pages.limit(0)).count() == 0


def test_licenses(spark, odd):
    rows = made(spark, [*ROWS, (20, f"{LONG} Released under the MIT License. {LONG}"), (None, "Released under the MIT License.")])
    out = licenses.find(spark, rows).collect()
    assert sorted((r.doc_id or -1, r.license, r.coverage) for r in out) == [(-1, "MIT", 1.0), (20, "MIT", 1.0)]
    assert licenses.find(spark, made(spark, [])).count() == 0


def test_sharding(spark, odd):
    out = sharding.shard(spark, odd).collect()
    assert len(out) == len(ROWS)
    assert {(r.size, r.text_crc32) for r in out if r.doc_id in (2, 3)} == {(1, 0)}
    assert len({r.shard for r in out if r.doc_id == 1}) == 1
    assert len({r.shard for r in out if r.doc_id is None}) == 1
    assert sharding.shard(spark, made(spark, [])).count() == 0


def test_decontamination(spark, odd):
    item = "old stone roofs near grey hills shine after rain in late autumn light"
    items = spark.createDataFrame(
        [(1, item, 0), (2, None, 0), (3, "", 0), (None, item, 0), (5, "日本", 0), (5, "two words", 0)],
        "item_id long, text string, words int")
    docs = made(spark, [*ROWS, (30, f"{LONG} {item} {LONG}"), (None, f"x {item}"), (32, "here two words stand")])
    out = decontamination.overlaps(spark, docs, items).collect()
    assert sorted((r.doc_id or -1, r.item_id or -1) for r in out) == [
        (-1, -1), (-1, 1), (8, 5), (30, -1), (30, 1), (32, 5)]
    kept = decontamination.clean(spark, docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) + 3 - 4
    assert decontamination.overlaps(spark, made(spark, []), items).count() == 0
    assert decontamination.overlaps(spark, docs, items.limit(0)).count() == 0
    assert decontamination.clean(spark, docs, items.limit(0)).count() == len(ROWS) + 3


@pytest.mark.parametrize("rows", [0, len(ROWS)])
def test_pipeline_stages_keep_columns_and_survive_odd_rows(spark, sf_dir, rows):
    """Nulls, empty and long texts, repeated rows and clashing columns, and no rows at all."""
    import corpus_pipeline

    docs = spark.createDataFrame(
        [(i, t, "en", None, None if t is None else len(t), *CLASH_VALUES) for i, t in ROWS[:rows]],
        f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")
    before = [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        kept = [tuple(r) for r in out.collect()]
        assert all(r in before for r in kept) and (rows == 0 or name != "decontamination" or kept == before), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert (packed.count() > 0) == (rows > 0)
