"""Alignment against both tokenizers on whole texts and a plain count of all links."""

import hashlib
import random
from collections import Counter
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import alignment as A
from tidemark.llm.queries import QUERIES, tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@cache
def made_once():
    return A.Aligner(*PATHS, cached=50)


@cache
def tokenizer():
    made = Tokenizer.from_file(PATHS[0])
    made.encode_special_tokens = True
    return made


@pytest.fixture(scope="module")
def aligner():
    return made_once()


def whole(aligner, text):
    """Tokens of the whole text at once: (n_a, n_b, n_groups, links, digest)."""
    if not text:
        return 0, 0, 0, [], ""
    a = tokenizer().encode(" " + text, add_special_tokens=False).ids
    b = aligner.pieces.encode(text)
    joined = b"".join(aligner.second_bytes[k] for k in b)
    if joined != (" " + text).encode() or b"".join(aligner.first_bytes[k] for k in a) != joined:
        return 0, 0, 0, [], ""
    ends_a = np.cumsum([len(aligner.first_bytes[k]) for k in a])
    ends_b = np.cumsum([len(aligner.second_bytes[k]) for k in b])
    cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    groups, at_a, at_b = [], 0, 0
    for cut in cuts:
        end_a, end_b = np.searchsorted(ends_a, cut) + 1, np.searchsorted(ends_b, cut) + 1
        groups.append(",".join(map(str, a[at_a:end_a])) + "|" + ",".join(map(str, b[at_b:end_b])))
        at_a, at_b = end_a, end_b
    every = sorted(set(ends_a.tolist()) | set(ends_b.tolist()))
    links = [(a[np.searchsorted(ends_a, e)], b[np.searchsorted(ends_b, e)]) for e in every]
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


BITS = ["a", "The", "ing", " ", "  ", "\n", "\n\n", "\t", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ",
        "　", "▁", "é", "é", "日本", "😀", "</s>", "<s>", "<|endoftext|>", "<0x41>", "'s", "'LL", "12345", "!?;",
        ";\r", "{\r", "\x00", "​", "﻿", "́", "word", "’s", "- "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(BITS) | st.text(max_size=3), max_size=14).map("".join))
def test_stretches_are_tokens_of_the_whole_text(text):
    text = text.encode("utf-8", "ignore").decode()
    aligner = made_once()
    n_a, n_b, n_groups, links, digest = whole(aligner, text)
    codes = np.array([A.pair_code(*x) for x in links], "<u4").tobytes()
    assert aligner.document(text) == (n_a, n_b, n_groups, codes, digest)


def plain(aligner, rows):
    """Figures of every document by one count over all links."""
    known = [(i, whole(aligner, text)) for i, text in rows]
    pairs = Counter(link for _, w in known for link in w[3])
    best = Counter()
    for (_, second), n in pairs.items():
        best[second] = max(best[second], n)
    return sorted(((i, n_a, n_b, n_groups, len(links), sum(pairs[x] == best[x[1]] for x in links),
                    sum(pairs[x] for x in links), digest)
                   for i, (n_a, n_b, n_groups, links, digest) in known), key=str)


def made():
    draw = random.Random(9)
    words = "the of and tionht eauou éèç über straße naïve 12 1,000 x.y Theand  \n \t reading\n".split(" ")
    rows = [(k, " ".join(draw.choices(words, k=draw.randint(1, 60)))) for k in range(120)]
    return rows + [(None, "the the of"), (None, None), (5, None), (6, ""), (7, "a▁b"), (8, " "), (9, "\n"),
                   (3, rows[3][1]), (10, "the " * 3000), (11, "x" * 5000)]


@pytest.mark.parametrize("links, unit", [(A.LINKS, A.UNIT_BYTES), (700, 2000)])
def test_align(spark, aligner, links, unit):
    """Also with runs of a few hundred links, which part long texts, and many units."""
    rows = made()
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                  "doc_id long, text string, row_no int, radix string, n_best int")
    got = sorted((tuple(r) for r in A.align(spark, frame, *PATHS, links=links, unit_bytes=unit).collect()), key=str)
    assert got == plain(aligner, rows)


def test_empty_tables(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert A.align(spark, frame, *PATHS).count() == 0
    frame = spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string")
    assert [tuple(r) for r in A.align(spark, frame, *PATHS).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")] * 2


def test_merge_in_small_blocks():
    draw = np.random.default_rng(2)
    runs, want = [], Counter()
    for _ in range(7):
        pairs = np.unique(draw.integers(0, 60, draw.integers(1, 50)))
        n = draw.integers(1, 9, len(pairs))
        want.update(dict(zip(pairs.tolist(), n.tolist())))
        runs.append(A.read_counted(A.counted(pairs, n), block=3))
    got = [(int(p), int(c)) for ps, ns in A.merge(runs) for p, c in zip(ps, ns)]
    assert got == sorted(want.items()) and list(A.merge([])) == []


def test_postings_round_trip():
    draw = np.random.default_rng(4)
    rows = np.unique(draw.integers(0, 400, (3000, 2)), axis=0)
    n = draw.integers(1, 70_000, len(rows))
    different, place, docs, links = A.read_postings(A.postings(rows[:, 0], rows[:, 1], n))
    assert (different[place] == rows[:, 0]).all() and (docs == rows[:, 1]).all() and (links == n).all()


def test_query(spark, sf_dir, aligner):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in QUERIES["op13_alignment"](spark, sf_dir).collect()), key=str)
    assert got == plain(aligner, [tuple(r) for r in documents])
