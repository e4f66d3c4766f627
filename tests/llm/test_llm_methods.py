"""The operators against brute force, round trips and held-out rows."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import (
    bagminhash, decontamination, hmm, html_text, licenses, packing, quality, queries, sharding, toxicity)
from tidemark.llm.common import Scratch, WordCache
from tidemark.llm.components import components

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abX .,'\n\té߀İıςσ́ １日<|endoftext|>ÅÅ", max_size=30))
def test_ids_are_the_tokenizers(text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.word_ids(path).ids(text), "<u4").tolist() == expected


def test_packing_round_trip(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    out = queries.op1_packing(spark, sf_dir).collect()
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts.items()}
    pieces, sequences = {}, {}
    for r in out:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k, found in pieces.items():
        assert [s for s, _ in sorted(found)] == [0, *np.cumsum([n for _, n in sorted(found)])[:-1]]
        assert sum(n for _, n in found) == len(ids[k])
    assert pieces.keys() == ids.keys()
    padding = 0
    for found in sequences.values():
        assert [o for o, _ in sorted(found)] == [0, *np.cumsum([n for _, n in sorted(found)])[:-1]]
        size = sum(n for _, n in found)
        assert size <= 2048
        padding += 0 if size & (size - 1) == 0 else 2048 - size
    assert padding < 0.01 * sum(map(len, ids.values()))


def test_leftovers_are_merged_without_padding():
    pieces = [packing.Piece((k, 0, n, bytes(4 * n))) for k, n in enumerate([700, 900, 1500, 3, 64, 2000])]
    done = packing.merged(pieces, 2048, 16)
    sizes = [sum(p.size for p in w) for w in done]
    assert sum(sizes) == 5167 and all(2048 - s < 16 or s & (s - 1) == 0 for s in sizes)


@pytest.mark.parametrize("block", [1, 2, 3, 1024])
def test_hidden_markov_sums_over_all_paths(monkeypatch, block):
    """Whole or in blocks of a few tokens."""
    monkeypatch.setattr(hmm, "BLOCK", block)
    monkeypatch.setattr(hmm, "CHUNK", 4)
    draw = np.random.default_rng(0)
    model = hmm.Model(draw.dirichlet(np.ones(3)), draw.dirichlet(np.ones(3), 3), draw.dirichlet(np.ones(5), 3).T)
    sequences = [draw.integers(0, 5, n) for n in (1, 4, 7, 2, 4, 7)]
    starts, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for sequence, found in zip(sequences, hmm.log_likelihoods(model, sequences)):
        paths = {}
        for path in itertools.product(range(3), repeat=len(sequence)):
            p = model.start[path[0]] * model.emits[sequence[0], path[0]]
            for a, b, seen in zip(path, path[1:], sequence[1:]):
                p *= model.moves[a, b] * model.emits[seen, b]
            paths[path] = p
        total = sum(paths.values())
        assert math.isclose(math.log(total), found, rel_tol=1e-9)
        for path, p in paths.items():
            starts[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
            for z, seen in zip(path, sequence):
                emits[seen, z] += p / total
    for one, two in zip(hmm.expected_uses(model, sequences), (starts, moves, emits)):
        assert np.allclose(one, two)


def test_hidden_markov_learns_from_all_texts_in_every_round(spark):
    """The numbers of the rows, which follow the partitions, make no difference; starts are those of texts."""
    draw = np.random.default_rng(3)
    overall = np.full(hmm.CLASSES, 1 / hmm.CLASSES)
    texts = [draw.integers(0, 5, 40).astype("<u2").tobytes() for _ in range(30)]
    models = [hmm.train(spark, spark.createDataFrame(
        [(k, k * step, False, t) for k, t in enumerate(texts)],
        "doc_id long, row_no long, held_out boolean, codes binary"), overall, states=2) for step in (1, 977)]
    assert np.allclose(models[0].emits, models[1].emits) and np.allclose(models[0].moves, models[1].moves)
    run, _ = hmm._uses(type("Shared", (), {"value": models[0]}), 2)
    import pyarrow as pa

    long = draw.integers(0, 5, 6 * hmm.BLOCK).astype("<u2").tobytes()
    found = next(run([pa.RecordBatch.from_arrays([pa.array([long, texts[0]])], ["codes"])])).to_pylist()
    assert math.isclose(sum(v for k, v in found[0].items() if k != "place"), 2)


def test_hidden_markov_works_texts_of_like_length_together(monkeypatch):
    """Every text is in one group; no group but that of one text is beyond its limit."""
    monkeypatch.setattr(hmm, "CACHED", 50)
    monkeypatch.setattr(hmm, "SIDE_BY_SIDE", 3)
    draw = np.random.default_rng(8)
    texts = [np.full(n, k) for k, n in enumerate([*draw.integers(1, 60, 80), 9000])]
    groups = list(hmm._alike(texts))
    assert sorted(t[0] for g in groups for t in g) == list(range(81))
    assert all(len(g) == 1 or sum(map(len, g)) <= max(50, 3 * len(g[-1])) for g in groups)
    model = hmm.Model(draw.dirichlet(np.ones(3)), draw.dirichlet(np.ones(3), 3), draw.dirichlet(np.ones(81), 3).T)
    apart = [hmm.expected_uses(model, g) for g in groups]
    for one, *parts in zip(hmm.expected_uses(model, texts), *apart):
        assert np.allclose(one, sum(parts))


def test_hidden_markov_leaves_long_texts_uncut_beside_others_as_long(monkeypatch):
    """No matrices are made of texts with enough others as long beside them; the sums stay."""
    draw = np.random.default_rng(9)
    model = hmm.Model(draw.dirichlet(np.ones(3)), draw.dirichlet(np.ones(3), 3), draw.dirichlet(np.ones(40), 3).T)
    texts = [draw.integers(0, 40, hmm.BLOCK + 9 * k) for k in range(1, 21)]
    made, maps = [], hmm._maps
    monkeypatch.setattr(hmm, "_maps", lambda m, blocks: made.extend(blocks) or maps(m, blocks))
    few = texts[:hmm.UNCUT]
    alike = [few[0]] * hmm.UNCUT
    uncut = hmm.expected_uses(model, alike), hmm.log_likelihoods(model, alike)
    assert not made
    apart = [(hmm.expected_uses(model, [t]), hmm.log_likelihoods(model, [t])) for t in texts]
    assert len(made) == 2 * 2 * len(texts)
    for one, part in zip(uncut[0], apart[0][0]):
        assert np.allclose(one, hmm.UNCUT * part)
    assert np.allclose(uncut[1], apart[0][1], rtol=1e-12)
    for one, *parts in zip(hmm.expected_uses(model, texts), *(a for a, _ in apart)):
        assert np.allclose(one, sum(parts))
    assert np.allclose(hmm.log_likelihoods(model, texts), np.concatenate([s for _, s in apart]), rtol=1e-12)


def test_hidden_markov_counts_and_codes_each_word_once():
    """Words as the pattern finds them, in texts with odd white space; looked up once a batch."""
    import pyarrow as pa

    long = "L" * 70
    texts = [" A b\x0ba \t", None, "", "\u00c9 x\u00a0y\x1cz\x85 b\n", "  ", f"{long} {long.lower()} q q", "b\x0c" * 9]
    want = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), ""] for t in texts]
    want = [[w.encode() for w in ws] for ws in want]
    column = pa.array(texts)
    counted = Counter()
    for batch in hmm._count(pa.RecordBatch.from_arrays([column.slice(k, 3)], ["text"]) for k in (0, 3, 6)):
        assert len(set(batch.column(0).to_pylist())) == len(batch)
        counted.update(dict(zip(*(c.to_pylist() for c in batch.columns))))
    assert counted == Counter(hmm.key_of(w) for ws in want for w in ws)

    class Seen(hmm.Vocabulary):
        asked: list = []

        def numbers(self, keys):
            self.asked.append(keys.to_pylist())
            return super().numbers(keys)

    vocabulary = Seen([(b"", 7), (b"a", 2), (b"b", 11)], own_from=3)
    assert vocabulary.numbers(hmm._keys(pa.array([b"b", b"zz", b"#" * 65]))).tolist() == list(
        map(vocabulary.number, (b"b", b"zz", b"#" * 65)))
    vocabulary.asked.clear()
    n = len(texts)
    given = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array([False] * n), column], ["r", "d", "h", "t"])
    [coded] = hmm._encode(type("Shared", (), {"value": vocabulary}))([given])
    assert [sorted(set(a)) for a in vocabulary.asked] == [sorted(a) for a in vocabulary.asked] and len(vocabulary.asked) == 1
    for row, words in zip(coded.to_pylist(), want):
        numbers = [vocabulary.number(w) for w in words]
        assert row["n_tokens"] == len(words) and row["known_here"] == sum(k < 3 for k in numbers)
        assert np.frombuffer(row["codes"], "<u2").tolist() == vocabulary.classes[numbers].tolist()
        assert math.isclose(row["logs_here"], vocabulary.logs[numbers].sum())
        assert {r["word"]: r["n"] for r in row["rare"]} == Counter(
            hmm.key_of(w) for w, k in zip(words, numbers) if k >= 3)


def test_hidden_markov_scores_a_text_of_a_million_words():
    draw = np.random.default_rng(5)
    model = hmm.Model(draw.dirichlet(np.ones(8)), draw.dirichlet(np.ones(8), 8), draw.dirichlet(np.ones(50), 8).T)
    parts = [draw.integers(0, 50, n) for n in (1_000_000, 1500)]
    (long, found), state, want = hmm.log_likelihoods(model, parts), model.start, 0.0
    for code in parts[1]:
        state = state * model.emits[code]
        want += math.log(state.sum())
        state = state / state.sum() @ model.moves
    assert math.isclose(found, want, rel_tol=1e-9) and -4.2e6 < long < -3e6


def test_hidden_markov_numbers_the_end_however_rare(spark, monkeypatch):
    """With few words known to the tasks the end is one of many that are not."""
    monkeypatch.setattr(hmm, "KNOWN", 4)
    texts = {k: " ".join(f"w{(k * 7 + j) % 11}" for j in range(60)) for k in range(12)}
    rows = hmm.score(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 2).collect()
    trained = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    counts = Counter(w for k in trained for w in [*texts[k].split(), ""])
    total = counts.total()
    for r in rows:
        words = [*texts[r.doc_id].split(), ""]
        assert r.n_known == sum(w in counts for w in words)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words))


def test_hidden_markov_beats_its_base(spark, sf_dir, texts):
    out = queries.op2_hidden_markov(spark, sf_dir).collect()
    tokens = {k: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]
              for k, t in texts.items()}
    counts = Counter(w for k, ws in tokens.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in ws)
    total, distinct = counts.total(), len(counts)
    for r in out:
        words = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        assert math.isclose(base, r.base_score, rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (
            len(words), sum(w in counts for w in words), total, zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    away = [r for r in out if r.held_out]
    assert sum(r.score for r in away) > 0.97 * sum(r.base_score for r in away)


def test_word_probabilities_sum_to_one():
    """Over all known words and one share for each class of words never met."""
    words = [(b"", 5), (b"a", 4), (b"bb", 3), (b"longer", 1), (b"linger", 2), (b"x" * 70, 1)]
    vocabulary = hmm.Vocabulary([(hmm.key_of(w), c) for w, c in words[:3]], own_from=4)
    mass = np.zeros(hmm.CLASSES)
    mass[hmm.OWN:] = 1
    for w, c in words:
        mass[vocabulary.classes[vocabulary.number(w)]] += c + 1
    emits = mass / mass.sum()
    share = sum(emits[vocabulary.classes[vocabulary.number(w)]] * (c + 1) / mass[vocabulary.classes[vocabulary.number(w)]]
                for w, c in words) + (emits[hmm.OWN:] / mass[hmm.OWN:]).sum()
    assert math.isclose(share, 1)


def test_embeddings_match_all_pairs(spark):
    out = {r.vec_id: r for r in queries.op3_embeddings(spark, MIDDLE).collect()}
    rows = spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()
    draw = np.random.default_rng(3)
    _check_vectors(out, [(r.vec_id, r.embedding) for r in rows])
    from tidemark.llm import vectors

    rows = [(k, [float(x) for x in draw.normal(size=16)]) for k in range(40)]
    for k in range(400):  # one large group, several small ones and copies
        like = rows[0 if k < 250 else k % 40][1]
        rows.append((100 + k, [float(np.float32(x + draw.normal() * 0.08 * (k % 5 > 0))) for x in like]))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in vectors.near_duplicates(spark, table, window=16).collect()}
    _check_vectors(found, [(r.vec_id, r.embedding) for r in table.collect()])


def test_embeddings_in_one_dense_cluster(spark):
    """Planes hardly divide vectors at a mutual cosine of 0.9; links among them are still found."""
    from tidemark.llm import vectors

    draw = np.random.default_rng(6)
    centre, noise = draw.normal(size=64), draw.normal(size=(2500, 64))
    centre /= np.linalg.norm(centre)
    base = 0.9**0.5 * centre + 0.1**0.5 * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    away = draw.normal(size=(150, 64))
    near = 0.956 * base[:150] + (1 - 0.956**2) ** 0.5 * away / np.linalg.norm(away, axis=1, keepdims=True)
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(np.concatenate([base, near]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    _check_vectors({r.vec_id: r for r in vectors.near_duplicates(spark, table).collect()}, rows)


def _check_vectors(out, rows):
    units = np.array([r[1] for r in rows], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= 0.95
    label = np.array([r[0] for r in rows])
    while True:
        new = np.where(near, label[None, :], label.max()).min(axis=1)
        if (new == label).all():
            break
        label = new
    for (k, _), links, root in zip(rows, near.sum(axis=1) - 1, label):
        assert (out[k].n_links, out[k].component_id, out[k].kept) == (links, root, k == root)


def test_components(spark):
    draw = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 400, (260, 2))] + [(k, k + 1) for k in range(1000, 1300)]
    found = {r.node: r.root for r in components(
        Scratch(spark, "test"), spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for pair in links for n in pair}
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {n: r for n, r in root.items() if any(a != b and n in (a, b) for a, b in links)}


def test_signatures_estimate_weighted_similarity():
    draw, hashes = np.random.default_rng(5), WordCache(xxhash.xxh3_64_intdigest)
    errors = []
    for _ in range(30):
        one = [f"w{k}" for k in draw.integers(0, 3, 200)]
        two = one[:]
        for k in draw.integers(0, 200, draw.integers(1, 12)):
            two[k] = "other"
        found = bagminhash.signatures([bagminhash.shingles(w, hashes) for w in (one, two)], 800)
        errors.append((found[0] == found[1]).mean() - bagminhash.similarity(one, two))
    assert abs(np.mean(errors)) < 0.015 and max(map(abs, errors)) < 0.09


def test_minhash_matches_all_pairs(spark, sf_dir, texts):
    out = {r.doc_id: r for r in queries.op4_minhash(spark, sf_dir).collect()}
    _check_groups(out, texts)


def test_minhash_in_large_groups(spark):
    """Chains of small edits, copies, and a passage that many otherwise different texts share."""
    draw = np.random.default_rng(8)
    passage = [f"p{k}" for k in range(60)]
    rows, chain = {}, [f"c{k}" for k in range(120)]
    for k in range(150):
        chain = chain[:]
        chain[draw.integers(0, 120)] = f"e{k}"
        rows[k] = " ".join(chain)
        rows[1000 + k] = " ".join(passage + [f"u{k}_{j}" for j in range(k % 30)])
        rows[2000 + k] = rows[k % 7]
    out = {r.doc_id: r for r in bagminhash.near_duplicates(
        spark, spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    _check_groups(out, rows)


def test_the_size_of_a_group_hardly_loses_a_pair():
    places = bagminhash.BANDS * bagminhash.ROWS
    fewest = math.ceil(bagminhash.fewest_places(0.8, places))
    assert sum(math.comb(places, k) * 0.8**k * 0.2 ** (places - k) for k in range(fewest)) < 2e-6


def test_groups_cut_by_the_edge_of_a_partition():
    """Bands 7 and 9 are cut; of the others only whole groups are given, each row once."""
    import pyarrow as pa

    def chained(*parts):
        made = (pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in p], pa.int64()) for k in (0, 1)], ["band", "node"]) for p in parts)
        return [tuple(r.values()) for b in bagminhash._chain(made) for r in b.to_pylist()]

    assert chained([(5, 1), (6, 1), (6, 2)], [(7, 1)]) == [(5, 1, None), (6, 1, None), (6, 2, 1), (7, 1, None)]
    assert chained([(7, 2)], [(8, 1)], [(9, 1)]) == [(7, 2, None), (9, 1, None)]
    assert chained([(9, 2)], [(9, 3)]) == [(9, 2, None), (9, 3, 2)]
    assert chained([(9, 4)]) == [(9, 4, None)]


def _check_groups(out, texts):
    words = {k: bagminhash.words_of(t) for k, t in texts.items()}
    bags = {k: Counter(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) for k, w in words.items() if w}
    root = {k: k for k in texts}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(bags), 2):
        one, two = bags[a].total(), bags[b].total()
        if min(one, two) >= 0.8 * max(one, two) and top(a) != top(b) and (
                next(iter(bags[a])) in bags[b] or not bags[a].keys().isdisjoint(bags[b])):
            if bagminhash.similarity(words[a], words[b]) >= 0.8:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert {k: r.group_id for k, r in out.items()} == {k: top(k) for k in texts}
    assert all(r.kept == (k == top(k)) for k, r in out.items())


def test_toxicity_on_held_out_rows(spark):
    out = {r.doc_id: r for r in queries.op5_toxicity(spark, MIDDLE).collect()}
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
    held = [(out[r.doc_id].predicted, r.toxic) for r in labels if out[r.doc_id].held_out]
    assert held and sum(p == t for p, t in held) / len(held) > 0.85


def test_swapped_groups_score_alike(spark):
    """Where insults come with one group's name, only the penalty keeps neutral mentions clean."""
    draw = np.random.default_rng(2)
    filler = [f"word{chr(97 + k)}" for k in range(26)]
    rows = []
    for k in range(1200):
        words = list(draw.choice(filler, 8))
        toxic = k % 3 == 0
        if toxic:
            words += ["idiot"] * (k % 2) + ["gay"]
        elif k % 10 == 1:
            words += ["straight"]
        rows.append((int(toxic), " ".join(words)))
    table = spark.createDataFrame(rows, "label int, text string")
    gaps = {}
    for penalty in (0.0, 20.0):
        score = toxicity.Scorer(toxicity.fit(spark, table, penalty=penalty))
        gaps[penalty] = abs(score("the gay teacher reads") - score("the straight teacher reads"))
        assert score("you idiot") > 0.5
    assert gaps[20.0] < 0.25 * gaps[0.0]


def test_quality_on_held_out_rows(spark):
    out = {r.doc_id: r for r in queries.op8_quality(spark, MIDDLE).collect()}
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
    held = [(out[r.doc_id].predicted, r.quality) for r in labels if out[r.doc_id].held_out]
    assert held and sum(p == t for p, t in held) / len(held) > 0.9


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), min_size=1, unique_by=lambda x: x[0]),
       st.randoms())
def test_isotonic_rises_and_keeps_the_sum(bins, chance):
    counts = [(at, n, chance.randint(0, n)) for at, n in bins]
    steps, values = quality.isotonic(counts)
    assert (np.diff(values) >= 0).all() and (np.diff(steps) > 0).all()


PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><a href=/>Site</a></header><nav><ul><li><a href=/a>Menu</a></ul></nav>
<div class="cookie-notice">We use cookies, as you know, on this site.</div>
<div id="wrap"><article><h1>Head&eacute;</h1><p>First, <b>bold</b> text,
 goes on&nbsp;here.<p>Second&lt;p&gt;, one more line<br>broken.<div class="ad-box"><p>Buy, now, at once, this.</p></div>
<ul><li>One item, with words<li>Two items, with words</ul><form><p>Name, please, and more</p></form></article>
<aside><p>Side, note, with many, commas.</p></aside>
<section id="comments"><p>Great, post, really, nice, one.</p></section></div>
<footer><p>Copyright, all rights, reserved.</p></footer></body>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == (
        "Headé\n\nFirst, bold text, goes on here.\n\nSecond<p>, one more line broken.\n\n"
        "One item, with words\n\nTwo items, with words")
    plain = PAGE.replace("<article>", '<div class="c">').replace("</article>", "</div>")
    assert html_text.main_text(plain) == html_text.main_text(PAGE)


LONG_TEXT = "<p>" + "A long text, with commas, and more words, goes on. " * 6 + "</p>"


@pytest.mark.parametrize("page, kept", [
    (f"<article><div><h1><a href=/>Headline</a></h1></div>{LONG_TEXT}"
     "<ul><li><a href=/s>Source one</a><li><a href=/t>Source two</a></ul>"
     "<table><tr><td><a href=/n>Name</a></td></tr></table></article>", ["Headline", "Source two", "Name"]),
    (f"<body><div>{LONG_TEXT}</div><p>The end.</p>Loose text<div><p>Short.</p></div></body>",
     ["The end.", "Loose text", "Short."]),
    (f'<article class="post category-social">{LONG_TEXT}</article>', ["A long text"]),
    (f'<div class="content with-sidebar">{LONG_TEXT}</div><p>After</p>', ["A long text", "After"]),
    (f'<div class="social">{LONG_TEXT}</div><p>After</p>', ["A long text"]),
    (f"<article>{LONG_TEXT}<p>So <math><mi>x</mi></math> holds</p></article>", ["So x holds"])])
def test_article_text_is_kept(page, kept):
    text = html_text.main_text(page)
    assert all(k in text for k in kept)


def test_pages_of_the_table(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    import html

    out = queries.op6_html_extraction(spark, sf_dir).collect()
    assert len(out) == len(pages)
    for r in out:
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=25), st.lists(st.sampled_from("abcdefgh"), max_size=15))
def test_patience_pairs_rise(a, b):
    pairs = licenses.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if len(set(a)) == len(a) and a == b:
        assert len(pairs) == len(a)


def test_notices_are_found_each_time(spark, sf_dir, texts):
    templates = [licenses.Template(n, t, 0.8) for n, t in sorted(licenses.TEMPLATES.items())]
    text = ("x under the Released under the MIT License. so Released under the MIT License. "
            "Licensed under CC BY-NC 4.0. " + licenses.TEMPLATES["MIT-text"].replace("copy,", "clone,"))
    found = licenses.scan(text, templates)
    assert [f[0] for f in found] == ["MIT", "MIT", "CC-BY-NC-4.0", "MIT-text"]
    assert [f[1] == 1 for f in found] == [True, True, True, False]
    out = {(r.doc_id, r.license) for r in queries.op7_licenses(spark, sf_dir).collect()}
    lines = {n: t for n, t in licenses.TEMPLATES.items() if n in ("MIT", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0")}
    assert out >= {(k, n) for k, t in texts.items() for n, line in lines.items() if line in t}


def test_sharding_law(spark):
    rows = queries.op9_sharding(spark, MIDDLE).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    by_shard = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 16)
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert sorted(by_shard) == list(range(16))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert all(25 < len(slots) < 110 for slots in by_shard.values())


def test_changed_weights_move_rows_below_them_only(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    tree = sharding.tree_of()
    heavier = {**tree, "region1": {**tree["region1"], "rack0": {**tree["region1"]["rack0"], 9: 3.0}}}
    both = sharding.with_shard(sharding.with_shard(keys, "doc_id", tree, "a"), "doc_id", heavier, "b").collect()
    counts = Counter(r.b for r in both)
    for r in both:
        if r.a != r.b:  # into the heavier region, or within it into the heavier rack, or its shard
            assert r.b >= 8 and (r.a < 8 or r.b in range(8, 12))
    assert counts[9] > 2 * counts[8] and sum(r.a == r.b for r in both) > 3000
    gone = {**tree, "region0": {**tree["region0"], "rack1": {**tree["region0"]["rack1"], 5: 0.0}}}
    assert 5 not in {r.shard for r in sharding.with_shard(keys, "doc_id", gone, "shard").collect()}


def test_alignment_is_smith_waterman():
    draw = np.random.default_rng(4)
    pairs = [(draw.integers(1, 6, draw.integers(1, 12)), draw.integers(1, 6, draw.integers(1, 30))) for _ in range(150)]
    left, right = np.zeros((150, 12), int), np.full((150, 30), -1)
    for k, (a, b) in enumerate(pairs):
        left[k, :len(a)], right[k, :len(b)] = a, b
    for (a, b), found in zip(pairs, decontamination.align(left, right)[0]):
        table = np.zeros((len(a) + 1, len(b) + 1))
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            step = decontamination.MATCH if a[i - 1] == b[j - 1] else decontamination.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] + decontamination.GAP,
                              table[i, j - 1] + decontamination.GAP)
        assert math.isclose(table.max(), found, abs_tol=1e-9)


def test_edited_items_are_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    words = {r.item_id: r.text.split() for r in items.collect()}
    edited = []
    for k, item in words.items():
        changed = [w if n % 8 != 4 else "changed" for n, w in enumerate(item) if n % 11 != 7]
        edited.append((10**6 + k, "before it all " + " ".join(changed) + " and after"))
    more = docs.select("doc_id", "text").union(spark.createDataFrame(edited, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in decontamination.overlaps(spark, more, items).collect()}
    assert sum((10**6 + k, k) in found for k in words) >= 0.95 * len(words)
    whole = {(r.doc_id, k) for r in docs.collect() for k, item in words.items()
             if " ".join(item).lower() in " ".join((r.text or "").split()).lower()}
    assert found >= whole and len([f for f in found if f[0] < 10**6]) <= len(whole) + 2


def test_every_alignment_is_found(spark):
    """However the edits lie, and although exact copies make other sequences rarer."""
    item = [f"w{k}" for k in range(20)]
    third = [w for k, x in enumerate(item) for w in ([x, f"n{k}"] if k % 3 == 2 else [x])]
    second = [w for k, x in enumerate(item) for w in ([x, f"n{k}"] if k % 2 else [x])]
    fourth = [x if k % 4 != 3 else f"n{k}" for k, x in enumerate(item)]
    seven = "one two three four five six seven".split()
    rows = [(1, third), (2, fourth), (3, second), (4, item), (5, item), (6, seven[:3] + ["other"] + seven[4:])]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(seven))], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.overlaps(spark, docs, items).collect()}
    assert found == {(1, 7), (2, 7), (3, 7), (4, 7), (5, 7), (6, 8)}


def test_matches_are_all_alignments():
    draw = np.random.default_rng(9)
    words = [f"w{k}".encode() for k in range(9)]
    items = [[words[k] for k in draw.integers(0, 9, draw.integers(1, 22))] for _ in range(40)]
    texts = []
    for k in range(200):
        text = []
        for w in items[k % 40]:
            text += [w] if (x := draw.random()) > 0.45 else [words[draw.integers(0, 9)]] if x > 0.3 else (
                [w, b"other"] if x > 0.1 else [])
        texts.append([words[j] for j in draw.integers(0, 9, 5)] + text + [b"x"] * draw.integers(0, 60) + text[:9])
    block = decontamination.Block(list(range(40)), items, 0.5)
    found = {(n, k): score for n, k, _, score, *_ in block.matches([b" ".join(t).decode() for t in texts])}
    for n, text in enumerate(texts):
        codes = block.coded.words(text)
        left = np.zeros((40, 22), int)
        for k, item in enumerate(block.items):
            left[k, :len(item)] = item
        scores = decontamination.align(left, np.tile(codes, (40, 1)))[0] / [len(i) for i in items]
        assert {k for k in range(40) if scores[k] >= 0.5 - 1e-9} == {k for m, k in found if m == n}
        assert all(math.isclose(scores[k], v) for (m, k), v in found.items() if m == n)


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    scratch = Scratch(spark, "test")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, scratch.keep(stage(spark, kept, sf_dir))
        assert kept.columns == docs.columns and kept.exceptAll(before).count() == 0
        if name == "quality":
            wrong = quality.classify(spark, before, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("predicted = 0")
            assert before.count() - kept.count() == wrong.count()
        if name == "near_duplicates":
            groups = bagminhash.near_duplicates(spark, before).select("group_id").distinct()
            assert kept.count() == groups.count()
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("text", [
    "<|Endoftext|> z", "<|endoftext|> Z", "A<|endoftext|>B", "<|STARTOFTEXT|>", "x<|startoftext|>,", "<|", "<| A |>",
    "É<|EndOfText|>."])
def test_special_tokens_are_matched_as_they_are_spelled(text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.WordIds(path).ids(text), "<u4").tolist() == want


def test_a_run_of_letters_counts_to_its_end():
    run = "字" * 70
    assert toxicity.features(run + "甲乙丙丁") != toxicity.features(run + "甲丙乙丁")
    model = {"bias": 0.0, "weights": {f: 1.0 for f in toxicity.features(run + "甲乙丙丁")}}
    scorer = toxicity.Scorer(model)
    assert scorer(run + "甲乙丙丁") > scorer(run + "甲丙乙丁") and not scorer.known


def test_a_form_around_the_whole_page_is_no_form():
    page = """<html><body><form action="x"><input type="hidden" value="v"><nav><a href="/">Home</a></nav>
      <div><h1>Title</h1><p>The first paragraph of some length, with a comma.</p>
      <p>And a second one that is also long enough to count.</p></div>
      <select><option>One</option></select><label>Name</label><button>Send</button></form></body></html>"""
    want = "Title\n\nThe first paragraph of some length, with a comma.\n\nAnd a second one that is also long enough to count."
    assert html_text.main_text(page) == want
    beside = page.replace('<form action="x">', "").replace("</form>", "<form><p>Leave a reply</p><input></form>")
    assert html_text.main_text(beside) == want
