"""Class-based language model, hard negatives and collocations against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from metricas.llm import brown_lm, collocations, hard_negatives

from .brute import split


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# ---- language model ----

def unigrams(rows):
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, *_ in rows}
    tokens = [(d, [*split(low(t)), None]) for d, t, *_ in rows]
    c = Counter(w for d, ws in tokens if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted((d, held[d], len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws), 6)) for d, ws in tokens)


def test_counts_and_base_score(spark, frame, rows):
    rows = [*rows, rows[3], rows[3]]  # a repeated row counts each time
    got = brown_lm.evaluate(frame(rows)).collect()
    assert sorted((*r[:5], round(r.base_score, 6)) for r in got) == unigrams(rows)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)


def test_no_training_texts_and_no_rows(spark, frame):
    held = [d for d in range(60) if zlib.crc32(str(d).encode()) % 5 == 1][:3]
    got = brown_lm.evaluate(frame([(d, "a b c") for d in held])).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(True, 4, 0, 0, 0.0)] * 3
    assert all(math.isfinite(r.score) for r in got)
    assert brown_lm.evaluate(frame([])).collect() == []


def grammar(n, seed=3):
    """Texts whose words alternate between three kinds: a class bigram tells the next word's kind."""
    r = random.Random(seed)
    kinds = [[f"{k}{i}" for i in range(40)] for k in "xyz"]
    return [(d, " ".join(r.choice(kinds[i % 3]) for i in range(r.randrange(6, 40)))) for d in range(n)]


def test_classes_find_the_kinds_and_lower_the_perplexity(spark, frame):
    docs = frame(grammar(400))
    tokens = brown_lm.tokenise(docs, "doc_id", "text", brown_lm.held_out_of(F.col("doc_id")))
    model = brown_lm.train(tokens)
    p = 10.0 ** model.transitions
    assert np.allclose(p.sum(1), 1)
    scored = brown_lm.score(tokens, model)
    own = {r.held_out: r.perplexity for r in brown_lm.perplexity(scored).collect()}
    base = {r.held_out: r.perplexity for r in brown_lm.perplexity(scored, "base_score").collect()}
    assert own[True] < 0.6 * base[True] and own[False] < 0.6 * base[False]


def test_probabilities_of_all_tokens_after_a_class_sum_to_one(spark, frame):
    tokens = brown_lm.tokenise(frame(grammar(100)), "doc_id", "text", brown_lm.held_out_of(F.col("doc_id")))
    model = brown_lm.train(tokens)
    emitted = np.zeros(brown_lm.CLASSES)
    for r in model.words.collect():
        k = model.classes[model.units.of(np.array([r.word], np.int64).view(np.uint64), np.array([r.ending]))[0]]
        emitted[k] += (r.n + brown_lm.ADDED) / model.mass[k]
    emitted[1:] += brown_lm.ADDED / model.mass[1:]  # a word not seen, of a class that its ending gives
    assert np.allclose(emitted[1:], 1)


def test_exchange_moves_to_the_most_likely_class_and_never_lowers_the_likelihood(spark, frame):
    r = np.random.default_rng(5)
    units, k = 12, 4
    pairs = r.integers(0, 9, (units, units)) * (r.random((units, units)) < .6)
    own = np.array([0] + [1 + i % 3 for i in range(units - 1)])

    def counts(own):
        out = np.zeros((k, k))
        for a in range(units):
            for b in range(units):
                out[own[a], own[b]] += pairs[a, b]
        return out
    for unit in range(1, units):
        scores = {}
        for to in range(1, k):
            other = own.copy()
            other[unit] = to
            scores[to] = brown_lm.likelihood(counts(other))
        rest = np.arange(units) != unit
        outs = np.bincount(own[rest], pairs[unit, rest], k)
        ins = np.bincount(own[rest], pairs[rest, unit], k)
        to = brown_lm.best_class(counts(own), int(own[unit]), outs, ins, float(pairs[unit, unit]))
        assert scores[to] >= max(scores.values()) - 1e-9
    tokens = brown_lm.tokenise(frame(grammar(200)), "doc_id", "text", brown_lm.held_out_of(F.col("doc_id")))
    words = brown_lm.count_words(tokens)
    named = brown_lm.Units([x.word for x in words.where("word != 0").collect()])
    bigrams = brown_lm.unit_bigrams(tokens, named)
    seen = []
    for rounds in (0, 2, 6):
        classes, n = brown_lm.exchange(bigrams, named.count, classes=8, rounds=rounds)
        assert (n == brown_lm.class_counts(bigrams, classes, 8)).all()
        seen.append(brown_lm.likelihood(n))
    assert seen == sorted(seen) and seen[-1] > seen[0]


def test_a_task_holds_few_slices_at_once(spark, frame, monkeypatch):
    """However many slices a task makes, a row group, which Parquet's writer and Spark's reader hold whole, has one."""
    groups = lambda df: [f.metadata.row_group(i).num_rows for f in map(pq.ParquetFile, sorted(
        x.removeprefix("file://") for x in df.inputFiles())) for i in range(f.num_row_groups)]
    docs, held = frame(grammar(400), parts=1), brown_lm.held_out_of(F.col("doc_id"))
    one = brown_lm.evaluate(docs).orderBy("doc_id").collect()
    monkeypatch.setattr(brown_lm, "SLICE_BYTES", 2000)
    monkeypatch.setattr(brown_lm, "UNIT_ROWS", 5)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 20)
    try:
        tokens = brown_lm.tokenise(docs, "doc_id", "text", held)
    finally:
        spark.conf.set(batch, before)
    assert len(groups(tokens)) > 10 and set(groups(tokens)) == {1}
    units = brown_lm.Units([x.word for x in brown_lm.count_words(tokens).where("word != 0").collect()])
    assert max(groups(brown_lm.unit_bigrams(tokens, units))) == 5
    many = brown_lm.score(tokens, brown_lm.train(tokens)).orderBy("doc_id").collect()
    assert [r[:5] for r in many] == [r[:5] for r in one]
    assert np.allclose([r[5:] for r in many], [r[5:] for r in one])


def test_packed_numbers_come_back(spark):
    r = np.random.default_rng(2)
    for kind, most in ((np.int16, 2047), (np.int32, (1 << 31) - 1)):
        for n in (0, 1, 2, 1000):
            x = r.integers(0, most, n, endpoint=True).astype(kind)
            assert (brown_lm.unpacked(brown_lm.packed(x), n, kind) == x).all()
    small = np.zeros(1000, np.int32)
    small[::50] = 70000
    assert len(brown_lm.packed(small)) < small.nbytes / 4


# ---- hard negatives ----

def brute_negatives(rows, positives=5, negatives=10):
    v = [(i, label, [math.floor(256 * x) for x in vec]) for i, vec, label in rows]
    out = []
    for anchor, label, q in sorted(x for x in v if x[0] % 100 == 0):
        score = sorted((-sum(a * b for a, b in zip(q, y)), i, k) for i, k, y in v if i != anchor)
        for s, i, _ in [x for x in score if x[2] == label][:positives]:
            fit = [x for x in score if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(anchor, i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(fit)]
    return sorted(out)


def vectors(kind, n=700, seed=2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, 8))
    x = {"flat": r.normal(size=(n, 8)), "clustered": centres[r.integers(0, 6, n)] + .05 * r.normal(size=(n, 8)),
         "copies": np.repeat(r.normal(size=(n // 100, 8)), 100, axis=0)}[kind]
    label = np.where(r.random(n) < .4, 3, r.integers(0, 10, n))  # one label holds almost half of the rows
    return [(int(i), [float(c) for c in vec], int(k)) for i, (vec, k) in enumerate(zip(x, label))]


EMBEDDINGS = "vec_id long, embedding array<double>, label int, cell string, away string, vec string, scores string"


@pytest.mark.parametrize("kind,block", [("flat", 4000), ("clustered", 50), ("copies", 4000), ("copies", 30)])
def test_negatives_equal_brute_force(spark, monkeypatch, kind, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "PIVOTS", 5)
    rows = vectors(kind)
    odd = [(None, [1.0] * 8, 3), (700, None, 3), (702, [1.0] * 8, None), (703, [float("nan")] * 8, 1),
           (704, [1.0] * 7 + [None], 1), (705, [1.0] * 3, 1), (706, [], 1), (707, [float("inf")] * 8, 3)]
    zero = [(800, [0.0] * 8, 3), (801, [0.0] * 8, 4)]
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows + odd + zero], EMBEDDINGS).repartition(4)
    assert sorted(tuple(r) for r in hard_negatives.mine(df).collect()) == brute_negatives(rows + zero)


def test_trees_cover_their_points_and_skip_nodes():
    r = np.random.default_rng(1)
    x = np.concatenate([c + r.integers(-20, 20, (300, 6)) for c in r.integers(-2000, 2000, (8, 6))]).astype(np.int64)
    space = hard_negatives.Space(6, int((x * x).sum(1).max()))
    grown = hard_negatives.grow(np.arange(len(x)), np.zeros(len(x), np.int64), x, space)
    tree = hard_negatives.Tree({k: v.tobytes() for k, v in grown.items()}, space)
    points = space.augmented(tree.vecs)

    def rows(at):
        if not tree.many[at]:
            return list(range(tree.low[at], tree.high[at]))
        return [i for c in range(tree.first[at], tree.first[at] + tree.many[at]) for i in rows(c)]
    assert sorted(rows(0)) == list(range(len(x)))
    for at in range(len(tree.many)):
        assert space.distances(points[rows(at)], points[tree.centre[at]]).max() <= tree.radius[at]
        for c in range(tree.first[at], tree.first[at] + tree.many[at]):
            assert tree.radius[c] <= hard_negatives.COVER * tree.radius[at] * (1 + 1e-6)
    looked = []
    best = hard_negatives.Best(5, hard_negatives.LOWEST, hard_negatives.HIGHEST)

    def leaf(at):
        looked.append(at.stop - at.start)
        best.add(space.products(tree.vecs[at], x[0]), tree.ids[at])
    tree.descend(x[0], lambda least, greatest, mask: greatest >= best.floor(), leaf)
    want = sorted((-int(s), i) for i, s in enumerate(x @ x[0]))[:5]
    assert list(zip((-best.score).tolist(), best.ids.tolist())) == want
    assert sum(looked) < len(x) / 2


def test_negatives_of_small_and_empty_tables_and_repeated_ids(spark):
    def run(rows):
        df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], EMBEDDINGS)
        return sorted(tuple(r) for r in hard_negatives.mine(df).collect())
    assert run([]) == [] and run([(0, [1.0], 1)]) == [] and run([(0, [], 1), (1, [], 2)]) == []
    assert run([(0, [1.0], 1), (1, [1.0], 1), (2, [.5], 2)]) == [(0, 1, 1, 2, 65536, 32768)]
    # of the anchor's two rows the one with the smaller label asks; row 2 counts twice
    assert run([(0, [1.0], 1), (0, [1.0], 4), (1, [1.0], 1), (2, [.5], 2), (2, [.5], 2)]) == [
        (0, 1, 1, 2, 65536, 32768), (0, 1, 2, 2, 65536, 32768)]
    with pytest.raises(ValueError, match="too large"):
        run([(0, [1e12], 1), (1, [1.0], 1)])


# ---- collocations ----

def brute_phrases(rows, longest=3, least=10, inside=50, top=2000):
    f, n = {}, Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(text)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang or "und", Counter())[tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        hidden = {p[i:i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                  if 100 * a >= inside * found[p[i:i + m]]}
        rank = []
        for p, a in found.items():
            if p not in hidden:
                s, k = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rank.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rank)[:top])]
    return sorted(out)


def phrase_texts(seed=4, n=150):
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(.8))}" for _ in range(400)] + ["Über", "été", "😀", "A-B", "x\x00y"]
    passage = "The quick brown fox, jumps over the lazy dog. Again the quick brown fox!\nend of it"
    rows = []
    for d in range(n):
        text = "".join(r.choice(words) + r.choice([" "] * 9 + ["\t", "  ", ", ", ".", "\n", "\r\n", " ; ", "??"])
                       for _ in range(r.choice([0, 1, 2, 5, 40, 120])))
        if d % 3 == 0:
            text += passage
        rows.append((d, text, r.choice(["en", "de", None, "und"])))
    rows += [(n, None, "en"), (n + 1, "", "fr"), (n + 2, " ,. \n", "fr"), (n + 3, "same " * 3000, "en"),
             (n + 4, ".".join(["a b"] * 500) + "!" * 40, "en")]
    return rows + [rows[0]] * 25 + [rows[3]] * 12


@pytest.mark.parametrize("longest,top", [(3, 2000), (2, 5), (5, 40)])
def test_collocations_equal_brute_force(spark, frame, longest, top):
    rows = phrase_texts()
    got = collocations.mine(frame(rows), longest=longest, top=top)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, longest, top=top)


def test_collocations_of_empty_tables(spark, frame):
    assert collocations.mine(frame([])).collect() == []
    assert collocations.mine(frame([(1, None, None), (2, "one word", "en")])).collect() == []


def test_parse_is_prefix_free_and_shift_resistant(spark, frame):
    r = random.Random(9)
    passage = " ".join(f"v{r.randrange(200)}" for _ in range(3000))
    rows = [(d, " ".join(f"u{d}x{i}" for i in range(d)) + " " + passage, "en") for d in range(20)]
    chunks = collocations.parse(frame(rows), "text", "lang", 2).collect()
    often = [c for c in chunks if c.n >= 19]
    assert len(often) > 50 and sum(c.n for c in often) > 0.9 * sum(c.n for c in chunks)
    total = sum((len(c.chunk.split(" ")) - 2) * c.n for c in chunks)  # every word in the chunk it begins in
    assert total == sum(len(split(t)) for _, t, _ in rows)
