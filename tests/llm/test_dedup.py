"""Exact, substring, line and near-duplicate operators against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from metricas.llm import exact_dedup, line_dedup, ngram_join, substring_dedup
from metricas.llm.common import text_buffers
from metricas.llm.words import Words

from .brute import BLANK, classes, split
from .conftest import corpus


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_exact_dedup(frame, rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(BLANK.sub("", text or ""), []).append((-len(text or ""), doc))
    want = {}
    for norm, own in groups.items():
        for _, doc in own:
            want[doc] = (min(own)[1], len(own), doc == min(own)[1], sha(norm))
    got = exact_dedup.dedup(frame(rows, 40)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(rows)


def test_exact_dedup_merges_over_several_rounds(frame, rows):
    one, many = (exact_dedup.dedup(frame(rows, p), bits=1) for p in (1, 9))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def without_windows(rows):
    """(words, removed words, digest of the rest) of each document, by looking every window up."""
    words, first = {d: split(t) for d, t in rows}, {}
    for d in sorted(words):
        for i in range(len(words[d]) - 12):
            first.setdefault(tuple(words[d][i:i + 13]), d)
    want = {}
    for d, w in words.items():
        gone = {k for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < d for k in range(i, i + 13)}
        want[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return want


def test_substring_dedup(frame, rows):
    want = without_windows(rows)
    got = substring_dedup.digest_rows(substring_dedup.dedup(frame(rows))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(rows)
    assert sum(v[1] for v in want.values()) > 500


@pytest.fixture
def small_batches(spark):
    """Many slices in a task, and no broadcast joins."""
    ours = {"spark.sql.execution.arrow.maxRecordsPerBatch": "20", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def third(n, passage, sep=" "):
    """Texts of own words, and the passage in a third of them, at places of any residue."""
    r = random.Random(n)
    out = []
    for d in range(n):
        own = [f"o{d}_{i}" if r.random() < 0.7 else f"c{r.randrange(40)}" for i in range(r.choice([3, 8, 20, 33]))]
        if d % 3 == 0:
            own[d % 7:d % 7] = passage
        out.append((d, sep.join(own)))
    r.shuffle(out)
    return out


def test_a_passage_in_a_third_of_the_documents(frame, small_batches):
    rows = third(900, [f"p{i}" for i in range(25)])
    got = substring_dedup.digest_rows(substring_dedup.dedup(frame(rows))).collect()
    want = without_windows(rows)
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert sum(v[1] for v in want.values()) >= 25 * 299
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.join(frame(rows)).collect()}
    assert got == classes(rows)


def test_lines_in_a_third_of_the_documents(frame, small_batches):
    rows = third(900, [f"license line {i}" for i in range(12)], "\n")
    seen, want = set(), {}
    for d, t in sorted(rows):
        own = line_dedup.chunks(t)
        gone = [c for c in own if len(c) > 1 and tuple(c) in seen]
        want[d] = sum(map(len, gone))
        seen |= {tuple(c) for c in own}
    assert {r.doc_id: r.n_removed for r in line_dedup.dedup(frame(rows)).collect()} == want
    assert sum(want.values()) > 299 * 4


def test_a_task_asks_once_for_what_many_documents_hold():
    rows = sorted(third(900, [f"p{i}" for i in range(25)]))
    batches = [pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in rows[i:i + 90]], "text": [t for _, t in rows[i:i + 90]]})
               for i in range(0, 900, 90)]
    found = [b.append_column("found", pa.array([[substring_dedup.planes(h, 5)] if len(h) else [] for h in anchors_of(b)],
                                              pa.list_(pa.binary())))
             for b in batches]

    def asked(run, tasks):
        return sum(len(substring_dedup.unplanes(r["at"], 2, np.uint16)) for own in tasks
                   for out in run(iter(own)) for r in out.to_pylist() if not r["settled"])
    for step, own, least in ((substring_dedup.anchor_postings, batches, 15), (substring_dedup.window_postings, found, 13)):
        one, many = asked(step(13, 4), [own]), asked(step(13, 4), [[b] for b in own])
        assert many - one >= least * 9  # nine further slices needn't ask for the passage's anchors and windows


def anchors_of(batch):
    """The hashes of the anchors of each row that hold nothing but words of the passage."""
    out = []
    for text in batch.column("text").to_pylist():
        w = Words(*text_buffers(pa.array([text])))
        places, hashes = substring_dedup.cover_anchors(w, w.numbers(), 13)
        words = split(text)
        out.append(hashes[[all(x[0] == "p" for x in words[p:p + 7]) for p in places]] if len(places) else hashes)
    return out


def test_every_pair_of_positions_shares_an_anchor():
    for i in range(substring_dedup.PERIOD):
        for j in range(substring_dedup.PERIOD):
            assert any((i + k) % 7 in substring_dedup.COVER and (j + k) % 7 in substring_dedup.COVER for k in range(7))


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(frame, seed):
    rows = corpus(seed, 90)
    got = ngram_join.join(frame(rows)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == classes(rows) and len(got) == len(rows)


def test_ngram_join_chain_of_near_copies(frame):
    # each links with its neighbours alone: an open list is resolved beyond its first set
    words = [f"v{i}" for i in range(160)]
    rows = [(i, " ".join(words[i * 6:i * 6 + 64])) for i in range(16)]
    got = {r.doc_id: tuple(r)[1:] for r in ngram_join.join(frame(rows)).collect()}
    assert got == classes(rows)
    assert {c for _, c in got.values()} == {0}


def chunked(text):
    return line_dedup.chunks(text)


def test_line_dedup(frame, rows):
    r = [(d, "\n".join([f"l{d % 7}-{i // 3}" for i in range(d % 11 + 1)] + (t or "").split("\n")) if t and d % 2 else t)
         for d, t in rows]
    seen, want = set(), {}
    for d, t in sorted(r):
        keep, removed = [], 0
        for c in chunked(t):
            if len(c) > 1 and tuple(c) in seen:
                removed += len(c)
            else:
                keep += c
            if len(c) > 1:
                seen.add(tuple(c))
        want[d] = (len(t.split("\n")) if t else 0, removed, "\n".join(keep) if t else t)
    got = {x.doc_id: tuple(x)[1:] for x in line_dedup.dedup(frame(r)).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 50


def test_line_dedup_leaves_nothing_of_a_copy(frame):
    texts = ["\n".join(f"text {i} line {k}" for k in range(2 + i % 9)) for i in range(90)]
    assert any(len(c) < 2 for t in texts for c in line_dedup.chunks(t, least=1))
    got = {r.doc_id: tuple(r)[1:] for r in line_dedup.dedup(frame(list(enumerate(texts * 2)))).collect()}
    for i, t in enumerate(texts):
        n = t.count("\n") + 1
        assert got[i] == (n, 0, t) and got[i + 90] == (n, n, "")


def test_line_chunks_resist_shifts():
    lines = [f"line {i}" for i in range(200)]
    whole, shifted = ([tuple(c) for c in chunked("\n".join(x))] for x in (lines, ["new", "lines", *lines]))
    assert len(set(whole) & set(shifted)) >= len(whole) - 2
    assert [x for c in whole for x in c] == lines


@pytest.mark.parametrize("op", [exact_dedup.dedup, substring_dedup.dedup, line_dedup.dedup, ngram_join.join])
def test_empty_tables_and_repeated_rows(frame, op):
    assert op(frame([])).collect() == []
    text = "a b c d e f g h i j k l m n\no p q"
    got = op(frame([(1, text), (1, text), (2, text), (3, None), (3, None)])).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 3, 3]
    assert len({str(r) for r in got if r.doc_id == 1}) == 1


def boilerplate(n):
    """A line of 14 words that all documents share, and three words of their own: Jaccard 0.63, no links."""
    shared = " ".join(f"license{i}" for i in range(14))
    return [(d, f"{shared} a{d} b{d} c{d}") for d in range(n)]


def test_entries_that_stand_too_late_never_meet(spark, frame, monkeypatch):
    met = []
    meetings = ngram_join.meetings
    monkeypatch.setattr(ngram_join, "meetings", lambda entry: met.append((entry.count(), meetings(entry).count())) or meetings(entry))
    got = {r.doc_id: r.component_id for r in ngram_join.join(frame(boilerplate(600))).collect()}
    assert got == {d: d for d in range(600)}
    assert met and all(pairs == 0 for _, pairs in met)


def test_shared_lines_of_many_lengths_against_brute_force(spark, frame):
    r = random.Random(8)
    shared = [f"license{i}" for i in range(40)]
    rows = []
    for d in range(150):
        own = [f"w{r.randrange(30)}" for _ in range(r.choice([0, 1, 2, 3, 5, 9, 14]))]
        cut = r.randrange(5, 41)
        rows.append((d, " ".join(own[:len(own) // 2] + shared[:cut] + own[len(own) // 2:])))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.join(frame(rows)).collect()}
    assert got == classes(rows)
