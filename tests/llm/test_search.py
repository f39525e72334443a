"""Nearest neighbours, language, personal data and web derivatives."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metricas.llm import ann, lang_id, pii, warc
from metricas.llm.common import text_buffers

from .brute import PATTERNS, pattern_spans


def vectors(n=1500, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) + 3 * rng.normal(size=(8, dim))[rng.integers(0, 8, n)]
    x[300:320] = x[300]  # ties
    return x.astype(np.float32)


@pytest.fixture(scope="module")
def vector_table(spark):
    rows = [(i, v.tolist(), "x", "y") for i, v in enumerate(vectors())]
    rows += [(2000, None, "x", "y"), (2100, [0.0] * 16, "x", "y"), (2200, [float("nan")] * 16, "x", "y"),
             (2300, [1.0, None] * 8, "x", "y"), (2400, [float("inf")] + [0.0] * 15, "x", "y"), (2500, [1.0, 2.0], "x", "y"),
             (None, [1.0] * 16, "x", "y")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string, part string")


def exact(k=10):
    x = vectors().astype(float)
    out = {}
    for q in range(0, len(x), 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        near = np.lexsort((np.arange(len(x)), d))[:k]
        out[q] = [(int(i), float(d[i])) for i in near]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_search_with_all_cells_is_exact(vector_table):
    got = found(ann.search(vector_table, candidates=1.0).collect())
    want = exact()
    assert {q: [v for v, _ in own] for q, own in got.items()} == {q: [v for v, _ in own] for q, own in want.items()}
    assert all(abs(a - b) < 1e-12 for q in want for (_, a), (_, b) in zip(got[q], want[q]))


def test_search_recall(vector_table):
    got, want = found(ann.search(vector_table).collect()), exact()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_search_small_and_empty(spark, vector_table):
    assert ann.search(vector_table.where("vec_id < 0")).collect() == []
    got = ann.search(vector_table.where("vec_id < 4")).collect()
    assert [(r.query_id, r["rank"]) for r in got] == [(0, 1), (0, 2), (0, 3)]  # all candidates where fewer


def test_multi_sequence_walks_by_summed_distance():
    rng = np.random.default_rng(4)
    books = [rng.normal(size=(6, 2)), rng.normal(size=(6, 2))]
    sizes = {c: 1 for c in range(36)}
    index = ann.Index(books, sizes)
    (da, db) = (d[0] for d in index.distances(rng.normal(size=(1, 4))))
    sums = np.sort((da[:, None] + db).ravel())
    assert [index.reach(da, db, k) for k in (1, 7, 36)] == pytest.approx([sums[0], sums[6], sums[35]])
    assert index.reach(da, db, 37) == np.inf


LANGUAGES = {"en": "the and of to that with from this was for are not", "de": "der die und nicht mit von für auch über sich",
             "fr": "le la les des et est que pour dans été être où", "es": "el los que para una con por más señor niño"}


def speech(lang, n, r):
    return " ".join(r.choice(LANGUAGES[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def spoken():
    r = random.Random(2)
    rows = []
    for i in range(240):
        lang = r.choice(list(LANGUAGES))
        rows.append((i, speech(lang, r.choice([6, 30, 120]), r), lang))
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "12 345 !?", "de"), (1003, "É", None), (1004, "the " * 40000, None)]
    return rows


def test_language_of_held_out_documents(frame, spoken):
    got = {r.doc_id: r for r in lang_id.identify(frame(spoken)).collect()}
    import zlib
    assert len(got) == len(spoken)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in spoken)
    held = [(got[i].lang_pred, lang) for i, _, lang in spoken if i < 1000 and got[i].held_out]
    assert np.mean([a == b for a, b in held]) >= 0.95
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred in LANGUAGES and got[1004].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_mixture_finds_the_larger_language(spoken):
    r = random.Random(3)
    counts = {}
    for _, text, lang in spoken:
        if text and lang:
            feature, _ = lang_id.trigrams(*text_buffers(pa.array([text])))
            counts[lang] = counts.get(lang, 0) + np.bincount(feature, minlength=lang_id.FEATURES)
    langs, logp = lang_id.model_of(counts)
    mixed = pa.array([speech("de", 140, r) + " " + speech("fr", 60, r), speech("es", 50, r) + " " + speech("en", 150, r)])
    lang, share = lang_id.infer(logp, *text_buffers(mixed))
    assert [langs[i] for i in lang] == ["de", "en"]
    assert all(0.5 < s < 0.9 for s in share)


def test_languages_of_a_text_that_mixes_four(frame, spoken):
    r = random.Random(4)
    model = lang_id.train(frame(spoken))
    mixed = " ".join(speech(lang, n, r) for lang, n in (("de", 120), ("fr", 90), ("es", 70), ("en", 50)))
    got = {x.doc_id: x for x in lang_id.predict(frame([(1, mixed), (2, speech("en", 80, r)), (3, "12")]), model).collect()}
    assert [x.lang for x in got[1].languages] == ["de", "fr", "es", "en"] and got[1].lang_pred == "de"
    assert sum(x.share for x in got[1].languages) == pytest.approx(1)
    assert [x.lang for x in got[2].languages] == ["en"] and got[3].languages == []


def test_language_with_nothing_to_learn(frame):
    assert lang_id.identify(frame([])).collect() == []
    got = lang_id.identify(frame([(1, "some text", None), (2, None, "en")])).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_exact_spans_are_those_of_the_patterns():
    r = random.Random(5)
    parts = ["a", "b.c", "@", "x@y.z", "@a.b", ".", "1", "22", "255", "1.2.3.4", "300", "-", " ", "+", "+1 (555) 010-9999",
             "4111111111111111", "4111 1111 1111 1111", "(", ")", "é", "%", "_", "\n", "0123456789"]
    for _ in range(20000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(12)))
        got = sorted((a, k, b) for a, b, k, valid in pii.exact_spans(text) if valid)
        assert got == pattern_spans(text), text


def test_personal_data_query(frame, rows):
    planted = [(500, "mail me: ann.lee@mail.example.com or call +1 (555) 010-9999 é 😀 10.0.0.1"),
               (501, "card 4111 1111 1111 1111 not 4111 1111 1111 1112, version 1.2.3.400"),
               (502, "bob [at] example [dot] com, tel (555) 010-9999"), (503, "1" * 50000 + " a" * 50000 + "@"),
               (504, "a" * 100000), (505, "+" * 50000), (506, "1.1." * 30000)]
    got = {r.doc_id: r for r in pii.detect(frame(rows + planted)).collect()}
    for doc, text in rows + planted:
        want, r = pattern_spans(text), got[doc]
        told = [f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert set(told) <= set(filter(None, r.spans.split(",")))
        assert r.n_added == len(list(filter(None, r.spans.split(",")))) - len(told)
    assert pii.detect(frame([])).collect() == []


@pytest.mark.parametrize("junk", [0, 1000])
def test_spelt_addresses_and_local_phones_are_added(frame, junk):
    r = random.Random(8)
    texts = [f"{r.choice(['', 'write to '])}ann{i}@example.{r.choice(['com', 'org', 'xyz'])} x" for i in range(100)]
    texts += [f"{r.choice(['', 'id '])}+1 {r.randrange(200, 999)} 555 {r.randrange(1000, 9999)} x" for _ in range(100)]
    texts += [f"+{r.randrange(10, 10 ** r.randrange(2, 8))} x" for _ in range(junk)]
    planted = {5000: ("bob [at] example [dot] com", "email"), 5001: ("ann.lee (at) mail.example.org", "email"),
               5002: ("tel (415) 555-0199", "phone"), 5003: ("call 415-555-0123", "phone")}
    rows = [*enumerate(texts), *((d, f"{t} x") for d, (t, _) in planted.items()), (5004, "we met (at) home. Then we left")]
    got = {x.doc_id: x for x in pii.detect(frame(rows)).collect()}
    for d, (t, kind) in planted.items():
        start = t.index("(415)") if "(415)" in t else t.index("415") if kind == "phone" else 0
        assert (got[d].spans, got[d].n_added) == (f"{kind}:{start}:{len(t)}", 1)
    assert got[5004].spans == ""


@pytest.mark.parametrize("kind, span", [
    ("email", "bob [At] example [Dot] com"), ("email", "bob(aT)example.com"), ("ip", "2001:db8::ff00:42:8329"), ("ip", "fe80::1"),
    ("phone", "01 23 45 67 89"), ("phone", "020 7946 0958"), ("phone", "(030) 1234567"), ("phone", "1-415-555-0123")])
def test_loose_candidates(kind, span):
    found = [(a, b, pii.KINDS[k], exact) for a, b, k, exact, _ in pii.candidates(f"x {span} y")]
    assert found == [(2, 2 + len(span), kind, False)]


@pytest.mark.parametrize("text", ["std::vector a::b 10::2 ::1", "01-02-2024 10 4111 0111 1111 2", "at 01.02.2024 10:30", "Foo::1234::x"])
def test_what_is_no_loose_candidate(text):
    assert pii.candidates(text) == [] or not any(c[2] in (0, 1, 3) for c in pii.candidates(text))


def test_labelers_reliability_is_recovered():
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.85, 0.6, 0.8, 0.9])
    votes = np.where(rng.random((4000, 6)) < right, truth[:, None], ~truth[:, None]) * 2
    votes[rng.random((4000, 6)) < 0.2] = 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    q, says = pii.estimate(patterns, counts.astype(float))
    reliable = says[1, :, 2] / (says[1, :, 2] + says[1, :, 0])
    assert np.abs(reliable - right).max() < 0.05
    weights = pii.classifier(["".join("-0+"[v] for v in p) for p in patterns], q, counts.astype(float))
    model = pii.Model({0: weights})
    judged = [model.probability(0, "".join("-0+"[v] for v in p)) > 0.5 for p in votes]
    assert np.mean(judged == truth) > 0.95


def test_masking_replaces_exact_spans(frame):
    rows = [(1, "to a@b.co now"), (2, None), (3, "")]
    docs = frame(rows)
    got = {r.doc_id: r.text for r in pii.mask(docs, pii.fit(pii.find_candidates(docs))).collect()}
    assert got == {1: "to <EMAIL> now", 2: None, 3: ""}


def test_derivatives_link_to_their_response(spark):
    html = ('<html><head><title>A &amp; b</title><script>var x="<p>";</script></head><body><h1>Été</h1><!-- no -->'
            '<p>One <b>bold</b> word<br>two&nbsp;&lt;3</p><a href="/x">x</a><a class="c" href="/y">y</a></body></html>')
    pages = spark.createDataFrame([(1, "http://e.org/\r\nInjected: 1", html, "z"), (2, None, None, "z"), (3, "http://e.org/3", "", "z"),
                                   (4, "u", "<p>word</p>\n" * 30000, "z")], "page_id long, url string, html string, block string")
    made = warc.derivatives(warc.responses(pages))
    rows = {(r.page_id, r.record_type): r for r in made.collect()}
    assert len(rows) == 8
    c, m = rows[1, "conversion"], rows[1, "metadata"]
    assert c.block == "A & b\nÉté\nOne bold word\ntwo <3\nxy"
    assert m.block == ("http-status: 200\r\nhttp-header-Content-Type: text/html; charset=utf-8\r\n"
                       f"http-header-Content-Length: {len(html.encode())}\r\ntitle: A &amp; b\r\noutlink: /x\r\noutlink: /y")
    source = warc.responses(pages).where("page_id = 1").first().record
    for r in (c, m):
        assert f"WARC-Record-ID: {r.refers_to}\r\n" in source
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.payload_digest == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
        assert r.content_length == len(r.block.encode()) and r.target_uri == "http://e.org/ Injected: 1"
    assert rows[2, "conversion"].block == rows[3, "conversion"].block == "" and rows[2, "conversion"].target_uri is None
    assert rows[4, "conversion"].block.count("word") == 30000
    record = warc.as_records(made.where("page_id = 1 and record_type = 'conversion'")).first().record
    head, block = record.split("\r\n\r\n", 1)
    assert f"WARC-Refers-To: {c.refers_to}" in head and block == c.block + "\r\n\r\n"
    assert warc.derivatives(warc.responses(pages.limit(0))).collect() == []


def test_links_and_references_of_every_form(spark):
    html = ("<!-- <a href=\"/no\"> --><script>'<a href=\"/no\">'</script><a data-href='/no' href='/one'>1</a><A\nHREF = /two>2</A>"
            "<a class=x href=\"/three?a'b\">3</a><abbr href=/no>4</abbr><p>&eacute;&#233;&#xE9;&#x1F600;&#150;&#0;&#55296; "
            "&amp;eacute; &#38;lt; &AMP;gt; &nosuch; a & b &#x27;&#160;&lt;")
    page = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    rows = {r.record_type: r.block for r in warc.derivatives(warc.responses(page)).collect()}
    assert [x for x in rows["metadata"].split("\r\n") if x.startswith("outlink")] == ["outlink: /one", "outlink: /two", "outlink: /three?a'b"]
    assert rows["conversion"] == "1234\n\u00e9\u00e9\u00e9\U0001f600\u2013\ufffd\ufffd &eacute; &lt; &gt; &nosuch; a & b ' <"


def test_other_and_malformed_records_are_left_out(spark):
    page = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    good = warc.responses(page)
    bad = spark.createDataFrame([(2, "WARC/1.1\r\nWARC-Type: request\r\n\r\nGET /"), (3, "no record"), (4, None), (5, "")],
                                "page_id long, record string")
    assert {r.page_id for r in warc.derivatives(good.unionByName(bad)).collect()} == {1}
    twice = warc.derivatives(good.unionByName(good))
    assert twice.count() == 4 and twice.distinct().count() == 2
    assert twice.where(F.col("block").isNull()).count() == 0


def test_lists_lie_in_blocks_of_their_cells_only():
    sizes = {0: 3, 1: 4, 3: 25, 4: 2, 7: 9}
    first, many = ann.blocks_of(sizes, 8, 10)
    assert list(zip(first[[0, 1, 3, 4, 7]].tolist(), many[[0, 1, 3, 4, 7]].tolist())) == [
        (0, 1), (0, 1), (1, 3), (4, 1), (5, 1)]
    load = {}
    for c, n in sizes.items():
        for b in range(first[c], first[c] + many[c]):
            load[b] = load.get(b, 0) + n / many[c]
    assert max(load.values()) <= 10


def test_a_cell_that_holds_most_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)] + [(i, [float(i), 0.0, 1.0, -float(i)]) for i in range(300, 400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, candidates=1.0, query_every=50, centroids=4).where("query_id < 300").collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (q, n + 1, v, 0.0) for q in range(0, 300, 50) for n, v in enumerate([v for v in range(12) if v != q][:10])]
