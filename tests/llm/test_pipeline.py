"""The pipeline's stages on a small corpus, each against a brute-force version of its step."""

import importlib.util
import random
import re
from pathlib import Path

import pytest

from metricas.llm import line_dedup

from .brute import classes, pattern_spans

spec = importlib.util.spec_from_file_location("corpus_pipeline", Path(__file__).parents[2] / "corpus_pipeline.py")
corpus_pipeline = importlib.util.module_from_spec(spec)
spec.loader.exec_module(corpus_pipeline)

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, rep string, found string, "
           "cut string, score string, languages string, lang_pred string, _cut_text string, component_id long")


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(9)
    bank = {"en": "the and of to that with this was for are".split(), "fr": "le la des et est que pour dans avec où".split()}
    rows, block = [], "\n".join(f"a shared line and the line after it {i}" for i in range(16))
    for i in range(80):
        lang = r.choice(list(bank))
        text = " ".join(r.choice(bank[lang]) + str(r.randrange(40)).translate(str.maketrans("0123456789", "abcdefghij"))
                        for _ in range(r.choice([8, 60, 150])))
        if i % 5 == 0:
            text = block + "\n" + text
        if i % 7 == 0:
            text += " mail a.b@c.example.org ok"
        if i % 4 == 3:
            text = rows[-1][1].replace("a", "ab", 1)
        rows.append((i, text, lang, "s", len(text)))
    rows += [(100, None, None, "s", None), (101, "", None, None, 0), (102, "12 !?", "en", "s", 5), (None, "no id here", "en", "s", 10)]
    rows += [rows[3]]
    return spark.createDataFrame([(*x, "r", "f", "c", "mine", "l", "p", "t", -7) for x in rows], COLUMNS)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_in_order(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "ngram_join", "pii", "packing"]
    kept = stages["language_id"](spark, docs, "")
    assert set(texts(docs)) - set(texts(kept)) == {100, 101, 102}
    assert kept.count() == docs.count() - 3

    cut = stages["line_dedup"](spark, kept, "")
    seen, want = set(), {}
    for d, t in sorted(texts(kept).items(), key=lambda x: (x[0] is None, x[0])):
        out = []
        for c in line_dedup.chunks(t):
            if len(c) < 2 or tuple(c) not in seen or d is None:
                out += c
            if len(c) > 1:
                seen.add(tuple(c))
        want[d] = "\n".join(out)
    assert texts(cut) == want and want != texts(kept)
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    single = stages["ngram_join"](spark, cut, "")
    want = {d for d, (_, c) in classes([x for x in texts(cut).items() if x[0] is not None]).items() if c == d}
    assert set(texts(single)) == want | {None} and len(want) < 80
    assert single.columns == docs.columns

    masked = stages["pii"](spark, single, "")
    for d, t in texts(single).items():
        out, at = "", 0
        for a, kind, b in pattern_spans(t):
            out, at = out + t[at:a] + f"<{['EMAIL', 'IP', 'CARD', 'PHONE'][kind]}>", b
        assert texts_of(masked, d) == out + t[at:]
    for rows in (kept, cut, single, masked):  # columns that bear names of the operators' own
        assert rows.columns == docs.columns
        assert {(r.cut, r.score, r.languages, r.lang_pred, r.component_id) for r in rows.collect()} == {("c", "mine", "l", "p", -7)}
    packed = stages["packing"](spark, masked, "").collect()
    assert {r.doc_id for r in packed} == set(texts(masked)) and max(r.offset + r.length for r in packed) <= 4096


def texts_of(df, doc, cache={}):
    if id(df) not in cache:
        cache[id(df)] = texts(df)
    return cache[id(df)][doc]


def test_run_and_empty_tables(spark, docs, tmp_path):
    clean = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    clean.write.parquet(f"{tmp_path}/a/documents.parquet")
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(corpus_pipeline.run(spark, f"{tmp_path}/a").columns)
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []


def test_operators_do_not_hide_import_errors():
    sources = [Path(corpus_pipeline.__file__), *Path(line_dedup.__file__).parent.glob("*.py")]
    assert not [p for p in sources if re.search(r"except.*(Import|ModuleNotFound)Error|except Exception|except:", p.read_text())]
