"""BPE and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from metricas.llm import bpe, packing, tokens
from metricas.llm.common import text_buffers

PIECES = ["a", "b", "Z", "s", "t", "ll", "'", "'s", " ", "  ", "\n", "\t", "\r\n", "\x0b", " ", "　", " ", "é", "É",
          "ß", "İ", "Σ", "ς", "ñ", "中", "日本", "😀", "é", "́", "!", "?", "...", ",", "(", "|", "<", "<|endoftext|>",
          "<|startoftext|>", "1", "23", "٣", "½", "_", "-", "​", "\x1c", "\x85", "ﬁ", "̸", "ж", "К", "א", "क्", "#"]


@pytest.mark.parametrize("name,words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_fragments_encode_as_the_whole_text(name, words):
    r = random.Random(3)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randrange(14))) for _ in range(8000)]
    texts += ["".join(chr(r.choice([r.randint(1, 0x24f), r.randint(0x250, 0x3fff), r.randint(32, 126)]))
                      for _ in range(r.randrange(10))) for _ in range(8000)]
    spec = open(public_tokenizers.path(name), encoding="utf-8").read()
    library, own = Tokenizer.from_str(spec), tokens.FragmentEncoder(spec, words)
    ids, offs = own.encode(*text_buffers(pa.array([*texts, None])))
    want = [e.ids for e in library.encode_batch([*texts, ""], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == want


def test_forced_cuts_split_at_pairs_in_no_token():
    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    own = tokens.FragmentEncoder(spec, False)
    data = np.frombuffer("der Hund, the cat's".encode(), np.uint8)
    cuts = np.flatnonzero(tokens.forced_cuts(data, own.inside))
    assert {3, 8, 9, 13} <= set(cuts.tolist())  # before blanks and the comma
    assert all(not own.inside[data[i - 1], data[i]] for i in cuts)


def test_bpe_query(frame, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in bpe.encode(frame(rows), path, tuple(bpe.COLUMNS)).collect()}
    assert len(got) == len(rows)
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = got[doc]
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), text or "")
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(frame([]), path).collect() == []


def test_packing_query(frame, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = {}
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 512)):
            cut = ids[start:start + 512]
            want[doc, piece] = (start, len(cut), zlib.crc32(cut.tobytes()))
    got = packing.pack_documents(frame(rows), path, max_tokens=512).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= -(-sum(v[1] for v in want.values()) // 512) + 1
    assert packing.pack_documents(frame([]), path).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(rule):
    lengths = np.minimum(700, np.random.default_rng(1).lognormal(4, 1.2, 3000).astype(int) + 1)
    capacities = (1000, 5, 500_000.0)
    at = packing.pack(lengths, capacities, (1, 0.5, 0.5), rule)
    for weights, most in ((lengths, 1000), (np.ones(len(lengths)), 5), (lengths.astype(float) ** 2, 500_000)):
        assert np.bincount(at, weights).max() <= most


def test_best_fit_is_dense_and_groups_are_bounded(spark):
    lengths = np.minimum(4096, np.random.default_rng(2).lognormal(6.5, 1.2, 4000).astype(int) + 1)
    assert packing.pack(lengths, (4096, 4096, 4096.0 ** 2), (1, 1e-3, 1e-3)).max() < -(-lengths.sum() // 4096) + 1
    rows = spark.createDataFrame([(i, 0, int(n)) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    got = packing.best_fit(rows, group_pieces=500).collect()
    assert len(got) == len(lengths) and len({r.sequence_id for r in got}) <= -(-lengths.sum() // 4096) + 10


def test_a_piece_beyond_a_capacity_is_refused():
    with pytest.raises(ValueError):
        packing.pack(np.array([10]), (5, 5, 25.0), (1, 1, 1))
