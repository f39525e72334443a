"""Rows that repeat an id and text: each gets its own row, and all of them the same answer."""

import public_tokenizers
import pytest

from metricas.llm import bpe, lang_id, packing, pii

TEXT = "write to ann@example.org or call +1 212 555 0100 about the harbour and the long winter"
ROWS = [(1, TEXT, "en"), (1, TEXT, "en"), (2, "une autre phrase avec des mots", "fr"), (3, None), (3, None)]


@pytest.mark.parametrize("op", [
    pii.detect, lang_id.identify,
    lambda docs: bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ("n_tokens", "ids_sha256", "decoded_sha256")),
], ids=["op3", "op10", "op8"])
def test_repeated_rows_get_equal_answers(frame, op):
    got = op(frame(ROWS)).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 3, 3]
    for d in (1, 3):
        assert len({str(r) for r in got if r.doc_id == d}) == 1


def test_repeated_rows_are_packed_each(frame):
    got = packing.pack_documents(frame(ROWS), public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 3, 3]
    assert len({(r.length, r.ids_crc32) for r in got if r.doc_id == 1}) == 1
    assert len({(r.sequence_id, r.offset) for r in got}) == 5
