"""Encoding with a vocabulary of the tokenizers library, each distinct fragment once.

A text is cut at places where no token and no pre-token can reach across. The
fragments, mostly single words, repeat a lot, so only the distinct ones are
encoded and the results laid side by side.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa

from .common import gather
from .words import WHITE

ASCII = np.arange(256) < 0x80
CONTINUES = (np.arange(256) & 0xC0) == 0x80
LETTER = np.array([chr(i).isalpha() and i < 0x80 for i in range(256)])
PUNCT = np.array([i < 0x7F and i > 0x20 and not chr(i).isalnum() for i in range(256)])


def byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself
    where printable and not blank, else the next code point from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def token_bytes(spec: dict) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; added tokens are their own text."""
    back = {c: b for b, c in enumerate(byte_chars())}
    added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    size = max([*spec["model"]["vocab"].values(), *added]) + 1
    out = [b""] * size
    for token, i in spec["model"]["vocab"].items():
        out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    for i, content in added.items():
        out[i] = content
    return out


def pairs_inside(tokens: list[bytes]) -> np.ndarray:
    """256 x 256: which byte pairs occur inside some token."""
    inside = np.zeros((256, 256), bool)
    for t in tokens:
        b = np.frombuffer(t, np.uint8)
        inside[b[:-1], b[1:]] = True
    return inside


def forced_cuts(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Where (before which byte) a byte-level text can be cut for certain.

    The byte pair around the cut occurs inside no token, so no merge spans it.
    That alone would do within one pre-token; four more conditions keep the
    pre-tokens themselves: the second byte begins a character; the character
    before is not blank (a blank belongs to the following word, and the last
    blank of a run goes with what follows); the one after is no apostrophe
    (which would begin a contraction). Characters before the cut that are not
    ASCII must be of U+00C0..U+07FF, among which there are no blanks.
    """
    n = len(data)
    cut = np.zeros(n, bool)
    if n < 2:
        return cut
    a, b = data[:-1], data[1:]
    lead = np.append(np.uint8(0), data[:-2]) if n > 2 else np.zeros(1, np.uint8)
    before = np.where(ASCII[a], ~WHITE[a], (lead >= 0xC3) & (lead <= 0xDF))
    cut[1:] = ~inside[a, b] & ~CONTINUES[b] & (b != 0x27) & before
    return cut


def word_cuts(data: np.ndarray) -> np.ndarray:
    """Where a text for a vocabulary with word ends can be cut besides blanks: between an
    ASCII letter and ASCII punctuation other than ' and | (of contractions and special tokens)."""
    cut = np.zeros(len(data), bool)
    if len(data) > 1:
        a, b = data[:-1], data[1:]
        mark = PUNCT.copy()
        mark[[0x27, 0x7C]] = False
        cut[1:] = (LETTER[a] & mark[b]) | (mark[a] & LETTER[b])
    return cut


class FragmentEncoder:
    """Encodes texts given as one byte buffer; keeps a bounded memory of fragments seen.

    ``spec``: the tokenizer's JSON text. ``words``: the vocabulary marks word
    ends and drops blanks (else byte-level, blanks kept).
    """

    MEMORY = 300_000  # fragments; when full it starts anew

    def __init__(self, spec: str, words: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = words
        self.parsed = json.loads(spec)
        self.tokens = None if words else token_bytes(self.parsed)
        self.inside = None if words else pairs_inside(self.tokens)
        self.seen: dict[bytes, bytes] = {}
        self.chars = dict(enumerate(byte_chars()))
        # Latin letters: one pre-token for certain, which goes straight to the merges
        letters = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
        self.plain = re.compile(letters if words else " ?" + letters).fullmatch

    def encode_fragments(self, fragments: list[bytes]) -> list[bytes]:
        """Ids of each fragment as packed 32-bit numbers."""
        seen = self.seen
        if len(seen) > self.MEMORY:
            seen.clear()
        rest = []
        tokenize, plain, chars = self.tokenizer.model.tokenize, self.plain, self.chars
        for f in fragments:
            if f not in seen:
                text = f.decode()
                if plain(text):
                    if self.words:
                        text = text.lower()
                    mapped = text.encode().decode("latin-1").translate(chars)
                    seen[f] = array("I", [t.id for t in tokenize(mapped)]).tobytes()
                else:
                    rest.append(f)
        if rest:
            for f, e in zip(rest, self.tokenizer.encode_batch([f.decode() for f in rest], add_special_tokens=False)):
                seen[f] = array("I", e.ids).tobytes()
        return [seen[f] for f in fragments]

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        begins = np.zeros(n + 1, bool)
        begins[offs] = True
        if self.words:
            white = WHITE[data]
            begins[:n] |= word_cuts(data)
            begins[1:] |= white  # after a blank
            solid = ~white
            # without blanks: positions move up by the blanks before them
            moved = np.append(0, np.cumsum(solid))
            starts = np.flatnonzero(begins[:n] & solid)
            body, at = data[solid], np.append(moved[starts], moved[n])
        else:
            begins[:n] |= forced_cuts(data, self.inside)
            starts = np.flatnonzero(begins[:n])
            body, at = data, np.append(starts, n)
        fragments = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                          [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(body)])
        coded = fragments.dictionary_encode()
        index = coded.indices.to_numpy()
        packed = self.encode_fragments(coded.dictionary.to_pylist())
        size = np.array([len(p) >> 2 for p in packed], np.int64)
        ids = np.frombuffer(b"".join(packed), np.uint32)
        first = np.cumsum(size) - size
        lengths = size[index]
        out = ids[gather(first[index], lengths)]
        upto = np.append(0, np.cumsum(lengths))
        return out, upto[np.searchsorted(starts, offs)]
