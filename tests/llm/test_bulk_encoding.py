"""New pieces go to the tokenizer in bulk, and pairs of term and document are counted by one sort."""

from __future__ import annotations

import collections

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from roadlens.llm import token_ids
from roadlens.llm.bm25_packing import term_counts
from roadlens.llm.common import utf8_buffers
from roadlens.llm.queries import BYTE_BPE, WORD_BPE

ODD = [
    "Ċ Ġx aĊb", "a×b c÷d ×", "İstanbul Iı ŉa ǅ ȿ ɏ ɐ", "ÉTÉ été Été", "O'NEIL'S 'S don'T ''s", "</w> a</w> </ w>", "Σίσυφος ΣΑΣ", "é É",
    "x\n\n!a! -b-c- (d)", "end'", "s end", "-", "é", "—a— 1a2 a1", "", " ", "trailing \t ", "日本語 abc", "K K ªº",
]


class Counting:
    """The tokenizer's model, with the calls for it."""

    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def __getattr__(self, name):
        found = getattr(self.inner, name)

        def told(*args, **options):
            self.calls += 1
            return found(*args, **options)

        return told


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
@pytest.mark.parametrize("many", [1, 3, token_ids.MANY])
def test_bulk_ids_are_those_of_whole_texts(name, many, monkeypatch):
    monkeypatch.setattr(token_ids, "MANY", many)
    encode = token_ids.Encoder(public_tokenizers.path(name))
    for texts in (ODD, [*ODD[::-1], "new words here", *ODD], *[[t] for t in ODD], ["".join(ODD)], [a + b for a in ODD for b in ODD]):
        ids, upto = encode(*utf8_buffers(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == encode.encode_whole(texts)


def test_new_words_take_few_calls_of_the_library():
    encode = token_ids.Encoder(public_tokenizers.path(WORD_BPE))
    tokenizer = encode.tokenizer
    texts = [" ".join(f"{a}{b}{c}" for c in "abcdefghij") for a in "pqrst" for b in "klmnopqrstuvwxyz"]
    want = encode.encode_whole(texts)
    encode.tokenizer = Counting(tokenizer)
    encode.tokenizer.model = model = Counting(tokenizer.model)
    ids, upto = encode(*utf8_buffers(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == want
    assert model.calls + encode.tokenizer.calls <= 2  # 800 before: one a word


def test_forms_of_a_word_are_one_piece():
    encode = token_ids.Encoder(public_tokenizers.path(WORD_BPE))
    for _ in range(3):
        encode(*utf8_buffers(pa.array(["Word word WORD", "word\nwOrd"])))
    assert list(encode.known) == [b"word"]


@pytest.mark.parametrize("kind, top", [(np.uint16, 1 << 16), (np.uint32, 1 << 20)])
@pytest.mark.parametrize("docs", [1, 2, 300, 70_000])
def test_term_counts(kind, top, docs):
    rng = np.random.default_rng(docs)
    owner = np.sort(rng.integers(0, docs, 5_000)).astype(np.int32)
    ids = np.where(rng.random(5_000) < 0.5, rng.integers(0, top, 5_000), rng.integers(top - 5, top, 5_000)).astype(kind)
    want = sorted((t, o, n) for (t, o), n in collections.Counter(zip(ids.tolist(), owner.tolist())).items())
    term, held, count = term_counts(ids, owner)
    assert list(zip(term.tolist(), held.tolist(), count.tolist())) == want
    assert term.dtype == kind and held.dtype == np.int32
    assert [len(x) for x in term_counts(ids[:0], owner[:0])] == [0, 0, 0]
