import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from topicloom.llm import bpe_automaton as bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return bpe.WordBPE(PATH), Tokenizer.from_file(PATH)


def test_equals_the_library(both):
    own, library = both
    rnd = random.Random(4)
    signs = "aaabcdeéÉ ΣσςİIıß \t\n\x0b\x1c\x85\xa0　'stredm12½!?.,<|>😀日本語éÅ﻿​\x00"
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 50))) for _ in range(4000)]
    texts += ["".join(rnd.choice("thesandring") for _ in range(rnd.randint(1, 25))) for _ in range(4000)]
    texts += ["hi<|endoftext|>World<|startoftext|>", "a" * 5000, "ab" * 3000, "!" * 2000, "I'LL we've", ""]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        mine = own.encode(text)
        assert np.frombuffer(mine, "<u4").tolist() == ids, text
        assert own.decode(mine) == library.decode(ids, skip_special_tokens=False)


def test_gadgets_by_hand():
    # Merges ab, then (ab)a, then bb: "abab" keeps two ab, since the merge of ab and a comes first.
    vocab = {t: i for i, t in enumerate(["a", "b", "a</w>", "b</w>", "ab", "aba", "ab</w>", "bb", "aa"])}
    machine = bpe.Automaton(vocab, [["a", "b"], ["a", "b</w>"], ["ab", "a"], ["b", "b"], ["a", "a"]])
    names = lambda word: [machine.labels[i] for i in machine.encode_word(word)]
    assert names(b"abab") == ["ab", "ab</w>"]
    assert names(b"ababb") == ["ab", "ab", "b</w>"]
    assert names(b"abaa") == ["aba", "a</w>"]
    assert names(b"aaaaa") == ["aa", "aa", "a</w>"]


def test_edges(edge_docs, no_docs, both):
    rows = bpe.encode_decode(edge_docs, PATH, carry=("source",)).collect()
    assert len(rows) == edge_docs.count()
    empty = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert all(r["n_tokens"] == 0 and r["ids"] == b"" and r["decoded"] == "" for r in empty)
    assert {r["source"] for r in rows if r["doc_id"] == 5} == {"b"}
    long = next(r for r in rows if r["doc_id"] == 4)
    text = next(r["text"] for r in edge_docs.collect() if r["doc_id"] == 4)
    want = both[1].encode(text, add_special_tokens=False).ids
    assert hashlib.sha256(long["ids"]).digest() == hashlib.sha256(np.array(want, "<u4").tobytes()).digest()
    assert bpe.encode_decode(no_docs, PATH).count() == 0
