"""Operator 1 against the tokenizers library."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mediamart.llm import bpe
from mediamart.llm.registry import WORD_BPE

LIBRARY, OWN = Tokenizer.from_file(WORD_BPE), bpe.Bpe(open(WORD_BPE, encoding="utf-8").read())


def check(batch):
    ids, size = OWN.encode(batch)
    ends = np.cumsum(size)
    for text, a, b in zip(batch, ends - size, ends):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want, text
        assert OWN.decode(ids[a:b]).decode() == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60), max_size=5))
def test_any_text(batch):
    check(batch)


def test_chosen_texts():
    rng = random.Random(3)
    check(["", " ", "it's 'S we'll I'M", "a" * 70, "ab" * 40, "<|endoftext|>A<|startoftext|>", "<|ENDOFTEXT|> <|endoftext|",
           "Σίσυφος ΣΑΣ İ ß ﬁ", "\x1c\x1d a\x85b　c", "１２３ 45", "ǅ́ é", "�‍🛜"])
    check(["".join(chr(rng.choice([rng.randrange(33, 127), 32, rng.randrange(0xA0, 0x600), rng.randrange(0x1100, 0x1200)]))
                   for _ in range(rng.randrange(150))) for _ in range(200)])


def test_long_words_and_both_trees_agree():
    rng = random.Random(4)
    words = [bytes(rng.choice(b"aeinrstth") for _ in range(n)) for n in (1, 2, 3, 8, 9, 33, 63, 64, 65)]
    for w in words:
        if len(w) <= bpe.ROW_LIMIT:
            leaves = 1 << max(1, (len(w) - 2).bit_length()) if len(w) > 2 else 2
            ids, _ = OWN._merge_rows([w], leaves)
            assert ids.tolist() == OWN._merge_long(w)
    check(["the" * 3000, "x" * 20_000])


def test_cache_limit_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_LIMIT", 3)
    fresh = bpe.Bpe(open(WORD_BPE, encoding="utf-8").read())
    for text in ("one two three four", "four three", "five six one"):
        assert fresh.encode([text])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_operator_on_odd_rows(odd, none, odd_rows):
    got = sorted(bpe.round_trip(odd, WORD_BPE).collect(), key=str)
    want = sorted(((i, LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in odd_rows), key=str)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=str) == want
    assert bpe.round_trip(none, WORD_BPE).collect() == [] and bpe.encode(none, WORD_BPE).columns == ["doc_id", "ids"]
