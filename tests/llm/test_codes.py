"""Codes, automata and solvers on their own."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import public_tokenizers
from starloom.llm import cutting_stock, simple8b, transducers


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400), st.integers(1, 40))
def test_simple8b_round_trip(values, times):
    array = np.array(values * times, dtype=np.uint64)
    assert (simple8b.decode(simple8b.encode(array)) == array).all()


def test_simple8b_packs_words():
    size = len(simple8b.encode(np.zeros(4096, np.uint64)))
    assert size == 8 * (2 + 1 + 35)  # 120 zeros a word
    ids = np.random.default_rng(0).integers(0, 50_000, 40_960).astype(np.uint64)
    assert len(simple8b.encode(ids)) < 8 * 40_960 / 2.9


@pytest.mark.parametrize("seed", range(4))
def test_patterns_take_every_piece_and_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(4, 1, size=[3, 50, 2000, 40_000][seed]).astype(int), 1, 512)
    histogram = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)], strict=True))
    uses = cutting_stock.solve(histogram, 512)
    taken: dict[int, int] = {}
    for use in uses:
        assert sum(size * count for size, count in use.pattern) <= 512
        for size, count in use.pattern:
            taken[size] = taken.get(size, 0) + count * use.copies
    assert taken == histogram
    least = -(-int(lengths.sum()) // 512)
    assert sum(use.copies for use in uses) <= 1.02 * least + 1


def test_no_pieces_no_patterns():
    assert cutting_stock.solve({}, 512) == []


@pytest.fixture(scope="module")
def counter():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return transducers.TokenCounter(file.read())


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize(
    "letters",
    ["abcdefghij  '\n", "'relvstmd \n", "aA1 é日!?\t", " \n\t　 x"],
)
def test_counts_like_the_library(counter, library, letters):
    rng = random.Random(len(letters))
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 1200))) for _ in range(80)]
    expected = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts).tolist() == expected


def test_any_characters(counter, library):
    rng = random.Random(3)
    points = [*range(0xD800), *range(0xE000, 0x30000)]
    texts = ["".join(chr(rng.choice(points)) for _ in range(300)) for _ in range(60)]
    expected = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts).tolist() == expected


def test_memory_stays_bounded(counter, library, monkeypatch):
    monkeypatch.setattr(transducers, "MOST_TRANSITIONS", 200)
    monkeypatch.setattr(transducers, "MOST_PIECES", 50)
    texts = [f"wording number{i} {i * 7919} unlike{i * i}" for i in range(300)]
    expected = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [int(counter.count([t])[0]) for t in texts] == expected
