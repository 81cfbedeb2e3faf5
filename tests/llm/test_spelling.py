"""Spelling variants against plain loops over all words, and on odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starloom.llm import spelling
from starloom.llm.bit_slices import BitSlices, letter_matrix

SCHEMA = "doc_id long, text string, n long, word string, block string"
COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(documents):
    """The contract word by word."""
    counts = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    rows = {}
    for word, n in words.items():
        near = [w for w in words if abs(len(w) - len(word)) <= 1 and one_apart(word, w)]
        best = min(near, key=lambda w: (-words[w], w), default=None)
        form = best if best and words[best] >= 2 * n else None
        rows[word] = (n, len(near), form, words.get(form))
    result = []
    for word, row in rows.items():
        root = word
        while rows[root][2] is not None:
            root = rows[root][2]
        result.append((word, *row, root))
    return sorted(result)


def rows(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def corpus(count, seed, longest=10):
    rng = random.Random(seed)
    letters = "abÀÿéz×"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, longest))) for _ in range(120)]
    documents = []
    for i in range(count):
        text = []
        for _ in range(60):
            word = rng.choice(base[: rng.randrange(1, 121)])
            if rng.random() < 0.3:
                at = rng.randrange(len(word) + 1)
                word = word[:at] + rng.choice(["", *letters]) + word[at + rng.randrange(2) :]
            text.append(word.upper() if rng.random() < 0.1 and word.isascii() else word)
        documents.append((i, rng.choice([" ", "-", "_ ", "ŝ ", "1"]).join(text)))
    return documents


def test_crc_of_spans():
    data = np.frombuffer("abc déf ".encode() * 40 + b"x" * 300, np.uint8)
    starts = np.array([0, 4, 3, 0, 0, 320])
    ends = np.array([3, 8, 3, 300, 64, 620])
    before = np.array([0, zlib.crc32(b"7:"), 5, 9, 11, 13], dtype=np.uint32)
    found = spelling.crc32_of_spans(data, starts, ends, before)
    assert found.tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]


@pytest.mark.parametrize("short", [5, 6, 9])
def test_bit_slices_find_what_a_comparison_of_all_words_finds(short):
    rng = random.Random(short)
    words = sorted({"".join(rng.choice("ab\xe9") for _ in range(short + rng.randrange(2))).encode("latin-1") for _ in range(400)})
    index = BitSlices(words, short)
    head = (short + 1) // 2
    for size in (short, short + 1):
        queries = [w for w in words if len(w) == size]
        for same in (True, False):
            who, whom = index.near(letter_matrix(queries, size), size, head, same)
            found = sorted((queries[a], words[b]) for a, b in zip(who, whom))
            assert found == sorted(
                (q, w)
                for q in queries
                for w in words
                if one_apart(q, w) and min(len(q), len(w)) == short and (q[:head] == w[:head]) == same
            )


def test_same_as_plain_loops(spark):
    documents = corpus(400, 3)
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    expected = plain(documents)
    assert len(expected) > 150 and any(r[5] != r[3] for r in expected if r[3])
    assert rows(spelling.variants(frame)) == expected


def test_small_and_overfull_blocks(spark, monkeypatch):
    """Blocks of a few words each, most of them cut into pieces."""
    monkeypatch.setattr(spelling, "BLOCK", 4)
    documents = corpus(200, 4, longest=8)
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    entries = spelling._entries(spelling._written(spelling.vocabulary(frame), "test"))
    assert spelling._in_pieces(entries).where("index_piece > 0").count() > 0
    assert rows(spelling.variants(frame)) == plain(documents)


def test_long_words_and_odd_rows(spark):
    long = "ab" * 400
    word = "übergrößen"  # ß is in the range, as all of U+00C0 to U+00FF
    odd = [
        (0, None),
        (1, ""),
        (2, " \n "),
        (None, f"{word} {word} ŝtono ŝtono ŝtono"),
        (-3, f"{long} {long}x {long}x {long}x"),
        (4, f"{long} {long} y{long} y{long} y{long}"),
        (5, "abcde abcde abcde abcdE ÀBCDE ÀBCDE ÀBCDE àbcde àbcde àbcde"),
        (6, "x" * 40_000 + " " + f"{word} {word[:-1]} {word[:-1]} {word[:-1]}"),
        (6, "same same fivefold fivefold fivefold"),
        (6, "same same fivefold fivefold fivefold"),
        (7, "a\U0001f642bcdef abcdefg日abcdefg 1abcdefg2abcdefg"),
    ]
    frame = spark.createDataFrame([(i, t, 1, "own", "own") for i, t in odd], SCHEMA).repartition(2)
    found = rows(spelling.variants(frame))
    assert found == plain(odd)
    assert {"abcde", "Àbcde"} <= {r[0] for r in found}


def test_no_documents(spark):
    assert rows(spelling.variants(spark.createDataFrame([], SCHEMA))) == []
    assert rows(spelling.variants(spark.createDataFrame([(1, None, 1, None, None)], SCHEMA))) == []


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(20)] + [("side", "w07")]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {word: "w20" for word, _ in chain}
