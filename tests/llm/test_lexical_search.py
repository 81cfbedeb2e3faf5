"""Ranked search against scoring every document, and on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import lexical_search
from starloom.llm.lexical_search import Searcher

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n long, norm double, score string, terms string"


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(documents, items, top=10):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in documents]
    held = [(doc_id, tf, sum(tf.values())) for doc_id, tf in held if tf]
    count, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, tf, _ in held for t in tf)
    result = []
    for item_id, text in items:
        scores = []
        for doc_id, tf, n in held:
            m = 100 - 90 + (90 * n * count) // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in set(terms(text))
                if t in tf
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            result.append((item_id, rank, doc_id, -score))
    return sorted(result, key=str)


def rows(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(count, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(250)]
    weights = [1 / (i + 1) for i in range(250)]
    documents = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 120)))) for i in range(count)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 25)))) for i in range(30)]
    # Passages of items inside documents, and a third of the rows copies of one of them.
    documents = [(i, text + " " + items[i % 30][1] if i % 11 == 0 else text) for i, text in documents]
    documents = [(i, documents[0][1] if i % 3 == 0 else text) for i, text in documents]
    return documents, items


@pytest.mark.parametrize("bucket", [7, 2_048])
def test_same_as_scoring_every_document(spark, bucket, monkeypatch):
    monkeypatch.setattr(lexical_search, "BUCKET", bucket)
    documents, items = corpus(900, bucket)
    found = lexical_search.ranked(
        spark.createDataFrame(documents, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rows(found) == plain(documents, items)


def test_blocks_of_items_and_another_top(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 8)
    documents, items = corpus(200, 5)
    found = lexical_search.ranked(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        top=3,
    )
    assert rows(found) == plain(documents, items, top=3)


def test_thresholds_leave_most_vectors_unscored():
    """Buckets in falling length: the later ones are passed over or filtered, with the same result."""
    rng = np.random.default_rng(1)
    weights = np.sort(rng.integers(1, 9_000, 60))[::-1].astype(np.int64)
    items = [rng.choice(60, 8, replace=False) for _ in range(20)]
    vectors = [np.sort(rng.choice(60, rng.integers(1, 12), replace=False)) for _ in range(4_000)]
    parts = [rng.integers(1, 1_000_000, len(v)) for v in vectors]
    norms = np.array([math.sqrt((weights[v] * p.astype(float) ** 2).sum()) for v, p in zip(vectors, parts)])
    order = np.argsort(-norms)
    searcher = Searcher(items, weights, np.zeros(20, np.int64), 10)
    scored = []
    exact = Searcher._exact
    searcher._exact = lambda item, kept, *rest: (scored.append(len(kept)), exact(searcher, item, kept, *rest))[1]
    for at in range(0, 4_000, 100):
        rows_of = order[at : at + 100]
        bounds = np.concatenate(([0], np.cumsum([len(vectors[i]) for i in rows_of])))
        columns = [np.concatenate([vectors[i] for i in rows_of]), np.concatenate([parts[i] for i in rows_of])]
        searcher.bucket(norms[rows_of], columns[0], columns[1], bounds, pa.array(rows_of))
    assert sum(scored) < 0.2 * 20 * 4_000
    for item, best in zip(items, searcher.best):
        wanted = set(item.tolist())
        scores = [(-sum(int(weights[t]) * int(q) for t, q in zip(v, p) if t in wanted), i) for i, (v, p) in enumerate(zip(vectors, parts))]
        assert list(zip((-best.scores).tolist(), best.docs.tolist())) == sorted(scores)[:10]


def test_odd_rows(spark):
    long = " ".join(f"word{i % 700} tail{i}" for i in range(20_000))
    documents = [
        (0, None),
        (1, ""),
        (2, " .,; \n"),
        (3, "Ünï ÜNÏ cödé—日本語🙂 x_y z9"),
        (4, long),
        (5, "x" * 30_000),
        (6, "same words here"),
        (6, "same words here"),
        (None, "same words here"),
        (-7, "same words here"),
        (8, "Same WORDS, here!"),
    ]
    items = [(1, None), (2, ""), (3, "..."), (4, "SAME here same"), (4, "SAME here same"), (None, "cödé—日本語🙂 y"), (7, "tail19999 word3"), (8, "unknown"), (9, "ünï"), (10, "Ünï")]
    frame = spark.createDataFrame([(i, t, 1, 0.5, "own", None) for i, t in documents], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    found = lexical_search.ranked(frame, asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == plain(documents, items)


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    none = documents.limit(0)
    assert rows(lexical_search.ranked(none, items)) == []
    assert rows(lexical_search.ranked(documents, items.limit(0))) == []
    assert rows(lexical_search.ranked(documents, items)) == plain([(1, "a b")], [(1, "a")])
