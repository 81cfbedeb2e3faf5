"""Embedding links and chat examples against brute force, and on odd rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import chat, components, embeddings

VECTORS = "vec_id long, embedding array<float>, label int, reach double, cell string"


def _expected(rows, threshold):
    """(vec_id, n_links, component_id, kept) of rows (vec_id, vector, label)."""

    def usable(row):
        v = row[1]
        return row[0] is not None and row[2] is not None and v is not None and all(
            x is not None and np.isfinite(x) for x in v
        ) and any(v)

    links = {k: set() for k in range(len(rows))}
    for a, one in enumerate(rows):
        for b, two in enumerate(rows[:a]):
            if usable(one) and usable(two) and one[2] == two[2] and len(one[1]) == len(two[1]):
                x, y = (np.array(r[1], np.float32).astype(float) for r in (one, two))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    result = []
    for k, row in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        ids = [rows[x][0] for x in seen if rows[x][0] is not None]
        root = min(ids) if ids else None
        result.append((row[0], len(links[k]), root, row[0] == root))
    return sorted(result, key=str)


def _found(frame, **options):
    return sorted((tuple(r) for r in embeddings.near_duplicates(frame, **options).collect()), key=str)


@pytest.mark.parametrize("block", [16, 2048])
def test_links_and_components(spark, monkeypatch, block):
    """Small blocks make pivots, cells and visitors."""
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(7)
    rows = []
    for label in (0, 1):
        centres = rng.normal(size=(30, 12))
        for k in range(160):
            spread = rng.choice([0.0, 0.05, 0.1, 0.4])
            rows.append((len(rows), (centres[k % 30] + spread * rng.normal(size=12)).tolist(), label))
    frame = spark.createDataFrame([(*r, 0.1, "c") for r in rows], VECTORS).repartition(5)
    assert _found(frame) == _expected(rows, embeddings.THRESHOLD)
    if block == 16:
        assert embeddings._pivots(frame.withColumn("dim", F.size("embedding")))


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [None, 1.0], 1), (9, [float("inf"), 0.0], 1), (10, [], 1),
        (11, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0], 1), (12, [-1.0, 0.0], 1), (None, [1.0, 0.0], 1),
    ]
    frame = spark.createDataFrame([(*r, None, None) for r in rows], VECTORS)
    found = [r for r in _found(frame) if r[0] is not None]
    expected = [r for r in _expected(rows, embeddings.THRESHOLD) if r[0] is not None]
    assert found == expected
    assert embeddings.near_duplicates(frame.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100)]
    star = [(1000, 1000 + i) for i in range(1, 60)] + [(1005, 1004)]
    links = spark.createDataFrame([*chain, *star, (5000, 5000)], "a long, b long")
    found = {tuple(r) for r in components.connected(links).collect()}
    assert found == {(i, 0) for i in range(1, 101)} | {(1000 + i, 1000) for i in range(1, 60)}
    assert components.connected(links.where("false")).count() == 0


CONVERSATIONS = "conv_id long, turn long, role string, text string, example int, formatted string"


def _digests(turns):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    whole = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
    loss = "".join(text or "" for role, text in turns if role == "assistant")
    return len(turns), digest(whole), len(loss), digest(loss)


def test_conversations_come_back(spark):
    odd = [r"\b\l\n", "<turn>user\n</turn>\n", "", None, "a\nb", "🙂 <|x|> \\", chat.TRICKY_TEXT]
    conversations = {
        1: [("user", t) if k % 2 else ("assistant", t) for k, t in enumerate(odd)],
        2: [("user", "only a question")],
        3: [("system", None), ("user", "q"), ("assistant", "a"), ("assistant", "b"), ("user", "thanks")],
        None: [("assistant", "nobody")],
        4: [(None, "x"), ("ro\nle<", "y"), ("assistant", "z" * 50_000)],
    }
    rows = [(c, k, role, text, 7, "f") for c, turns in conversations.items() for k, (role, text) in enumerate(turns)]
    frame = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    made = chat.examples(frame)
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(made).collect()}
    assert found == {c: _digests(turns) for c, turns in conversations.items()}
    assert {r["conv_id"]: r["n"] for r in made.groupBy("conv_id").agg(F.count("*").alias("n")).collect()} == {
        1: 4, 2: 1, 3: 3, None: 1, 4: 1,
    }
    assert chat.examples(frame.where("false")).count() == 0


def test_an_example_trains_only_its_reply(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1<"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2")]
    made = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    examples = sorted(made.collect(), key=lambda r: r["example"])
    assert [r["formatted"][r["loss_start"] : r["loss_end"]] for r in examples] == ["a1\\l", "a2"]
    assert examples[1]["formatted"].startswith(examples[0]["formatted"])
    assert examples[0]["formatted"] == "<turn>user\nq1</turn>\n<turn>assistant\na1\\l</turn>\n"


def test_equal_turn_numbers_are_ordered_by_role_and_text(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "c"), (1, None, "user", "first")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = chat.digests(chat.examples(frame)).collect()
    assert tuple(row)[1:5] == _digests([("user", "first"), ("assistant", "c"), ("user", "a"), ("user", "b")])


def test_built_in_functions_only(spark):
    plan = chat.digests(chat.examples(chat.with_tricky(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))
