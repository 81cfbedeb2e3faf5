"""Toxicity by weak supervision.

Voters say toxic, clean or nothing about a document. Lexicon voters fire on mined words
and word beginnings, pattern voters on its form. A generative label model learns from the
votes alone how accurate each voter is and which voters repeat one another, and turns the
votes of a document into a posterior. A linear classifier over hashed words is trained on
those posteriors and scores every document; it generalises to words no voter knows.

Labels serve to mine and to orient the voters only. Everything is learned from a bounded
sample of labelled documents outside the held-out fold.

Defined results: a null or empty text gets the classifier's intercept; a null ``doc_id``
is neither held out nor learned from; without toxic or without clean examples every
document scores 0, with both there is always a classifier; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm import resident
from starloom.llm.language import held_out
from starloom.llm.texts import ASCII_LOWER, Hasher, Texts, byte_table, plainly_named, runs, slices, windows

# Letters, digits and every byte of a non-ASCII letter.
_WORD = byte_table(bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_STEMS = (4, 5, 6)

SAMPLE_TOXIC = 1_500
SAMPLE_CLEAN = 2_500
SAMPLE_CHARS = 4_000
FEATURES = 4_096
LEXICON_VOTERS = 48
# Documents with lexicon words that there have to be for each voter.
VOTER_DOCUMENTS = 5
# Documents of each class that the labels' orientation of the voters counts for.
ORIENTED = 10.0
FULL_PENALTY = 400
# Words enter a lexicon and the classifier down to the rank at which shuffled labels would
# mark this share of their number, or so many words.
CHANCE = 0.2
CHANCE_WORDS = 2
SHUFFLES = 10
# Share of a lexicon word's documents that have to be toxic.
SURE = 0.8
STEM_WORDS = 4


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and word of every word and of every beginning of a longer word (a stem)."""
    data = ASCII_LOWER[texts.data]
    starts, ends = runs(texts, _WORD[data])
    hasher = Hasher(data)
    found, sizes, rows = hasher.spans(starts, ends), ends - starts, texts.rows_of(starts)
    all_rows, hashes, words = [rows], [found], [found]
    for length in _STEMS:
        longer = sizes > length
        at = starts[longer]
        # Told apart from the word of the same letters.
        tag = np.uint64(length * 0x9E3779B97F4A7C15 % 2**64)
        hashes.append(hasher.spans(at, at + length) ^ tag)
        words.append(found[longer])
        all_rows.append(rows[longer])
    return np.concatenate(all_rows), np.concatenate(hashes), np.concatenate(words)


def _occurrences(texts: Texts, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, vocabulary index) pairs and how often each occurs; ``vocabulary`` is sorted."""
    rows, hashes, _ = features(texts)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    hit = vocabulary[at] == hashes
    pairs, counts = np.unique(rows[hit] * len(vocabulary) + at[hit], return_counts=True)
    return pairs // len(vocabulary), pairs % len(vocabulary), counts


def pattern_votes(texts: Texts) -> np.ndarray:
    """Votes on form alone: shouting, exclamation, and the evenness of plain prose."""
    data, rows = texts.data, len(texts)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return (total[texts.bounds[1:]] - total[texts.bounds[:-1]]).astype(float)

    size = np.maximum(1, texts.sizes)
    capitals = count((data >= 65) & (data <= 90)) / size
    shouts = count(data == 33) / size
    votes = np.zeros((rows, 3), dtype=np.int8)
    votes[capitals > 0.3, 0] = 1
    votes[shouts > 0.02, 1] = 1
    votes[(shouts == 0) & (capitals < 0.05), 2] = -1
    return votes


def label_model(
    votes: np.ndarray, prior: float, rounds: int = 30, oriented: np.ndarray | float = 0.0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fit voter accuracies and correlations; no label is looked at, except through
    ``oriented``, counts [class, voter, vote] of documents to begin each round with. They
    hold a model on few documents to its side and are outweighed in a large one.

    EM on a two-class model in which voter ``j`` says toxic, clean or nothing with
    probabilities of its own per class. After each round, the correlation of the voters'
    votes around what the posterior explains says how often a vote is merely repeated:
    a voter's evidence is divided by one plus its correlations with the others.

    Returns the posteriors, the log-evidence table [class, voter, vote] and the weights.
    """
    documents, voters = votes.shape
    says = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    signal = votes.clip(0).sum(1) - 0.5 * (votes < 0).sum(1)
    posterior = np.where(signal > 0, 0.9, prior / 2)
    weight = np.ones(voters)
    table = np.zeros((2, voters, 3))
    oriented = np.broadcast_to(oriented, table.shape)
    for _ in range(rounds):
        for k, share in enumerate((1 - posterior, posterior)):
            counts = np.einsum("d,dvs->vs", share, says) + oriented[k] + 0.5
            table[k] = np.log(counts / counts.sum(1, keepdims=True))
        centred = votes - np.stack(
            [np.exp(table[1]) @ [-1, 0, 1], np.exp(table[0]) @ [-1, 0, 1]]
        ).T.dot(np.stack([posterior, 1 - posterior])).T
        spread = centred.std(0) + 1e-9
        correlation = (centred.T @ centred) / documents / np.outer(spread, spread)
        np.fill_diagonal(correlation, 0.0)
        correlation[correlation < 0.1] = 0.0
        weight = 1.0 / (1.0 + correlation.sum(1))
        evidence = np.einsum("dvs,vs,v->d", says, table[1] - table[0], weight)
        updated = 1.0 / (1.0 + np.exp(-np.clip(evidence + np.log(prior / (1 - prior)), -30, 30)))
        if np.abs(updated - posterior).max() < 1e-4:
            posterior = updated
            break
        posterior = updated
    return posterior, table, weight


@dataclass(frozen=True)
class Classifier:
    """A linear model over sorted feature hashes: one weight for a feature that occurs, and
    one more if it occurs again."""

    vocabulary: np.ndarray
    once: np.ndarray
    again: np.ndarray
    intercept: float

    def scores(self, texts: Texts) -> np.ndarray:
        total = np.full(len(texts), self.intercept)
        if len(self.vocabulary) and len(texts):
            rows, at, counts = _occurrences(texts, self.vocabulary)
            weights = self.once[at] + np.where(counts > 1, self.again[at], 0.0)
            total += np.bincount(rows, weights=weights, minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


NEVER = Classifier(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), -np.inf)


def _all_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a sample: distinct (row, hash) pairs with whether the hash occurs again in the row,
    and the distinct pairs of stem and word."""
    rows, hashes, again, stems, done = [], [], [], [], 0
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    for piece in slices(iter([batch]), "text"):
        r, h, w = features(Texts(piece.column("text")))
        stems.append(np.unique(np.stack((h, w))[:, h != w], axis=1))
        order = np.lexsort((h, r))
        r, h = r[order], h[order]
        same = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
        first = np.flatnonzero(np.concatenate(([True], ~same))) if len(r) else np.zeros(0, np.int64)
        rows.append((r[first] + done).astype(np.int32))
        hashes.append(h[first])
        again.append(np.concatenate((same, [False]))[first] if len(r) else np.zeros(0, bool))
        done += piece.num_rows
    pairs = np.unique(np.concatenate(stems, axis=1), axis=1)
    return np.concatenate(rows), np.concatenate(hashes), np.concatenate(again), pairs


class _Stems:
    """The stems of a vocabulary and their words, as indices into it."""

    def __init__(self, pairs: np.ndarray, vocabulary: np.ndarray):
        stem, self._at = np.unique(pairs[0], return_inverse=True)
        self._stem = np.searchsorted(vocabulary, stem)
        self._word = np.searchsorted(vocabulary, pairs[1])
        self._words = np.bincount(self._at, minlength=len(stem))

    def usable(self, one_sided: np.ndarray) -> np.ndarray:
        """Which entries of the vocabulary are words, or stems of several words most of which
        are one-sided themselves. The beginning of a single marked word says no more than the
        word, but would incriminate harmless words that start alike."""
        marked = np.bincount(self._at, weights=one_sided[self._word], minlength=len(self._words))
        good = (marked >= STEM_WORDS) & (marked >= 0.7 * self._words)
        usable = np.ones(len(one_sided), dtype=bool)
        usable[self._stem[~good]] = False
        return usable


def _matrix(rows: np.ndarray, index: np.ndarray, chosen: np.ndarray, documents: int, size: int) -> np.ndarray:
    """Documents by chosen entries of the vocabulary."""
    column = np.full(size, -1)
    column[chosen] = np.arange(len(chosen))
    hit = column[index] >= 0
    matrix = np.zeros((documents, len(chosen)), dtype=np.float32)
    matrix[rows[hit], column[index[hit]]] = 1.0
    return matrix


def _logistic(matrix: np.ndarray, target: np.ndarray, penalty: float = 0.3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by accelerated gradient descent. Below
    ``FULL_PENALTY`` documents the penalty shrinks with their number, since it would outweigh
    words that only a few documents can have."""
    penalty *= min(1.0, len(target) / FULL_PENALTY)
    weights = np.zeros(matrix.shape[1], dtype=np.float32)
    intercept = float(np.log((target.mean() + 1e-6) / (1 - target.mean() + 1e-6)))
    # The step follows from the steepest direction, as power iteration finds it; columns that
    # occur together, as in small samples, would overshoot with any longer one.
    way, offset, steepest = np.ones_like(weights), 1.0, 0.0
    for _ in range(20):
        size = np.sqrt(np.square(way, dtype=np.float64).sum() + offset**2)
        way, offset = (way / size).astype(np.float32), offset / size
        seen = matrix @ way + np.float32(offset)
        steepest = float(np.square(seen, dtype=np.float64).sum())
        way, offset = matrix.T @ seen, float(seen.sum())
    rate = 1.0 / (0.25 * 1.1 * steepest + penalty)
    last, last_intercept = weights, intercept
    for step in range(steps):
        swing = step / (step + 3)
        ahead, base = weights + swing * (weights - last), intercept + swing * (intercept - last_intercept)
        error = 1.0 / (1.0 + np.exp(-np.clip(matrix @ ahead + base, -30, 30))) - target
        last, last_intercept = weights, intercept
        weights = (ahead - rate * (matrix.T @ error.astype(np.float32) + penalty * ahead)).astype(np.float32)
        intercept = base - rate * error.sum()
    return weights.astype(np.float64), float(intercept)


def _first_of_copies(column: pa.Array) -> np.ndarray:
    """Whether no earlier text has the same smallest 5-word window, as copies mostly do.

    A text copied many times would make each of its words look like a mark of its class.
    """
    smallest = []
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    for piece in slices(iter([batch]), "text"):
        texts = Texts(piece.column("text"))
        data = ASCII_LOWER[texts.data]
        starts, ends = runs(texts, _WORD[data])
        found = windows(Hasher(data).spans(starts, ends), 5)
        rows = texts.rows_of(starts)
        whole = rows[: len(found)] == rows[4:] if len(found) else np.zeros(0, bool)
        least = np.full(len(texts), np.iinfo(np.uint64).max, dtype=np.uint64)
        np.minimum.at(least, rows[: len(found)][whole], found[whole])
        smallest.append(least)
    least = np.concatenate(smallest)
    first = np.zeros(len(least), dtype=bool)
    first[np.unique(least, return_index=True)[1]] = True
    return first | (least == np.iinfo(np.uint64).max)


def _surprise(inside: np.ndarray, total: np.ndarray, share: float) -> np.ndarray:
    """Log-likelihood ratio of features that occur ``inside`` the class so often, against
    occurring in it by its ``share`` of all documents."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))

    return 2 * (part(inside, total * share) + part(total - inside, total * (1 - share)))


def _best(value: np.ndarray, shuffled: Iterator[np.ndarray], most: int) -> np.ndarray:
    """The entries of highest positive value, best first: down to the lowest value at which
    shuffled labels give at most ``CHANCE`` as many entries and ``CHANCE_WORDS`` at most. Where
    no value is beyond chance the best one counts, so something is always found if anything
    is positive.

    The limit follows from the sample itself: a small one needs less evidence for a word,
    since it has fewer words to be deceived by.
    """
    order = np.argsort(-value, kind="stable")[: int((value > 0).sum())]
    if not len(order):
        return order
    found = np.searchsorted(-value[order], -value[order[:most]], side="right")
    levels = value[order[:most]]
    chance = np.sort(np.concatenate([by[by >= levels[-1]] for by in shuffled]))
    by_chance = (len(chance) - np.searchsorted(chance, levels, side="left")) / SHUFFLES
    beyond = np.flatnonzero(by_chance <= np.minimum(CHANCE * found, CHANCE_WORDS))
    return order[: found[beyond[-1] if len(beyond) else 0]][:most]


def train(column: pa.Array, toxic: np.ndarray) -> Classifier:
    """Voters, label model and classifier from a labelled sample."""
    toxic = np.asarray(toxic, dtype=bool)
    if len(toxic):
        # Class by class, so that no class is lost to copies in the other.
        first = np.zeros(len(toxic), dtype=bool)
        for k in (np.flatnonzero(toxic), np.flatnonzero(~toxic)):
            first[k] = _first_of_copies(column.take(pa.array(k))) if len(k) else True
        column, toxic = column.filter(pa.array(first)), toxic[first]
    documents, bad = len(toxic), int(toxic.sum())
    if bad == 0 or bad == documents:
        return NEVER
    share = bad / documents
    rows, hashes, again, pairs = _all_features(column)
    vocabulary, index = np.unique(hashes, return_inverse=True)
    index = index.astype(np.int32)
    del hashes
    size = len(vocabulary)
    # Entry k: the feature occurs; entry size + k: it occurs again.
    row = np.concatenate((rows, rows[again]))
    entry = np.concatenate((index, index[again] + size))
    total = np.bincount(entry, minlength=2 * size)
    stems = _Stems(pairs, vocabulary)
    draw = np.random.default_rng(0)

    def one_sidedness(toxic: np.ndarray, sure: float) -> tuple[np.ndarray, np.ndarray]:
        inside = np.bincount(entry[toxic[row]], minlength=2 * size)
        marked = (inside >= sure * total) & (inside > share * total)
        usable = np.tile(stems.usable(marked[:size]), 2)
        return np.where(usable & marked, _surprise(inside, total, share), 0.0), usable

    # Lexicons: marked words, the surest first, dealt out so that each voter gets words of
    # like strength; voters of one word each would be too sparse to be estimated.
    for sure in (SURE, 0.0):  # words that lean to one side count where none is sure
        surprise, usable = one_sidedness(toxic, sure)
        if surprise.any():
            break
    shuffled = (one_sidedness(draw.permutation(toxic), sure)[0] for _ in range(SHUFFLES))
    strong = _best(surprise, shuffled, LEXICON_VOTERS * 8)
    marks = _matrix(row, entry, strong, documents, 2 * size)
    voters = max(1, min(LEXICON_VOTERS, len(strong), int(marks.any(axis=1).sum()) // VOTER_DOCUMENTS))
    fired = np.stack([marks[:, k::voters].any(axis=1) for k in range(voters)], axis=1)
    votes = np.concatenate(
        (
            fired.astype(np.int8),
            np.where(fired.any(axis=1), 0, -1).astype(np.int8)[:, None],
            pattern_votes(Texts(column)),
        ),
        axis=1,
    )
    oriented = np.stack(
        [[(votes[of] == v).mean(axis=0) for v in (-1, 0, 1)] for of in (~toxic, toxic)]
    ).transpose(0, 2, 1)
    posterior, _, _ = label_model(votes, share, oriented=ORIENTED * oriented)

    # The classifier sees the features whose part in the posteriors is no chance.
    def telling(posterior: np.ndarray) -> np.ndarray:
        soft = np.bincount(entry, weights=posterior[row], minlength=2 * size)
        return np.where(usable, _surprise(soft, total, posterior.mean()), 0.0)

    shuffled = (telling(draw.permutation(posterior)) for _ in range(SHUFFLES))
    chosen = _best(telling(posterior), shuffled, FEATURES)
    chosen = np.concatenate((strong, chosen[~np.isin(chosen, strong)]))[:FEATURES]
    weights, intercept = _logistic(_matrix(row, entry, chosen, documents, 2 * size), posterior)
    kept = np.unique(chosen % size)
    both = np.zeros(2 * size)
    both[chosen] = weights
    return Classifier(vocabulary[kept], both[kept], both[kept + size], intercept)


def training_sample(documents: DataFrame, labels: DataFrame) -> pa.Table:
    """At most ``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` clean labelled documents outside
    the held-out fold, spread by hash; of each, at most ``SAMPLE_CHARS`` characters.

    One document per hash slot is kept by an aggregate, so no task or driver ever holds
    more than the bound.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
        .where(~held_out(F.col("doc_id"), 5, 0))
        .withColumn(
            "_slot",
            F.pmod(F.xxhash64("doc_id"), F.when(F.col("_toxic") == 1, SAMPLE_TOXIC).otherwise(SAMPLE_CLEAN)),
        )
        # Labels are chosen before any text moves.
        .groupBy("_toxic", "_slot")
        .agg(F.min("doc_id").alias("doc_id"))
    )
    texts = documents.select("doc_id", F.coalesce(F.substring("text", 1, SAMPLE_CHARS), F.lit("")).alias("text"))
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN ids: a proven bound for the broadcast.
    sample = texts.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "_toxic").agg(F.min("text").alias("text"))
    return sample.orderBy("doc_id").toArrow()


def fit(documents: DataFrame, labels: DataFrame) -> Classifier:
    sample = training_sample(documents, labels)
    toxic = sample.column("_toxic").to_numpy() == 1
    classifier = train(sample.column("text").combine_chunks(), toxic)
    del sample
    resident.trim()
    return classifier


def score(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """Add ``score`` to every document; other columns pass through."""
    # FEATURES hashes and weights: a fixed bound.
    shared = documents.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident.release()
        for batch in slices(batches, "text"):
            scores = shared.value.scores(Texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"]
            )

    kept = documents.drop("score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, score double")


def toxicity_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    scored = score(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents scored below 0.5; the rest go.

    Texts that are null or empty are scored too. Repeated rows stay or go alike, each with all
    its columns, whatever they are called; an empty table stays empty.
    """
    documents, columns = plainly_named(documents, ("doc_id", "text"))
    scored = score(documents, fit(documents, labels))
    return scored.where(F.col("score") < 0.5).select(*columns)
