"""Language identification by cross-parsing entropy.

One suffix automaton per language, built from a bounded sample of labelled text, accepts
every substring of that sample. A document is parsed greedily into longest matches
against each automaton; the language that needs the fewest phrases, each weighed by the
bits of a pointer into its sample, wins. Documents are parsed in segments of equal
length, all segments of a slice side by side, so one step of the automaton is one array
operation.

Defined results: null text and text without a letter give ``und`` with score 0; a null
``doc_id`` is neither held out nor learned from; without any labelled text every document
gives ``und``; ties go to the smaller language name; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm import resident
from starloom.llm.texts import Texts, plainly_named, slices

UNDETERMINED = "und"
SEGMENT = 512

# Bytes as the parsers see them: letters in lower case, all other ASCII as blanks. The
# capitals of two-byte Latin letters lie 32 below their small forms.
_FOLD = np.where(np.arange(256) < 128, 32, np.arange(256)).astype(np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[0x80:0x9F] += 32

_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the id's CRC-32 falls into the held-out fold; false for a null id."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)
    return F.coalesce(remainder == F.lit(fold), F.lit(False))


def training_texts(
    documents: DataFrame, per_language: int = 48_000, documents_each: int = 200, total: int = 1_000_000
) -> dict[str, bytes]:
    """A bounded sample of labelled text per language.

    At most ``documents_each`` documents a language, those with the smallest hash of id
    and text, of which the first 2,000 characters are read and at most ``per_language``
    bytes kept; with many languages fewer, so that all together stay below ``total``.
    """
    learned = documents.where(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id"), 4, 2)
    )
    # One document per language and slot, so a hot language is pre-aggregated in each task.
    spread = learned.select(
        "lang",
        F.substring("text", 1, 2000).alias("text"),
        F.xxhash64("doc_id", "text").alias("_rank"),
    )
    slots = spread.withColumn("_slot", F.pmod("_rank", F.lit(documents_each)))
    chosen = slots.groupBy("lang", "_slot").agg(F.min(F.struct("_rank", "text"))["text"].alias("text"))
    sample: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "_slot").collect():
        sample.setdefault(row["lang"], []).append(row["text"])
    share = min(per_language, total // max(1, len(sample)))
    cut = {lang: "\n".join(parts).encode()[:share] for lang, parts in sample.items()}
    return without_foreign_lines(cut)


def _automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring of the input."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = moves[at][symbol]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                twin = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = twin
                    at = link[at]
                link[target] = link[new] = twin
        last = new
    return moves


@dataclass
class Parser:
    """A suffix automaton as one table over byte classes.

    An entry holds the row of the next state and, in its two low bits, how many phrases
    the step ends. The last two columns are bytes the sample lacks and padding.
    """

    table: np.ndarray
    classes: np.ndarray
    pad: int
    bits: float

    @classmethod
    def compile(cls, sample: bytes) -> Parser:
        data = _FOLD[np.frombuffer(sample, dtype=np.uint8)]
        present = np.unique(data)
        unknown, pad, width = len(present), len(present) + 1, len(present) + 2
        folded = np.full(256, unknown, dtype=np.uint8)
        folded[present] = np.arange(len(present), dtype=np.uint8)
        classes = folded[_FOLD]
        moves = _automaton(classes[data].tolist())
        begin = np.zeros(width, dtype=np.int32)
        for symbol, target in moves[0].items():
            begin[symbol] = target * width
        # No move: the phrase ends and its successor starts with this symbol.
        table = np.empty((len(moves), width), dtype=np.int32)
        table[:] = (begin << 2) | 1
        table[:, unknown] = 2
        table[:, pad] = 1
        for state, out in enumerate(moves):
            if out:
                keys = np.fromiter(out.keys(), dtype=np.int64, count=len(out))
                ends = np.fromiter(out.values(), dtype=np.int64, count=len(out))
                table[state, keys] = (ends * width) << 2
        table[0, unknown] = 1
        table[0, pad] = 0
        return cls(table.ravel(), classes, pad, float(np.log2(max(2, len(data)))))

    def phrases(self, lanes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of each segment. ``lanes`` holds one segment's bytes per row."""
        symbols = self.classes[lanes.T]
        steps = np.arange(lanes.shape[1])
        symbols[steps[:, None] >= sizes[None, :]] = self.pad
        state = np.zeros(len(sizes), dtype=np.int32)
        count = np.zeros(len(sizes), dtype=np.int32)
        for row in symbols:
            step = self.table[state + row]
            state = step >> 2
            count += step & 3
        return count + (state > 0)


def _has_letter(text: str) -> bool:
    found = _LETTER.search(text)
    return found is not None and (found.group().isalpha() or any(map(str.isalpha, text)))


def _segments(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text cut into segments: padded bytes, sizes and the row each belongs to."""
    pieces = -(-texts.sizes // SEGMENT)
    rows = np.repeat(np.arange(len(texts)), pieces)
    order = np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = texts.bounds[rows] + order * SEGMENT
    sizes = np.minimum(SEGMENT, texts.bounds[rows + 1] - starts)
    padded = np.concatenate((texts.data, np.zeros(SEGMENT, np.uint8)))
    lanes = np.lib.stride_tricks.sliding_window_view(padded, SEGMENT)[starts]
    return lanes, sizes, rows


class Identifier:
    """The parsers of all languages; built once per Python worker from the sample."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(lang for lang, text in samples.items() if text.strip())
        self.parsers = [Parser.compile(samples[lang]) for lang in self.languages]

    def entropies(self, texts: Texts) -> np.ndarray:
        """Bits per byte of each text (rows) under each language (columns)."""
        lanes, sizes, rows = _segments(texts)
        bits = np.zeros((len(texts), len(self.parsers)))
        for k, parser in enumerate(self.parsers):
            counts = parser.phrases(lanes, sizes)
            bits[:, k] = np.bincount(rows, weights=counts, minlength=len(texts)) * parser.bits
        return bits / np.maximum(1, texts.sizes)[:, None]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        texts = Texts(column)
        known = np.array([_has_letter(t) for t in texts.column.to_pylist()], dtype=bool)
        if not self.parsers or not len(texts):
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        bits = self.entropies(texts)
        order = np.argsort(bits, axis=1, kind="stable")
        best = np.take_along_axis(bits, order[:, :1], 1)[:, 0]
        if len(self.parsers) > 1:
            second = np.take_along_axis(bits, order[:, 1:2], 1)[:, 0]
        else:
            second = np.full(len(texts), 8.0)
        score = np.where(known, second / np.maximum(best + second, 1e-9), 0.0)
        names = [self.languages[k] if ok else UNDETERMINED for k, ok in zip(order[:, 0], known, strict=True)]
        return names, np.clip(score, 0.0, 1.0)


def without_foreign_lines(samples: dict[str, bytes]) -> dict[str, bytes]:
    """Drop lines that another language explains better.

    A passage quoted in several languages would match in full wherever a sample holds it.
    So each half of a sample is parsed with automata of the other halves, in which its own
    copy does not occur.
    """
    lines = {lang: [x for x in text.split(b"\n") if x.strip()] for lang, text in samples.items()}
    kept: dict[str, list[bytes]] = {lang: [] for lang in samples}
    for half in (0, 1):
        judge = Identifier({lang: b"\n".join(x[1 - half :: 2]) for lang, x in lines.items()})
        for lang in samples:
            tried = lines[lang][half::2]
            if lang not in judge.languages or not tried:
                kept[lang] += tried
                continue
            text = pa.array([x.decode("utf-8", "replace") for x in tried], pa.string())
            best = judge.entropies(Texts(text)).argmin(axis=1)
            own = judge.languages.index(lang)
            kept[lang] += [x for x, k in zip(tried, best, strict=True) if k == own]
    return {lang: b"\n".join(kept[lang]) or samples[lang] for lang in samples}


def identify(documents: DataFrame, samples: dict[str, bytes] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every document; other columns pass through."""
    spark = documents.sparkSession
    samples = training_texts(documents) if samples is None else samples
    # At most a megabyte, see training_texts.
    shared = spark.sparkContext.broadcast(tuple(sorted(samples.items())))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = resident.keep(("language", shared.value), lambda: Identifier(dict(shared.value)))
        for batch in slices(batches, "text"):
            names, score = identifier.predict(batch.column("text"))
            arrays = [*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "lang_pred", "score"])

    kept = documents.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(predict, f"{fields}, lang_pred string, score double")


def language_report(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    slim = documents.select("doc_id", "text")
    found = identify(slim, training_texts(documents))
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score"
    )


def with_known_language(documents: DataFrame) -> DataFrame:
    """Documents in a language the samples know; the rest (``und``) go.

    A null or empty text has no language. Repeated rows stay, each with all its columns,
    whatever they are called; an empty table stays empty.
    """
    documents, columns = plainly_named(documents, ("doc_id", "text", "lang"))
    found = identify(documents)
    return found.where(F.col("lang_pred") != UNDETERMINED).select(*columns)
