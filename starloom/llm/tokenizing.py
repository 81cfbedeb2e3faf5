"""Token ids of whole texts as the tokenizers library gives them, with a bounded cache.

Neither a byte-level pre-tokenizer nor one that drops blanks ever joins text across the
place before a single blank, around a single line end, or between a letter and the comma or
full stop behind it. So a text is cut there, each distinct piece is encoded by the library
once per worker, and the ids are gathered from arrays. A piece of letters alone is one word to the
pre-tokenizer, so it goes to the library's model directly. A text in which a blank meets
another white space is encoded whole, since runs of white space are split by lookahead.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starloom.llm import resident
from starloom.llm.texts import ASCII_LOWER, Texts, byte_table

#: Text bytes that are encoded at a time: repeated pieces are found across them.
SLICE_BYTES = 4 << 20

#: Pieces that stay when a cache is full.
CACHED_PIECES = 300_000
_LONGEST_CACHED = 64
#: Ids a piece, on average, at which a cache is full too: long pieces take space in it.
_MOST_IDS = 8
_STOPS = ",.!?;:"
#: Letters that no neighbour changes: neither composition nor lower case looks beyond them.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_WORD = re.compile(f" ?[{_LETTERS}]+")
_ASCII_LETTER = byte_table(bytes(range(65, 91)) + bytes(range(97, 123)))
_ASCII_SHOWN = byte_table(bytes(range(33, 127)))
# The first byte of U+00C0 to U+00FF in UTF-8, and the last of the two that are no letters.
_LATIN, _SIGNS = 0xC3, (0x97, 0xB7)


@dataclass(frozen=True)
class TokenizerFile:
    """A tokenizer's definition, read by the driver: executors need no file."""

    definition: str

    @classmethod
    def read(cls, path: str) -> TokenizerFile:
        with open(path, encoding="utf-8") as file:
            return cls(file.read())


def _keeps_blanks(definition: str) -> bool:
    """Whether pieces carry their blank; the two supported kinds of pre-tokenizer differ in it."""
    parts = json.loads(definition)
    before = parts["pre_tokenizer"]
    if before["type"] == "ByteLevel":
        if not before["use_regex"] or before["add_prefix_space"] or parts["normalizer"]:
            raise ValueError("a byte-level tokenizer has to split by its pattern, without prefix or normalizer")
        return True
    kinds = [(p["type"], p.get("behavior")) for p in before.get("pretokenizers", [])]
    if kinds[:1] != [("Split", "Removed")]:
        raise ValueError("the pre-tokenizer has to be byte-level or to drop white space")
    return False


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy with room for ``size`` values."""
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


class _Cache:
    """Ids by piece, bounded: the pieces in use outlive the many that come once.

    The ids of all pieces lie in one array. Twice ``most`` pieces fill the cache; of these at most
    half stay, those last asked for.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], most: int) -> None:
        self._encode, self._most, self._now = encode, most, 0
        self._start({}, np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _start(self, rows: dict[str, int], ids: np.ndarray, counts: np.ndarray) -> None:
        self._rows, self._count, self._size = rows, 0, 0
        self._ids, self._ends, self._used = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int64)
        self._add(ids, counts)

    def _add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        count, size = self._count + len(counts), self._size + len(ids)
        self._ids, self._ends, self._used = _room(self._ids, size), _room(self._ends, count + 1), _room(self._used, count)
        self._ids[self._size : size] = ids
        self._ends[self._count + 1 : count + 1] = self._size + np.cumsum(counts)
        self._count, self._size = count, size

    def _get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, counts = self._ends[rows], self._ends[rows + 1] - self._ends[rows]
        place = np.repeat(starts - (np.cumsum(counts) - counts), counts)
        place += np.arange(len(place))
        return self._ids[place], counts

    def _forget(self) -> None:
        rows = np.fromiter(self._rows.values(), np.int64, len(self._rows))
        used = self._used[rows]
        stays = np.ones(len(used), dtype=bool)
        if len(used) > self._most:
            stays = used > np.partition(used, len(used) - self._most - 1)[len(used) - self._most - 1]
        names = compress(self._rows, stays.tolist())
        ids, counts = self._get(rows[stays])
        if len(ids) > _MOST_IDS * self._most:
            names, ids, counts = (), ids[:0], counts[:0]
        self._start(dict(zip(names, range(len(counts)), strict=True)), ids, counts)

    def look_up(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces in a row, and how many each has."""
        if self._count > 2 * self._most or self._size > 2 * _MOST_IDS * self._most:
            self._forget()
        self._now += 1
        found = np.fromiter(map(self._rows.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            names = list(compress(pieces, (found < 0).tolist()))
            order, ids, counts = self._encode(names)
            found[missing[order]] = self._count + np.arange(len(names))
            self._add(ids, counts)
            made = zip(names, found[missing].tolist(), strict=True)
            if max(map(len, names)) > _LONGEST_CACHED:
                made = [(piece, row) for piece, row in made if len(piece) <= _LONGEST_CACHED]
            self._rows.update(made)
        self._used[found] = self._now
        return self._get(found)


class _Words:
    """Words of plain letters by the library's model, without its steps around the model.

    What these steps make of each letter is asked of the library; nothing is a word here if they
    would cut a run of letters or if a special string could be part of one.
    """

    def __init__(self, tokenizer, keeps_blanks: bool, specials: list[str]) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        normalized = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        letters = "".join(filter(_WORD.fullmatch, map(chr, range(33, 256))))
        table = {x: as_bytes(normalized(x))[0][0] for x in letters}
        table[" "] = as_bytes(" ")[0][0] if keeps_blanks else ""
        self._table = str.maketrans(table)
        self._model = tokenizer.model
        probe = " " + letters + letters[::-1]
        cut = [x for x, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normalized(probe))]
        whole = cut == [probe.translate(self._table)]
        self.match = _WORD.fullmatch if whole and not any(map(_WORD.fullmatch, specials)) else lambda _: None

    def encode(self, words: list[str]) -> tuple[list[int], list[int]]:
        tokenize = self._model.tokenize
        ids, counts = [], []
        for word in "\n".join(words).translate(self._table).split("\n") if words else ():
            made = [t.id for t in tokenize(word)]
            ids += made
            counts.append(len(made))
        return ids, counts


def _lowered(column: pa.Array) -> pa.Array:
    """ASCII letters in lower case; all other bytes as they are."""
    texts = Texts(column)
    data = pa.py_buffer(ASCII_LOWER[texts.data].tobytes())
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(texts.bounds.astype(np.int64).tobytes()), data)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class PieceEncoder:
    def __init__(self, definition: str, cached: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._keeps_blanks = _keeps_blanks(definition)
        self._specials = [t["content"] for t in json.loads(definition)["added_tokens"]]
        # Special strings are never cut.
        self._stops = byte_table("".join(x for x in _STOPS if not any(x in y for y in self._specials)).encode())
        self._cuts_lines = not any("\n" in x for x in self._specials)
        self._words = _Words(self._tokenizer, self._keeps_blanks, self._specials)
        self._pieces = _Cache(self._encode, cached)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces in another order, by number, their ids in a row, and how many each has."""
        plain = [x is not None for x in map(self._words.match, pieces)]
        ids, counts = self._words.encode(list(compress(pieces, plain)))
        others = np.array(plain) ^ True
        more, more_counts = self._by_library(list(compress(pieces, others.tolist())))
        order = np.argsort(others, kind="stable")
        return order, np.concatenate((np.array(ids, np.uint32), more)), np.concatenate((np.array(counts, np.int64), more_counts))

    def _by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = array("I"), []
        for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            made = x.ids
            ids.extend(made)
            counts.append(len(made))
        return np.array(ids, np.uint32), np.array(counts, np.int64)

    def _begins(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The places in the bytes of some texts at which pieces begin."""
        begins = data == 32
        before, after = np.zeros_like(data), np.zeros_like(data)
        before[1:], after[:-1] = data[:-1], data[1:]
        stops = np.flatnonzero(self._stops[data])
        last, lead = before[stops], before[stops - 1]
        letter = _ASCII_LETTER[last] | ((lead == _LATIN) & (last >= 128) & (last != _SIGNS[0]) & (last != _SIGNS[1]))
        begins[stops[letter & (stops > 1)]] = True
        if self._cuts_lines:
            lines = np.flatnonzero(data == 10)
            lines = lines[lines > 1]
            safe = _ASCII_SHOWN[before[lines]] | ((before[lines - 1] == _LATIN) & (before[lines] >= 128))
            lines = lines[safe & (_ASCII_SHOWN[after[lines]] | (after[lines] == _LATIN))]
            begins[lines] = True
            begins[lines + 1] = True
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        return np.flatnonzero(begins)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins and ends; null is empty."""
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # The other kind lowers all letters, so pieces that differ by case share their ids.
        lowered = texts if self._keeps_blanks else _lowered(texts)
        raw = Texts(lowered)
        begins = self._begins(raw.data, raw.bounds)
        bounds = np.searchsorted(begins, raw.bounds)
        offsets = np.concatenate((begins, [len(raw.data)]))
        spans = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(raw.data))
        coded = spans.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        counts = np.diff(bounds)
        if self._keeps_blanks:
            # Two white spaces in a row: such texts count as one piece and are encoded whole.
            odd = pc.and_(
                pc.starts_with(coded.dictionary, " "),
                pc.or_(
                    pc.equal(pc.binary_length(coded.dictionary), 1),
                    pc.utf8_is_space(pc.utf8_slice_codeunits(coded.dictionary, 1, 2)),
                ),
            ).to_numpy(zero_copy_only=False)
            strange = np.concatenate(([0], np.cumsum(odd[codes])))
            whole = np.flatnonzero(strange[bounds[1:]] > strange[bounds[:-1]])
            place = np.cumsum(~odd) - 1
            table, sizes = self._pieces.look_up(_strings(coded.dictionary.filter(pa.array(~odd))))
            codes = place[codes]
        else:
            # A special string that only lower case has made is not special.
            whole = np.zeros(0, np.int64)
            for special in self._specials:
                made = pc.count_substring(lowered, special), pc.count_substring(texts, special)
                whole = np.union1d(whole, np.flatnonzero(pc.not_equal(*made).to_numpy(zero_copy_only=False)))
            table, sizes = self._pieces.look_up(_strings(coded.dictionary))
        if len(whole):
            keep = np.ones(len(texts), dtype=bool)
            keep[whole] = False
            new_counts = np.where(keep, counts, 1)
            new_bounds = np.concatenate(([0], np.cumsum(new_counts)))
            new_codes = np.empty(new_bounds[-1], dtype=np.int64)
            rows = np.repeat(keep, counts)
            new_codes[np.repeat(keep, new_counts)] = codes[rows]
            new_codes[new_bounds[whole]] = len(sizes) + np.arange(len(whole))
            more, more_sizes = self._by_library(_strings(texts.take(pa.array(whole))))
            table, sizes = np.concatenate((table, more)), np.concatenate((sizes, more_sizes))
            codes, bounds = new_codes, new_bounds
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        # A piece's ids lie together in the table: its place there, less its place here.
        place = np.repeat(starts[codes] - ends[:-1], lengths)
        place += np.arange(len(place))
        return table[place], ends[bounds]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with ``end_id`` after each."""
    ended = bounds + np.arange(len(bounds))
    out = np.full(len(ids) + len(bounds) - 1, end_id, dtype="<u4")
    inside = np.ones(len(out), dtype=bool)
    inside[ended[1:] - 1] = False
    out[inside] = ids
    return out, ended


def encoder(definition: str, cached: int = CACHED_PIECES) -> PieceEncoder:
    return resident.keep(("encoder", definition, cached), lambda: PieceEncoder(definition, cached))
