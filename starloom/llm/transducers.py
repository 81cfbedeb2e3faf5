"""A byte-level BPE tokenizer compiled into finite-state transducers that count tokens.

The pre-tokenizer's pattern is a small transducer over character classes; its transitions
say where a piece begins. The merges become a second transducer over bytes, determinised
as it is used: reading one more byte changes the number of tokens by the amount on the
transition, and the state after the last byte does not matter.

What the merges make of a prefix can be told from its last token: a token follows another
if no merge across the border comes before those that build the two. So a state is the
longest end of the text read that begins some token, with the last token and the relative
count at each place in it.

Texts are cut into chunks that are read side by side. Reading a chunk from every state
gives its state map; most maps become constant within a few characters. A prefix scan over
the maps gives each chunk's true first state.
"""

from __future__ import annotations

import json

import numpy as np
import regex
from tokenizers import Tokenizer

from starloom.llm.texts import Hasher

CHUNK = 256
#: Transitions and pieces remembered by a worker; beyond it they are built anew.
MOST_TRANSITIONS = 1_500_000
MOST_PIECES = 1_500_000

# Character classes. The letters of the pattern's contractions have classes of their own.
_CONTRACTIONS = "stmdrevl"
_SPACE, _BLANK, _NUMBER, _QUOTE, _OTHER, _LETTER = 8, 9, 10, 11, 12, 13
_PAD = 14
_CLASSES = 15

# States: what has been read since the last certain beginning of a piece.
_BEGIN, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS = 0, 1, 2, 3
_ONE_SPACE, _SPACES, _ONE_BLANK, _BLANKS = 4, 5, 6, 7  # one, or several up to one of that kind
_AFTER_QUOTE, _QUOTE_R, _QUOTE_V, _QUOTE_L = 8, 9, 10, 11
_STATES = 12

# Output of a transition: a piece begins here, or with the character before.
_HERE, _BEFORE = 1, 2


class CharacterClasses:
    """Classes of code points as the library's own pattern sees them; its Unicode version
    need not be Python's. A code point is looked up in the library when it first occurs."""

    _UNKNOWN = 255

    def __init__(self, tokenizer) -> None:
        self._split = tokenizer.pre_tokenizer.pre_tokenize_str
        self._table = np.full(0x110000, self._UNKNOWN, dtype=np.uint8)
        self._table[ord(" ")], self._table[ord("'")] = _SPACE, _QUOTE
        for kind, letter in enumerate(_CONTRACTIONS):
            self._table[ord(letter)] = kind

    def of(self, points: np.ndarray) -> np.ndarray:
        kinds = self._table[points]
        if (kinds == self._UNKNOWN).any():
            self._learn(np.unique(points[kinds == self._UNKNOWN]))
            kinds = self._table[points]
        return kinds

    def _learn(self, points: np.ndarray) -> None:
        self._table[points] = _BLANK
        for lead, kind in (("a", _LETTER), ("1", _NUMBER), ("!", _OTHER)):
            left = points[self._table[points] == _BLANK]
            text = "".join(lead + chr(c) for c in left.tolist())
            begins = np.zeros(len(text) + 1, dtype=bool)
            begins[[span[0] for _, span in self._split(text)]] = True
            self._table[left[~begins[1 : len(text) : 2]]] = kind


def _step(state: int, kind: int) -> tuple[int, int]:
    """The pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
    as a transition: next state and output."""
    if kind == _PAD:
        return state, 0
    letter = kind < 8 or kind == _LETTER
    entry = {
        _SPACE: _ONE_SPACE,
        _BLANK: _ONE_BLANK,
        _NUMBER: _IN_NUMBERS,
        _QUOTE: _AFTER_QUOTE,
        _OTHER: _IN_OTHERS,
    }.get(kind, _IN_LETTERS)
    white = kind in (_SPACE, _BLANK)
    if state in (_QUOTE_R, _QUOTE_V, _QUOTE_L):
        if kind == _CONTRACTIONS.index("l" if state == _QUOTE_L else "e"):
            return _BEGIN, 0
        # No contraction: the quote was a piece, the letter begins a word.
        return (_IN_LETTERS, _BEFORE) if letter else (entry, _BEFORE | _HERE)
    if state == _AFTER_QUOTE:
        if kind < 4:
            return _BEGIN, 0
        if kind < 8 and _CONTRACTIONS[kind] in "rvl":
            return {"r": _QUOTE_R, "v": _QUOTE_V, "l": _QUOTE_L}[_CONTRACTIONS[kind]], 0
        return (_IN_OTHERS, 0) if kind in (_QUOTE, _OTHER) else (entry, _HERE)
    if state in (_ONE_SPACE, _SPACES, _ONE_BLANK, _BLANKS):
        if white:
            return (_SPACES if kind == _SPACE else _BLANKS), 0
        several = _BEFORE if state in (_SPACES, _BLANKS) else 0
        if state in (_ONE_SPACE, _SPACES):  # the last space joins what follows
            return (_IN_OTHERS if kind == _QUOTE else entry), several
        return entry, several | _HERE
    same = (
        (state == _IN_LETTERS and letter)
        or (state == _IN_NUMBERS and kind == _NUMBER)
        or (state == _IN_OTHERS and kind in (_OTHER, _QUOTE))
    )
    return (state, 0) if same else (entry, _HERE)


def _compile_pattern() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output by state and class."""
    moves = np.zeros((_STATES, _CLASSES), dtype=np.uint8)
    output = np.zeros((_STATES, _CLASSES), dtype=np.uint8)
    for state in range(_STATES):
        for kind in range(_CLASSES):
            moves[state, kind], output[state, kind] = _step(state, kind)
    return moves, output


class Pieces:
    """The pattern's transducer, run over many texts at a time."""

    def __init__(self, classes: CharacterClasses) -> None:
        self._classes = classes
        moves, output = _compile_pattern()
        self._moves, self._output = moves.ravel(), output.ravel()
        self._both = (self._moves | (self._output << 4)).astype(np.uint8)

    def begins(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For every character, whether a piece begins there. ``bounds`` part the texts."""
        sizes = np.diff(bounds)
        chunks = -(-sizes // CHUNK)
        rows = np.repeat(np.arange(len(sizes)), chunks)
        order = np.arange(len(rows)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        starts = bounds[rows] + order * CHUNK
        lengths = np.minimum(CHUNK, bounds[rows + 1] - starts)
        begins = np.zeros(len(points) + 1, dtype=bool)
        if not len(rows):
            return begins[:-1]
        kinds = np.concatenate((self._classes.of(points), np.full(CHUNK, _PAD, np.uint8)))
        symbols = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(kinds, CHUNK)[starts].T)
        symbols[np.arange(CHUNK)[:, None] >= lengths[None, :]] = _PAD

        # Maps: from every state, until all have met; then one run stands for all.
        maps = np.tile(np.arange(_STATES, dtype=np.uint8), (len(rows), 1))
        met = np.full(len(rows), CHUNK)
        live = np.arange(len(rows))
        for at in range(CHUNK):
            now = self._moves[maps[live].astype(np.intp) * _CLASSES + symbols[at, live][:, None]]
            maps[live] = now
            apart = (now != now[:, :1]).any(axis=1)
            met[live[~apart]] = at + 1
            live = live[apart]
            if not len(live):
                break
        state, marks = self._run(symbols, np.zeros(len(rows), dtype=np.uint8))
        joined = met < CHUNK
        maps[joined] = state[joined, None]

        # Scan: compose each chunk's map with all before it in its text.
        scanned, reach = maps, 1
        while reach <= int(order.max(initial=0)):
            later = np.flatnonzero(order >= reach)
            scanned = scanned.copy() if scanned is maps else scanned
            scanned[later] = np.take_along_axis(scanned[later], scanned[later - reach], axis=1)
            reach *= 2
        first = np.zeros(len(rows), dtype=np.uint8)
        inner = np.flatnonzero(order > 0)
        first[inner] = scanned[inner - 1, _BEGIN]

        # The heads of the chunks, read again from their true states.
        head = np.flatnonzero(first != _BEGIN)
        if len(head):
            longest = int(met[head].max())
            _, again = self._run(symbols[:longest, head], first[head])
            stays = np.arange(longest)[:, None] >= met[head][None, :]
            marks[:longest, head] = np.where(stays, marks[:longest, head], again)
        step, lane = np.nonzero(marks)
        place = starts[lane] + step
        mark = marks[step, lane]
        begins[place[(mark & _HERE) > 0]] = True
        begins[place[(mark & _BEFORE) > 0] - 1] = True
        last = np.flatnonzero(order == chunks[rows] - 1)
        end = scanned[last, _BEGIN]
        pending = last[(end == _QUOTE_R) | (end == _QUOTE_V) | (end == _QUOTE_L)]
        begins[bounds[rows[pending] + 1] - 1] = True
        return begins[:-1]

    def _run(self, symbols: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last states and outputs of one run over each column."""
        marks = np.empty(symbols.shape, dtype=np.uint8)
        row = state.astype(np.intp)
        for at in range(symbols.shape[0]):
            found = self._both[row * _CLASSES + symbols[at]]
            marks[at] = found >> 4
            row = (found & 15).astype(np.intp)
        return row.astype(np.uint8), marks


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary: printable Latin-1 stands
    for itself, the other bytes follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Merges:
    """The merges as a transducer over bytes, built as far as it is used."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        letters = _byte_letters()
        self._rank: dict[tuple[int, int], int] = {}
        self._made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocabulary[left], vocabulary[right]
            self._rank[pair] = rank
            self._made.setdefault(vocabulary[left + right], (*pair, rank))
        self._right_edges: dict[int, list[tuple[int, float]]] = {}
        self._left_edges: dict[int, list[tuple[int, float]]] = {}
        self._tokens: dict[bytes, int] = {}
        self._begins: set[bytes] = {b""}
        whole: set[int] = set()
        for text, token in sorted(vocabulary.items(), key=lambda item: len(item[0])):
            if not all(letter in letters for letter in text):
                continue
            made = self._made.get(token)
            if made:
                # A token can come out only if nothing but its own merge joins its halves.
                if made[0] not in whole or made[1] not in whole or self._crossing(made[0], made[1]) != {made[:2]}:
                    continue
            elif len(text) > 1:
                continue
            whole.add(token)
            data = bytes(letters[letter] for letter in text)
            self._tokens[data] = token
            self._begins.update(data[:k] for k in range(1, len(data)))
        self._follows: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: the end of the text that begins a token; for each place in it, counted
        # backwards, the token that ends there (None where the text begins) and how many
        # tokens have been added since.
        start = (b"", (None,), (0,))
        self._states = [start]
        self._ids = {start: 0}
        self._moves: dict[int, int] = {}

    def _edges(self, token: int, side: int, known: dict) -> list[tuple[int, float]]:
        """The symbols at one end of a token while it is built, each with the rank of the
        merge that ends it."""
        if token not in known:
            edges, until, at = [], float("inf"), token
            while True:
                edges.append((at, until))
                if at not in self._made:
                    break
                until = self._made[at][2]
                at = self._made[at][side]
            known[token] = edges
        return known[token]

    def _crossing(self, left: int, right: int) -> set[tuple[int, int]]:
        """Merges that would join the two across their border. Of equal merges the leftmost
        comes first, hence the unequal comparisons."""
        return {
            (a, b)
            for a, until_a in self._edges(left, 1, self._right_edges)
            for b, until_b in self._edges(right, 0, self._left_edges)
            if (rank := self._rank.get((a, b))) is not None and rank < until_a and rank <= until_b
        }

    def _may_follow(self, left: int | None, right: int) -> bool:
        if left is None:
            return True
        pair = left, right
        if pair not in self._follows:
            if len(self._follows) > MOST_TRANSITIONS:
                self._follows.clear()
            self._follows[pair] = not self._crossing(left, right)
        return self._follows[pair]

    def _build(self, state: int, byte: int) -> int:
        end, lasts, counts = self._states[state]
        end += bytes((byte,))
        for size in range(len(end), 0, -1):
            token = self._tokens.get(end[-size:])
            if token is not None and self._may_follow(lasts[size - 1], token):
                break
        else:
            raise ValueError(f"the vocabulary lacks the byte {byte}")
        change = 1 - counts[size - 1]
        while end not in self._begins:
            end = end[1:]
        kept = len(end)
        new = (end, (token, *lasts[:kept]), (0, *(change + c for c in counts[:kept])))
        if new not in self._ids:
            self._ids[new] = len(self._states)
            self._states.append(new)
        # A byte adds at most a token and undoes fewer than a token has bytes, below 256.
        move = (self._ids[new] << 9) | (change + 256)
        self._moves[(state << 8) | byte] = move
        return move

    def count(self, piece: bytes) -> int:
        """Tokens of one piece."""
        if len(self._moves) > MOST_TRANSITIONS:
            self._reset()
        moves, state, total = self._moves, 0, 0
        for byte in piece:
            move = moves.get((state << 8) | byte)
            if move is None:
                move = self._build(state, byte)
            total += (move & 511) - 256
            state = move >> 9
        return total


class TokenCounter:
    """Counts tokens of whole texts exactly as the tokenizer's library would give them."""

    def __init__(self, definition: str):
        parts = json.loads(definition)
        before, model = parts["pre_tokenizer"], parts["model"]
        if before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"] or parts["normalizer"]:
            raise ValueError("not a byte-level tokenizer with its usual pattern")
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("not a plain BPE model")
        self._specials = [t["content"] for t in parts["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in parts["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self._split = regex.compile("|".join(regex.escape(s) for s in sorted(self._specials, key=len, reverse=True)) or r"(?!)")
        self._pieces = Pieces(CharacterClasses(Tokenizer.from_str(definition)))
        self._merges = Merges(model["vocab"], model["merges"])
        self._known: dict[int, int] = {}

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special string counts as one and parts the text."""
        rows = np.arange(len(texts))
        extra = np.zeros(len(texts), dtype=np.int64)
        if any(special in text for special in self._specials for text in texts):
            split = [self._split.split(text) for text in texts]
            extra = np.array([len(parts) - 1 for parts in split])
            rows = np.repeat(rows, extra + 1)
            texts = [part for parts in split for part in parts]
        return extra + np.bincount(rows, weights=self._plain(texts), minlength=len(extra)).astype(np.int64)

    def _plain(self, texts: list[str]) -> np.ndarray:
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        data = np.frombuffer(joined.encode(), dtype=np.uint8)
        at = np.flatnonzero(self._pieces.begins(points, bounds))
        if not len(at):
            return np.zeros(len(texts))
        letters = np.flatnonzero((data & 0xC0) != 0x80)
        starts = letters[at]
        ends = np.concatenate((starts[1:], [len(data)]))
        hashes, first, inverse = np.unique(Hasher(data).spans(starts, ends), return_index=True, return_inverse=True)
        if len(self._known) > MOST_PIECES:
            self._known.clear()
        keys = hashes.tolist()
        counts = list(map(self._known.get, keys))
        view = data.tobytes()
        for k in [k for k, n in enumerate(counts) if n is None]:
            counts[k] = self._known[keys[k]] = self._merges.count(view[starts[first[k]] : ends[first[k]]])
        rows = np.searchsorted(bounds, at, side="right") - 1
        return np.bincount(rows, weights=np.array(counts)[inverse], minlength=len(texts))
