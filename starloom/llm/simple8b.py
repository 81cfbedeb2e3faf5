"""Simple-8b: word-aligned coding of non-negative integers, whole arrays at a time.

A 64-bit word holds a selector in its top 4 bits and, below, as many values of one width
as fit 60 bits. Values are coded in blocks of ``BLOCK``; each block starts a word of its
own, and the offsets of the blocks' words come first, so blocks decode independently.

Layout, all little-endian 64-bit words: number of values, number of code words, the first
code word of each block, the code words. Selector 0 is an escape: its payload is the number
of values in the block so far, and the next word holds one value of 60 bits or more.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096

# Fixed by the format: values per word and their width, for selectors 1 to 15.
COUNTS = (120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

_ESCAPE = 0
_MOST = COUNTS[0]
_U = np.uint64


def _selectors(padded: np.ndarray, large: np.ndarray, blocks: int) -> np.ndarray:
    """For every place, the selector that packs most values from there on.

    A window that fits a narrow selector fits every wider one, so each narrower selector is
    tried only where the one before fitted.
    """
    best = np.full(len(padded), 15, dtype=np.uint8)
    best[large] = _ESCAPE
    most = int(padded.max(initial=0))
    places = len(padded) - _MOST
    for selector in range(14, 0, -1):
        count, width = COUNTS[selector - 1], WIDTHS[selector - 1]
        if most < 1 << width:
            best[:places] = selector
            continue
        fits = padded < _U(1 << width)
        span = 1
        while 2 * span <= count:  # all of 2, of 4, ... neighbours fit
            fits = fits[:-span] & fits[span:]
            span *= 2
        if span < count:
            fits = fits[: span - count] & fits[count - span :]
        best[:places][fits[:places]] = selector
        # The zeros behind the blocks always fit; little else is left to gain.
        if np.count_nonzero(fits) < blocks * 2 * _MOST:
            break
    return best


def encode(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values, dtype=np.uint64)
    blocks = -(-len(values) // BLOCK)
    stride = BLOCK + _MOST  # zeros behind each block, so that its last word can be full
    padded = np.zeros(blocks * stride + _MOST, dtype=np.uint64)
    whole = padded[: blocks * stride].reshape(blocks, stride)[:, :BLOCK]
    full = len(values) // BLOCK
    whole[:full] = values[: full * BLOCK].reshape(full, BLOCK)
    if full < blocks:
        whole[full, : len(values) - full * BLOCK] = values[full * BLOCK :]
    large = padded >= _U(1 << 60)
    best = _selectors(padded, large, blocks)
    steps = np.array([1, *COUNTS])
    sizes = np.full(blocks, BLOCK)
    if full < blocks:
        sizes[full] = len(values) - full * BLOCK
    # All blocks advance word by word together.
    base = np.arange(blocks) * stride
    place = np.zeros(blocks, dtype=np.int64)
    live = np.arange(blocks)
    begins = np.zeros(len(padded), dtype=bool)
    while len(live):
        here = base[live] + place[live]
        begins[here] = True
        place[live] += steps[best[here]]
        live = live[place[live] < sizes[live]]
    at = np.flatnonzero(begins)
    block = at // stride
    selector = best[at]
    width = 1 + (selector == _ESCAPE)
    word_at = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), dtype=np.uint64)
    for s in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == s)
        if s == _ESCAPE:
            words[word_at[rows]] = (at[rows] - block[rows] * stride).astype(np.uint64)
            words[word_at[rows] + 1] = padded[at[rows]]
            continue
        word = np.full(len(rows), s << 60, dtype=np.uint64)
        if WIDTHS[s - 1]:
            for k in range(COUNTS[s - 1]):
                word |= padded[at[rows] + k] << _U(k * WIDTHS[s - 1])
        words[word_at[rows]] = word
    starts = word_at[np.searchsorted(block, np.arange(blocks))] if blocks else np.zeros(0, np.int64)
    head = np.concatenate(([len(values), len(words)], starts)).astype("<u8")
    return head.tobytes() + words.astype("<u8").tobytes()


def _decode_words(words: np.ndarray, size: int) -> np.ndarray:
    """The values of one block's words."""
    out = []
    at = 0
    while at < len(words):
        s = int(words[at] >> _U(60))
        if s == _ESCAPE:
            out.append(words[at + 1 : at + 2])
            at += 2
            continue
        shifts = np.arange(COUNTS[s - 1], dtype=np.uint64) * _U(WIDTHS[s - 1])
        out.append((words[at] >> shifts) & _U((1 << WIDTHS[s - 1]) - 1))
        at += 1
    return np.concatenate(out)[:size]


def decode(data: bytes) -> np.ndarray:
    head = np.frombuffer(data, dtype="<u8", count=2).astype(np.int64)
    total, n_words = int(head[0]), int(head[1])
    blocks = -(-total // BLOCK)
    starts = np.frombuffer(data, dtype="<u8", count=blocks, offset=16).astype(np.int64)
    words = np.frombuffer(data, dtype="<u8", count=n_words, offset=16 + 8 * blocks)
    if not total:
        return np.zeros(0, np.uint64)
    ends = np.concatenate((starts[1:], [n_words]))
    selector = (words >> _U(60)).astype(np.uint8)
    # The word behind an escape may look like anything; blocks with one are decoded apart.
    escaped = np.logical_or.reduceat(selector == _ESCAPE, starts)
    out = np.empty(blocks * BLOCK + _MOST, dtype=np.uint64)
    owner = np.repeat(np.arange(blocks), ends - starts)
    counts = np.array([1, *COUNTS])[selector]
    before = np.cumsum(counts) - counts
    place = before - before[starts][owner] + owner * BLOCK
    plain = ~escaped[owner]
    limit = np.minimum((owner + 1) * BLOCK, total)
    for s in range(1, 16):
        rows = np.flatnonzero(plain & (selector == s))
        if not len(rows):
            continue
        mask = _U((1 << WIDTHS[s - 1]) - 1)
        for k in range(COUNTS[s - 1]):
            spot = place[rows] + k
            fits = spot < limit[rows]  # what pads a block's last word is not kept
            value = (words[rows] >> _U(k * WIDTHS[s - 1])) & mask if WIDTHS[s - 1] else _U(0)
            out[spot[fits]] = value[fits] if WIDTHS[s - 1] else value
    for b in np.flatnonzero(escaped).tolist():
        size = min(BLOCK, total - b * BLOCK)
        out[b * BLOCK : b * BLOCK + size] = _decode_words(words[starts[b] : ends[b]], size)
    return out[:total]
