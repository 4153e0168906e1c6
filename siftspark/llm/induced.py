"""Suffix sorting of a shard by induction, with queues that go to disk.

The order of all suffixes follows from the order of few: those at the left ends of ascending
runs. A first induction from these seeds in text order sorts the strings between seeds; each
gets a name, names are doubled up recursively until seeds differ or the depth that is
asked for is reached, and a second induction from the sorted seeds gives all suffixes.

An induction is a walk over a priority queue ordered by first symbol, then by arrival: smallest
symbol first for suffixes greater than their successor, greatest first for the others. A suffix taken
from the queue puts its predecessor in. Tuples carry the symbols before the suffix, so the text
is looked at only once in four steps; whole blocks of equal first symbol are taken at a time, and a queue
that outgrows its memory writes its largest buckets to an unnamed scratch file of the task.
"""

from __future__ import annotations

import tempfile

import numpy as np

CARRIED = 4  # symbols of 16 bits in a tuple
SYMBOL_BITS = np.uint64(16)
SYMBOL_MASK = np.uint64(0xFFFF)


class Queue:
    """Tuples (position, preceding symbols, symbols left) by bucket, first in, first out."""

    KIND = np.dtype([("at", "<i8"), ("before", "<u8"), ("left", "u1")])

    def __init__(self, symbols: int, memory: int):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.held = np.zeros(symbols, np.int64)
        self.memory, self.file = memory, None

    def put(self, bucket: int, block: np.ndarray) -> None:
        self.parts[bucket].append(block)
        self.held[bucket] += block.nbytes
        while self.held.sum() > self.memory:
            self._spill(int(self.held.argmax()))

    def _spill(self, bucket: int) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for i, part in enumerate(self.parts[bucket]):
            if not isinstance(part, tuple):
                start = self.file.seek(0, 2)
                self.file.write(part.tobytes())
                self.parts[bucket][i] = (start, len(part))
        self.held[bucket] = 0

    def take(self, bucket: int) -> np.ndarray | None:
        """All that waits in a bucket, in order of arrival."""
        parts, self.parts[bucket] = self.parts[bucket], []
        self.held[bucket] = 0
        found = []
        for part in parts:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.frombuffer(self.file.read(part[1] * self.KIND.itemsize), self.KIND)
            found.append(part)
        return np.concatenate(found) if found else None

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Text:
    """A shard's symbols, with the smallest one, 0, only at the end."""

    def __init__(self, symbols: np.ndarray):
        self.t = symbols
        n = len(symbols)
        step = np.sign(np.diff(symbols.astype(np.int32)))
        # The step that decides is the next one that isn't 0.
        change = np.where(step != 0, np.arange(n - 1), n)
        following = np.minimum.accumulate(change[::-1])[::-1]
        self.small = np.r_[step[np.minimum(following, n - 2)] > 0, True]
        self.small[n - 1] = True
        starts = self.small.copy()
        starts[1:] &= ~self.small[:-1]
        starts[0] = False
        self.seeds = np.flatnonzero(starts)
        self.is_seed = starts

    def tuples(self, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), Queue.KIND)
        before = np.zeros(len(at), np.uint64)
        for k in range(CARRIED, 0, -1):
            before <<= SYMBOL_BITS
            before |= self.t[np.maximum(at - k, 0)].astype(np.uint64)
        out["at"], out["before"], out["left"] = at, before, np.minimum(at, CARRIED)
        return out

    def before(self, block: np.ndarray) -> np.ndarray:
        """Tuples of the suffixes one to the left, from what the tuples carry."""
        out = np.empty(len(block), Queue.KIND)
        out["at"] = block["at"] - 1
        out["before"] = block["before"] >> SYMBOL_BITS
        out["left"] = block["left"] - 1
        spent = (out["left"] == 0) & (out["at"] > 0)
        if spent.any():
            out[spent] = self.tuples(out["at"][spent])
        return out


def _distribute(queue: Queue, symbols: np.ndarray, block: np.ndarray) -> None:
    order = np.argsort(symbols, kind="stable")
    symbols, block = symbols[order], block[order]
    starts = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]]) if len(symbols) else []
    for a, b in zip(starts, [*starts[1:], len(symbols)]):
        queue.put(int(symbols[a]), block[a:b])


def induce(text: Text, seeds: np.ndarray, symbols: int, memory: int) -> tuple[list, list]:
    """Positions per bucket: of descending suffixes in order, of ascending ones in reverse."""
    t = text.t
    waiting, large, small = Queue(symbols, memory), [], []
    sorted_seeds = Queue(symbols, memory)
    _distribute(sorted_seeds, t[seeds], text.tuples(seeds))
    later = Queue(symbols, memory)
    for c in range(symbols):
        taken = []
        while (block := waiting.take(c)) is not None:
            taken.append(block)
            block = block[block["at"] > 0]
            symbol = (block["before"] & SYMBOL_MASK).astype(np.uint16)
            down = symbol >= c
            _distribute(waiting, symbol[down], text.before(block[down]))
        whole = np.concatenate(taken) if taken else np.zeros(0, Queue.KIND)
        large.append(whole["at"])
        if len(whole):
            later.put(c, whole)
        block = sorted_seeds.take(c)
        if block is not None:
            block = block[block["at"] > 0]
            symbol = (block["before"] & SYMBOL_MASK).astype(np.uint16)
            _distribute(waiting, symbol, text.before(block))
    ascending = Queue(symbols, memory)
    for c in range(symbols - 1, -1, -1):
        taken = []
        while (block := ascending.take(c)) is not None:
            taken.append(block["at"])
            block = block[block["at"] > 0]
            symbol = (block["before"] & SYMBOL_MASK).astype(np.uint16)
            up = symbol <= c
            _distribute(ascending, symbol[up], text.before(block[up]))
        small.append(np.concatenate(taken) if taken else np.zeros(0, np.int64))
        block = later.take(c)
        if block is not None:
            block = block[::-1]
            block = block[block["at"] > 0]
            symbol = (block["before"] & SYMBOL_MASK).astype(np.uint16)
            up = symbol < c
            _distribute(ascending, symbol[up], text.before(block[up]))
    for queue in (waiting, sorted_seeds, later, ascending):
        queue.close()
    return large, small[::-1]


def _joined(large: list, small: list) -> np.ndarray:
    parts = []
    for down, up in zip(large, small):
        parts += [down, up[::-1]]
    return np.concatenate(parts)


def _names(text: Text, order: np.ndarray) -> np.ndarray:
    """Ranks of the strings from each seed to the next, equal for equal strings, in text order."""
    t, seeds = text.t, text.seeds
    ordered = order[text.is_seed[order]]
    # The end symbol is a seed too, and no induction reaches it: it comes first.
    ordered = np.r_[len(t) - 1, ordered]
    ends = np.r_[seeds[1:], len(t) - 1]
    number = np.empty(len(t), np.int64)
    number[seeds] = np.arange(len(seeds))
    length = (ends - seeds + 1)[number[ordered]]
    new = np.ones(len(ordered), bool)
    new[1:] = length[1:] != length[:-1]
    same = np.flatnonzero(~new)
    k = 0
    while len(same):
        a, b = ordered[same - 1] + k, ordered[same] + k
        differ = t[a] != t[b]
        new[same[differ]] = True
        same = same[~differ]
        k += 1
        same = same[length[same] > k]
    ranks = np.empty(len(seeds), np.int64)
    ranks[number[ordered]] = np.cumsum(new) - 1
    return ranks


def sort_suffixes(symbols: np.ndarray, depth: int, memory: int = 64 << 20) -> np.ndarray:
    """Positions of all suffixes but the last, in order of their first `depth` symbols at least.

    `symbols` are 16-bit numbers that end with the only 0.
    """
    if len(symbols) < 2:
        return np.zeros(0, np.int64)
    text = Text(symbols)
    count = int(symbols.max()) + 1 if len(symbols) else 1
    large, small = induce(text, text.seeds, count, memory)
    names = _names(text, _joined(large, small))
    reach = 1  # seeds a name looks ahead; each stands for two symbols at least
    while names.max(initial=0) + 1 < len(names) and 2 * reach < depth:
        ahead = np.zeros(len(names), np.int64)
        ahead[: len(names) - reach] = names[reach:] + 1
        _, names = np.unique(names * (len(names) + 2) + ahead, return_inverse=True)
        reach *= 2
    seeds = text.seeds[np.argsort(names, kind="stable")]
    return _joined(*induce(text, seeds, count, memory))
