"""External induced sorting of the suffixes of one shard, with common-prefix values.

The text is an array of symbols: 0 ends a piece, other symbols are bytes + 1. Suffixes are sorted to a depth
of at least ``DEPTH`` symbols. As in other induced sorters, the suffixes that begin where a descent turns into
an ascent are sorted first: the substrings between them are named in order, and the string of names is
sorted by merging names of neighbours, recursively, until names are distinct or reach the depth. From them
all L suffixes are induced by one ascending scan and all S suffixes by one descending scan. The scans' priority
queues deliver by first symbol, then by order of arrival, and carry the common prefix of neighbours, which is
one more than the least value met between their successors. Queues move to disk beyond a memory bound.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

DEPTH = 100
SYMBOLS = 257
QUEUE_BYTES = 64 << 20
_TOP = np.uint8(DEPTH + 1)


class DiskQueues:
    """First-in first-out queues of (position, common prefix) by symbol, kept on disk beyond ``limit`` bytes."""

    def __init__(self, limit: int = QUEUE_BYTES):
        self.parts: list[list] = [[] for _ in range(SYMBOLS)]
        self.limit, self.held, self.folder, self.files = limit, 0, None, 0

    def put(self, symbol: int, position: np.ndarray, common: np.ndarray):
        self.parts[symbol].append((position, common))
        self.held += position.nbytes + common.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self):
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory()
        for parts in self.parts:
            for i, part in enumerate(parts):
                if isinstance(part, tuple):
                    path = os.path.join(self.folder.name, f"{self.files}.npz")
                    self.files += 1
                    np.savez(path, p=part[0], c=part[1])
                    parts[i] = path
        self.held = 0

    def take(self, symbol: int):
        """All entries of a queue that have arrived, or None."""
        parts, self.parts[symbol] = self.parts[symbol], []
        got = []
        for part in parts:
            if isinstance(part, str):
                with np.load(part) as f:
                    got.append((f["p"], f["c"]))
                os.remove(part)
            else:
                self.held -= part[0].nbytes + part[1].nbytes
                got.append(part)
        if not got:
            return None
        return np.concatenate([p for p, _ in got]), np.concatenate([c for _, c in got])

    def close(self):
        if self.folder is not None:
            self.folder.cleanup()


def _refine(rank: np.ndarray, which: np.ndarray, key: np.ndarray) -> bool:
    """Splits the groups of equal ``rank`` among ``which`` by ``key``; ranks are places of a group's first member."""
    order = np.lexsort((key, rank[which]))
    r, k = rank[which][order], key[order]
    first = np.concatenate([[True], r[1:] != r[:-1]])
    new = first | np.concatenate([[True], k[1:] != k[:-1]])
    place = np.arange(len(r))
    start = np.maximum.accumulate(np.where(first, place, 0))
    head = np.maximum.accumulate(np.where(new, place, 0))
    rank[which[order]] = r + (head - start)
    return bool((new & ~first).any())


def _ties(rank: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)


def common_prefix(text: np.ndarray, room: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix of the suffixes a and b within their pieces, at most ``DEPTH`` + 1."""
    out = np.minimum(np.minimum(room[a], room[b]), int(_TOP)).astype(np.int64)
    live = np.flatnonzero(out > 0)
    for k in range(0, int(_TOP), 4):
        if not len(live):
            break
        for j in range(k, min(k + 4, int(_TOP))):
            live = live[out[live] > j]
            differ = text[a[live] + j] != text[b[live] + j]
            out[live[differ]] = j
            live = live[~differ]
    return out.astype(np.uint8)


def _sorted_turns(text: np.ndarray, rising: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """The turning positions in order of their suffixes: names of substrings, then recursive merging."""
    m = len(turns)
    is_end = text[turns] == 0
    length = np.where(is_end, 1, np.append(np.diff(turns), 0) + 1)
    symbols = text.astype(np.uint64) * 2 + rising
    padded = np.concatenate([symbols, np.zeros(8, np.uint64)])

    def column(which, at):                            # six symbols from ``at`` on, none past the substring
        key = np.zeros(len(which), np.uint64)
        start, left = turns[which] + at, length[which] - at
        for j in range(6):
            inside = left > j
            key = (key << np.uint64(10)) | np.where(inside, padded[np.minimum(start + j, len(padded) - 1)], 0).astype(np.uint64)
        return key

    rank = np.zeros(m, np.int64)
    every = np.arange(m)
    _refine(rank, every, column(every, 0))
    at = 6
    longest = int(length.max())
    while at < longest:
        which = _ties(rank)
        most = np.zeros(m, np.int64)
        np.maximum.at(most, rank[which], length[which])
        which = which[most[rank[which]] > at]
        if not len(which):
            break
        _refine(rank, which, column(which, at))
        at += 6
    ends = np.flatnonzero(is_end)                     # a name's successors stop at the end of its piece
    stop = ends[np.searchsorted(ends, every)]
    step = 1
    while step <= DEPTH // 2 + 1:                     # names span two symbols at least
        which = _ties(rank)
        which = which[~is_end[which]]
        if not len(which) or not _refine(rank, which, rank[np.minimum(which + step, stop[which])]):
            break
        step *= 2
    return np.argsort(rank, kind="stable")


def _push(queues: DiskQueues, text, wanted, position, common, carry):
    """Puts the predecessors of the scanned suffixes that have the wanted type into their queues."""
    before = position - 1
    ok = np.flatnonzero((position > 0) & wanted[before])
    target = text[before[ok]]
    order = np.argsort(target, kind="stable")
    ok, target = ok[order], target[order]
    cut = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(ok) else []
    lowest = common.min()
    untouched = np.ones(SYMBOLS, bool)
    for s, e in zip(cut, [*cut[1:], len(ok)]):
        q, at = int(target[s]), ok[s:e]
        starts = np.concatenate([[0], at + 1])
        tail = starts[-1] < len(common)
        least = np.minimum.reduceat(common, starts if tail else starts[:-1])
        value = least[: len(at)].copy()
        value[0] = min(value[0], carry[q])
        queues.put(q, before[at], np.minimum(value, _TOP - 1) + np.uint8(1))
        carry[q] = least[-1] if tail else 255
        untouched[q] = False
    carry[untouched] = np.minimum(carry[untouched], lowest)


def sort_suffixes(text: np.ndarray, queue_bytes: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(positions, common): all suffixes from the largest to the smallest, and the common prefix of each
    with the one before it, exact up to ``DEPTH``. ``text`` begins and ends with 0."""
    n = len(text)
    change = np.diff(text.astype(np.int32))
    turn = np.flatnonzero(change)
    nxt = turn[np.minimum(np.searchsorted(turn, np.arange(n - 1)), len(turn) - 1)]
    rising = np.append(change[nxt] > 0, True)         # S type
    turns = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    end = np.flatnonzero(text == 0)
    room = (end[np.searchsorted(end, np.arange(n))] - np.arange(n)).astype(np.int32)

    order = turns[_sorted_turns(text, rising, turns)]
    shared = np.zeros(len(order), np.uint8)
    shared[1:] = common_prefix(text, room, order[:-1], order[1:])
    bound = np.searchsorted(text[order], np.arange(SYMBOLS + 1))

    def meet(a, b):
        return common_prefix(text, room, np.array([a]), np.array([b]))[0]

    falling = ~rising
    queues, large = DiskQueues(queue_bytes), DiskQueues(queue_bytes)      # large: the induced L suffixes
    for c in range(SYMBOLS):
        carry = np.zeros(SYMBOLS, np.uint8)
        last = None
        while (got := queues.take(c)) is not None:
            position, common = got
            if last is None:
                common[0] = 0
            large.put(c, position, common)
            _push(queues, text, falling, position, common, carry)
            last = int(position[-1])
        if bound[c] < bound[c + 1]:
            position, common = order[bound[c]: bound[c + 1]], shared[bound[c]: bound[c + 1]].copy()
            common[0] = 0 if last is None else meet(last, int(position[0]))
            _push(queues, text, falling, position, common, carry)
    queues.close()

    queues, out = DiskQueues(queue_bytes), []
    for c in range(SYMBOLS - 1, -1, -1):
        carry = np.zeros(SYMBOLS, np.uint8)
        last = None
        while (got := queues.take(c)) is not None:
            position, common = got
            if last is None:
                common[0] = 0
            out.append((position, common))
            _push(queues, text, rising, position, common, carry)
            last = int(position[-1])
        if (got := large.take(c)) is not None:
            position = got[0][::-1]
            common = np.concatenate([[0], got[1][1:][::-1]]).astype(np.uint8)
            if last is not None:
                common[0] = meet(last, int(position[0]))
            out.append((position, common))
            _push(queues, text, rising, position, common, carry)
    queues.close()
    large.close()
    return np.concatenate([p for p, _ in out]), np.concatenate([c for _, c in out])
