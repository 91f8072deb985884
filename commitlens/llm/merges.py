"""Pair merging of many words at once, in rounds over flat arrays of symbols."""

from __future__ import annotations

import heapq

import numpy as np

_NONE = np.int32(np.iinfo(np.int32).max)
# Rounds after which a word that is still not done is finished merge by merge.
_ROUNDS = 2_000


class Merges:
    """Which pairs of symbols merge, into what, and in which order of rank (lower goes first).

    Symbols are numbers from 0; -1 is a symbol that merges with nothing. Pairs of equal rank go
    from left to right, as in the two usual libraries.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, result: np.ndarray):
        self._size = int(max(left.max(initial=0), right.max(initial=0), result.max(initial=0))) + 1
        keys = left.astype(np.int64) * self._size + right
        order = np.argsort(keys, kind="stable")
        keys, rank, result = keys[order], rank[order].astype(np.int32), result[order].astype(np.int32)
        # An open table: a key lies within `_probes` places of where it is hashed to.
        self._bits = max(4, int(len(keys) * 4).bit_length())
        self._table = np.full((1 << self._bits) + 64, -1, np.int64)
        self._rank = np.full(len(self._table), _NONE, np.int32)
        self._result = np.full(len(self._table), -1, np.int32)
        self._probes = 1
        left_over = np.arange(len(keys))
        at = self._hash(keys)
        while len(left_over):
            places = at[left_over]
            free = self._table[places] == -1
            _, first = np.unique(places, return_index=True)
            wins = np.zeros(len(places), bool)
            wins[first] = True
            wins &= free
            chosen = left_over[wins]
            self._table[at[chosen]], self._rank[at[chosen]], self._result[at[chosen]] = keys[chosen], rank[chosen], result[chosen]
            left_over = left_over[~wins]
            at[left_over] += 1
            if len(left_over):
                self._probes += 1
                if self._probes > 64:
                    raise ValueError("too many pairs for the table")

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; no merge has the highest rank and result -1."""
        keys = left.astype(np.int64) * self._size + right
        keys[(left < 0) | (right < 0)] = -2
        home = self._hash(keys)
        place = np.full(len(keys), len(self._table) - 1, np.int64)
        open_ = np.arange(len(keys))
        for step in range(self._probes):
            there = self._table[home[open_] + step]
            hit = there == keys[open_]
            place[open_[hit]] = home[open_[hit]] + step
            open_ = open_[~hit & (there != -1)]
            if not len(open_):
                break
        # The last place is never hashed to, so it stands for no merge.
        return self._rank[place], self._result[place]

    def run(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every word to the end: its final symbols, and which first symbol each one starts at.

        ``symbols`` are those of all words, ``offsets`` where words start. In a round every unfinished word merges all places of
        its lowest-ranked pair, leftmost first where they overlap, and the arrays are compacted;
        words without a pair leave. Where a merge makes a pair of the same or a lower rank with a
        neighbour, that pair's turn is next, so the word's merges stop there for the round.
        """
        out = np.full(len(symbols), -2, np.int64)
        sym = symbols.astype(np.int32)
        start = np.arange(len(sym))
        word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        rank, result = self._pairs(sym, word)
        for _ in range(_ROUNDS):
            if not len(sym):
                break
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(sym)]))
            done = lowest == _NONE
            if done.any():
                out[start[done]] = sym[done]
                kept = ~done
                sym, start, word, rank, result, lowest = (a[kept] for a in (sym, start, word, rank, result, lowest))
                if not len(sym):
                    break
            at = np.flatnonzero(rank == lowest)
            # Every second one of places that overlap.
            first = np.r_[True, np.diff(at) != 1]
            run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            at = self._before_trouble(at, sym, word, lowest, result)
            sym[at] = result[at]
            kept = np.ones(len(sym), bool)
            kept[at + 1] = False
            moved = at - np.arange(len(at))
            sym, start, word, rank, result = (a[kept] for a in (sym, start, word, rank, result))
            near = np.zeros(len(sym), bool)
            near[moved] = True
            near[moved[moved > 0] - 1] = True
            touched = np.flatnonzero(near)
            rank[touched], result[touched] = self._look_at(touched, sym, word)
        if len(sym):
            self._one_by_one(sym, start, word, out)
        first_symbol = np.flatnonzero(out != -2)
        return out[first_symbol], first_symbol

    def _look_at(self, at: np.ndarray, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        following = np.minimum(at + 1, len(sym) - 1)
        inside = (following > at) & (word[following] == word[at])
        return self.look(sym[at], np.where(inside, sym[following], -1))

    def _pairs(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._look_at(np.arange(len(sym)), sym, word)

    def _before_trouble(self, at, sym, word, lowest, result) -> np.ndarray:
        """The chosen places of each word up to the first that makes a pair not above the round's rank."""
        made, here = result[at], word[at]
        # The symbol before, as it is after the merges to the left; the symbol behind, not yet merged.
        before = np.maximum(at - 1, 0)
        left = np.where((at > 0) & (word[before] == here), sym[before], -1)
        touching = np.flatnonzero((np.diff(at) == 2) & (here[1:] == here[:-1])) + 1
        left[touching] = made[touching - 1]
        behind = np.minimum(at + 2, len(sym) - 1)
        right = np.where((behind > at + 1) & (word[behind] == here), sym[behind], -1)
        trouble = np.minimum(self.look(left, made)[0], self.look(made, right)[0]) <= lowest[at]
        if not trouble.any():
            return at
        heads = np.flatnonzero(np.r_[True, here[1:] != here[:-1]])
        seen = np.cumsum(trouble) - trouble
        return at[seen == np.repeat(seen[heads], np.diff(np.r_[heads, len(at)]))]

    def _one_by_one(self, sym, start, word, out) -> None:
        """The same merges from a heap, for very long words whose every merge is the next one's cause."""
        for w in np.unique(word).tolist():
            mine = np.flatnonzero(word == w)
            s, n = sym[mine].tolist(), len(mine)
            before, behind = list(range(-1, n - 1)), [*range(1, n), -1]
            known: dict = {}

            def pair(a: int, b: int) -> tuple[int, int]:
                if (a, b) not in known:  # noqa: B023
                    r, m = self.look(np.array([a]), np.array([b]))
                    known[a, b] = (int(r[0]), int(m[0]))  # noqa: B023
                return known[a, b]  # noqa: B023

            heap = [(pair(s[i], s[i + 1])[0], i, s[i], s[i + 1]) for i in range(n - 1)]
            heap = [h for h in heap if h[0] != _NONE]
            heapq.heapify(heap)
            alive = [True] * n
            while heap:
                _, i, a, b = heapq.heappop(heap)
                j = behind[i]
                if not alive[i] or j < 0 or s[i] != a or s[j] != b:
                    continue
                s[i], alive[j], behind[i] = pair(a, b)[1], False, behind[j]
                if behind[j] >= 0:
                    before[behind[j]] = i
                for x, y in ((before[i], i), (i, behind[i])):
                    if x >= 0 and y >= 0 and (r := pair(s[x], s[y])[0]) != _NONE:
                        heapq.heappush(heap, (r, x, s[x], s[y]))
            left = [i for i in range(n) if alive[i]]
            out[start[mine][left]] = [s[i] for i in left]
