"""Byte-pair encoding compiled to a deterministic transducer over bytes.

The last token of the encoding of a prefix is the one token x ending there for
which (last token before x, x) survives encoding side by side; so a state holds,
for each suffix of the prefix that begins some token, what may follow it and
the relative token count before it. A transition is annotated with the change
of the token count and the token that now ends. States are built when first met
and kept in a hash table per worker (emptied when full); texts run through it in
lockstep, one lane a pre-token.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import regex

MAX_STATES = 100_000
#: Characters that run through the lanes at a time.
LANES = 1 << 18
_FEW = 48
_MEMO = 100_000
_MIX, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: letter -> byte. Printable Latin-1 bytes stand for
    themselves, the others, in order, for code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def character_classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space for every code point."""
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    out = np.zeros(0x110000, np.uint8)
    for k, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            out[a:b + 1] = k
    out[0xD800:0xE000] = 0
    out[0x1C:0x20] = 0
    return out


class Transducer:
    """``ids``: token (bytes) -> id; ``rank``: (left, right) -> rank of the merge,
    in order of rank."""

    def __init__(self, ids: dict[bytes, int], rank: dict[tuple[bytes, bytes], int], max_states: int = MAX_STATES):
        self.id_of, self.rank, self.max_states = ids, rank, max_states
        self.tokens = {t for t in ids if len(t) == 1 or self._merged(t) == [t]}
        self._classify()
        self.reset()

    def _classify(self) -> None:
        """Spines of all tokens, and ``alike``: token -> one token of its class.

        Right spine: a token, its right part, that one's right part, ..., each
        with the rank of the merge that consumes it; left spine likewise. Two
        tokens survive side by side unless a merge joins their spines before
        both its parts are consumed. What a token lets follow thus depends only
        on the merges its right spine could enter in time."""
        made: dict[bytes, tuple[int, bytes, bytes]] = {}
        starts: dict[bytes, list[int]] = {}
        for (a, b), r in self.rank.items():  # in order of rank
            made.setdefault(a + b, (r, a, b))
            starts.setdefault(a, []).append(r)
        of: dict[tuple, bytes] = {}
        self.right, self.left, self.alike = {}, {}, {}
        for t in sorted(self.tokens):
            for spine, side in ((self.right, 2), (self.left, 1)):
                part, before, own = t, 1 << 30, []
                while True:
                    own.append((part, before))
                    if part not in made:
                        break
                    before, part = made[part][0], made[part][side]
                spine[t] = own
            sign = tuple((p, n) for p, k in self.right[t] if (n := bisect_left(starts.get(p, ()), k)))
            self.right[t] = [(p, k) for p, k in self.right[t] if p in starts]
            self.alike[t] = of.setdefault(sign, t)
        few: dict[bytes, list[bytes] | None] = {}
        for t in sorted(self.tokens):
            for k in range(1, len(t)):
                own = few.setdefault(t[:k], [])
                if own is not None:
                    own.append(t)
                    if len(own) > _FEW:
                        few[t[:k]] = None
        self.longer = few

    def reset(self) -> None:
        self.keys = [((b"", None, 0),)]
        self.number = {self.keys[0]: 0}
        self.fitting: dict[tuple, object] = {}
        self._resize(1 << 16)
        self.moves = np.zeros((4, 4096), np.int32)  # of each: next state, change, id and size of the token
        self.n_moves = 0

    def make_room(self) -> None:
        """Empty the table when it has grown past its bound."""
        if len(self.keys) > self.max_states:
            self.reset()

    def _merged(self, data: bytes) -> list[bytes]:
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _fits(self, before: bytes | None, x: bytes) -> bool:
        """Does (before, x) survive encoding? Of equal ranks the left merge goes first."""
        if before is None:
            return True
        rank = self.rank
        for r, consumed in self.right[before]:
            for part, taken in self.left[x]:
                m = rank.get((r, part))
                if m is not None and m < consumed and m <= taken:
                    return False
        return True

    def step(self, key: tuple, byte: bytes) -> tuple[tuple, int, bytes]:
        """The next state's key, the change of the token count, the last token.

        A key lists (suffix, what may follow, count before it minus the count
        now), longest suffix first. What may follow is the class of the last
        token before the suffix or, once few tokens begin with the suffix, those
        of them that fit; a suffix that none fits is dropped."""
        for suffix, who, count in key:
            x = suffix + byte
            if x in who if isinstance(who, tuple) else x in self.tokens and self._fits(who, x):
                now = count + 1
                break
        else:
            raise ValueError(f"no token ends at {byte!r}")
        grown = []
        for s, who, c in key:
            s += byte
            if isinstance(who, tuple):
                who = tuple(y for y in who if len(y) > len(s) and y.startswith(s))
            else:
                fit = self.fitting.get((who, s))
                if fit is None:
                    if len(self.fitting) > _MEMO:
                        self.fitting.clear()
                    more = self.longer.get(s, ())
                    fit = who if more is None else tuple(y for y in more if self._fits(who, y))
                    self.fitting[who, s] = fit
                who = fit
            if who != ():
                grown.append((s, who, c - now))
        return (*grown, (b"", self.alike[x], 0)), now, x

    def state(self, key: tuple) -> int:
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.keys)
            self.keys.append(key)
        return n

    def _resize(self, slots: int, known: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        """An empty open-addressing table (state * 256 + byte -> transition)."""
        self.slot_shift = 64 - (slots.bit_length() - 1)
        self.slot_key = np.full(slots, -1, np.int64)
        self.slot_move = np.full(slots, -1, np.int32)
        if known is not None:
            for cell, move in zip(*(x.tolist() for x in known)):
                self._put(cell, move)

    def _put(self, cell: int, move: int) -> None:
        at = (cell * _MIX & _ALL) >> self.slot_shift
        while self.slot_key[at] != -1:
            at = (at + 1) % len(self.slot_key)
        self.slot_key[at], self.slot_move[at] = cell, move

    def _moves_of(self, cell: np.ndarray) -> np.ndarray:
        """The transition of each cell, -1 where it is not built yet."""
        at = (cell.astype(np.uint64) * np.uint64(_MIX) >> np.uint64(self.slot_shift)).astype(np.int64)
        key, out = self.slot_key[at], self.slot_move[at]
        left = np.flatnonzero((key != cell) & (key != -1))
        while len(left):
            at[left] = (at[left] + 1) % len(self.slot_key)
            key = self.slot_key[at[left]]
            out[left] = self.slot_move[at[left]]
            left = left[(key != cell[left]) & (key != -1)]
        return out

    def _build(self, cell: int) -> None:
        key, change, token = self.step(self.keys[cell >> 8], bytes([cell & 255]))
        k = self.n_moves
        if k == self.moves.shape[1]:
            self.moves = np.concatenate([self.moves, np.zeros_like(self.moves)], axis=1)
        to = self.state(key)
        self.moves[:, k] = to, change, self.id_of[token], len(token)
        self.n_moves = k + 1
        if 4 * self.n_moves > len(self.slot_key):
            full = self.slot_key != -1
            self._resize(2 * len(self.slot_key), (self.slot_key[full], self.slot_move[full]))
        self._put(cell, k)

    def run(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, entry: np.ndarray | None = None,
            trace: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and count changes of the lanes data[start:start+size].
        ``trace`` gets the transition taken at each byte."""
        order = np.argsort(-sizes, kind="stable")
        at, size = starts[order], sizes[order]
        state = np.zeros(len(at), np.int64) if entry is None else entry[order].astype(np.int64)
        count = np.zeros(len(at), np.int64)
        active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for t, n in enumerate(active):
            place = at[:n] + t
            cell = state[:n] * 256 + data[place]
            move = self._moves_of(cell)
            if move.min() < 0:
                for c in np.unique(cell[move < 0]).tolist():
                    self._build(c)
                move = self._moves_of(cell)
            if trace is not None:
                trace[place] = move
            state[:n] = self.moves[0][move]
            count[:n] += self.moves[1][move]
        out_s, out_c = np.empty_like(state), np.empty_like(count)
        out_s[order], out_c[order] = state, count
        return out_s, out_c

    def encode(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last byte, id) of every token of the lanes, in order of place: the
        tokens are read off backwards from the end of each lane."""
        trace = np.zeros(len(data), np.int32)
        self.run(data, starts, sizes, trace=trace)
        ends = np.zeros(len(data), bool)
        some = sizes > 0
        first, last = starts[some], (starts + sizes)[some] - 1
        while len(last):
            ends[last] = True
            last = last - self.moves[3][trace[last]]
            go = last >= first
            first, last = first[go], last[go]
        place = np.flatnonzero(ends)
        return place, self.moves[2][trace[place]]


def contractions(cp: np.ndarray, begins: np.ndarray, end: np.ndarray) -> None:
    """Mark in ``begins`` that 's 't 'm 'd 're 've 'll at the beginning of a
    pre-token are pre-tokens; ``end``: last characters of their texts."""
    quotes = np.flatnonzero((cp == 39) & begins & ~end)
    if len(quotes):
        pad = np.concatenate([cp, [0, 0, 0]])
        ends = np.concatenate([end, [True, True, True]])
        a, b = pad[quotes + 1], np.where(ends[quotes + 1], 0, pad[quotes + 2])
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        begins[quotes[one | two] + 1] = False
        after = np.concatenate([quotes[one] + 2, quotes[two] + 3])
        begins[after[after < len(cp)]] = True


def utf8_widths(cp: np.ndarray) -> np.ndarray:
    return 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
