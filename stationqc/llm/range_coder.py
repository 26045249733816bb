"""An adaptive context-mixing range coder for token ids, in blocks whose lanes are coded side by side.

A block is self-contained: it starts from a blank model. Its ids are dealt over lanes, runs of equal length that share the model; step t is done for all lanes at once with
numpy. The model stands still for a round of steps, then learns from all ids of the round; rounds double.

Where the two ids before name a candidate that is worth asking for, whether the id is the candidate is one binary decision. Its probability mixes three adaptive predictions in the
logistic domain, by weights that are learnt: how often the candidate held, its share after the id before (order 1), and its share of all ids (order 0). Other ids are
coded by their share after the id before; those that are new there, by their share of all; those that are new to the block, as 16 bits. A range coder turns the
decisions into 16-bit words; carries into words already out are settled at the end. All model arithmetic is on integers, so any machine decodes what another has
coded. Encoder and decoder are the same loop, so that their models can't differ.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids in a block at most; lanes of a block at most, and ids of a lane that are worth its fixed bytes.
BLOCK = 1 << 21
LANES = 4096
LANE = 256
MOST_ID = (1 << 16) - 1

MAGIC = b"TKRC"
_HEAD = struct.Struct("<4sHIIII")  # magic, version, ids, lanes, crc32 of the ids, bytes of the index
_VERSION = 2

_LOW, _REST = 1 << 32, (1 << 32) - 1
#: Shares of ids are of 1 << _SHARE. _NEW stands for an id that is new after the one before; order 0 is the context _ALL.
_SHARE = 20
_OWN = (1 << _SHARE) - 1
_NEW = _ALL = MOST_ID + 1
_SYMBOL = 17
_SLOTS, _HASH = 16, 19

_grid = np.arange(4096)
#: ln(p / (1 - p)) in 1/256 of 12-bit probabilities, its inverse, and log2 in 1/1024; rounded to integers when made, from the same formula everywhere.
STRETCH = np.rint(np.clip(np.log((_grid + 0.5) / (4095.5 - _grid)) * 256, -2047, 2047)).astype(np.int64)
SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-(_grid - 2048) / 256))), 32, 4064).astype(np.int64)
LOG = np.rint(np.log2(np.maximum(np.arange(4097), 0.5) / 4096) * 1024).astype(np.int64)


class _Model:
    """What a block's ids so far say about the next one. Tables are read between `learn`s only."""

    def __init__(self) -> None:
        # Pairs of an id and the one before it, in order, and their numbers; numbers of all ids.
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.all = np.zeros(MOST_ID + 1, np.int64)
        # Of every context: its number among those met (-1: none), and the place of its _NEW. Of every place: context and id, the shares below it in all contexts, its own share.
        self.number, self.new = np.full(_ALL + 1, -1, np.int64), np.zeros(0, np.int64)
        self.places, self.below, self.share = (np.zeros(0, np.int64) for _ in range(3))
        # Two ways to a place: by a hash of context and id, and by the first bits of what lies below (how many places begin before the next of these stretches).
        self.hashed, self.until, self.stretch = np.zeros(1 << _HASH, np.int32), np.zeros(0, np.int32), 0
        # Of every slot of two ids before: these, the candidate, how often it was asked for and right, the probability to code with (0: not asked).
        self.tag, self.candidate = np.full(1 << _SLOTS, -1, np.int64), np.zeros(1 << _SLOTS, np.int64)
        self.asked, self.right, self.chance = (np.zeros(1 << _SLOTS, np.int64) for _ in range(3))
        self.weights = [50_000, 15_000, 0]

    @staticmethod
    def slot(before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (last * 40_503 + before * 60_493 >> 3) & (1 << _SLOTS) - 1

    def place(self, context: np.ndarray | int, symbol: np.ndarray) -> np.ndarray:
        """The places of ids in contexts that have been met: those of _NEW for new ones."""
        wanted = (context << _SYMBOL) | symbol
        found = self.hashed[self._hash(wanted)].astype(np.int64)
        other = np.flatnonzero(self.places[found] != wanted)
        if len(other):
            wanted = wanted[other]
            place = self.places.searchsorted(wanted)
            found[other] = np.where(self.places[place] == wanted, place, self.new[self.number[wanted >> _SYMBOL]])
        return found

    @staticmethod
    def _hash(key: np.ndarray) -> np.ndarray:
        return (key ^ key >> _SYMBOL - 3) * 40_503 >> 4 & (1 << _HASH) - 1

    def place_of(self, below: np.ndarray) -> np.ndarray:
        """The places whose shares cover what is below in all contexts."""
        stretch = below >> self.stretch
        found, first = self.until[stretch + 1] - 1, self.until[stretch] - 1
        several = np.flatnonzero(found != first)
        if len(several):
            found[several] = self.below.searchsorted(below[several], "right") - 1
        return found

    def learn(self, before: np.ndarray, last: np.ndarray, x: np.ndarray) -> None:
        self.all += np.bincount(x, minlength=MOST_ID + 1)
        new, times = np.unique(last << _SYMBOL | x, return_counts=True)
        at = self.pairs.searchsorted(new)
        known = np.zeros(len(new), bool)
        known[at < len(self.pairs)] = self.pairs[at[at < len(self.pairs)]] == new[at < len(self.pairs)]
        self.times[at[known]] += times[known]
        self.pairs, self.times = np.insert(self.pairs, at[~known], new[~known]), np.insert(self.times, at[~known], times[~known])
        self._shares()
        self._candidates(before, last, x)

    def _shares(self) -> None:
        ids = np.flatnonzero(self.all)
        keys, times = np.concatenate([self.pairs, _ALL << _SYMBOL | ids]), np.concatenate([self.times, self.all[ids]])
        contexts, firsts, kinds = np.unique(keys >> _SYMBOL, return_index=True, return_counts=True)
        totals = np.add.reduceat(times, firsts)
        number = np.repeat(np.arange(len(contexts)), kinds)
        # An id that was met n of N times has about (2 n - 1) / 2 N; what is left is for new ones.
        share = np.maximum((2 * times - 1) * np.repeat((1 << _SHARE) - kinds - 1, kinds) // (2 * totals[number]), 1)
        self.number[contexts] = np.arange(len(contexts))
        self.new = firsts + kinds + np.arange(len(contexts))
        at = np.arange(len(keys)) + number
        self.places, self.share = (np.empty(len(keys) + len(contexts), np.int64) for _ in range(2))
        self.places[at], self.places[self.new] = keys, contexts << _SYMBOL | _NEW
        self.share[at], self.share[self.new] = share, (1 << _SHARE) - np.add.reduceat(share, firsts)
        self.below = self.share.cumsum() - self.share
        self.hashed[self._hash(self.places)] = np.arange(len(self.places))
        self.stretch = max(_SHARE - 8, _SHARE + len(contexts).bit_length() - 20)
        self.until = np.zeros((len(contexts) << _SHARE >> self.stretch) + 1, np.int32)
        np.cumsum(np.bincount(self.below >> self.stretch, minlength=len(self.until) - 1), out=self.until[1:])

    def _candidates(self, before: np.ndarray, last: np.ndarray, x: np.ndarray) -> None:
        size = 1 << _SLOTS
        slot, tag = self.slot(before, last), before << 16 | last
        weak = 2 * self.right <= self.asked
        at = np.flatnonzero(weak[slot])
        self.asked[weak] = self.right[weak] = 0
        self.tag[slot[at]], self.candidate[slot[at]] = tag[at], x[at]
        own = slot[self.tag[slot] == tag]
        hit = slot[(self.tag[slot] == tag) & (self.candidate[slot] == x)]
        asked, right = np.bincount(own, minlength=size), np.bincount(hit, minlength=size)
        # The occurrence that a slot has its candidate from is not counted.
        fresh = weak & (asked > 0)
        asked[fresh] -= 1
        right[fresh] -= 1
        self.asked += asked
        self.right += right
        k = np.flatnonzero(self.asked > 1)
        self.chance[:] = 0
        if not len(k):
            return
        candidate, context = self.candidate[k], self.tag[k] & MOST_ID
        order1 = np.clip(self.share[self.place(context, candidate)] >> _SHARE - 12, 1, 4095)
        order0 = np.clip(self.share[self.place(_ALL, candidate)] >> _SHARE - 12, 1, 4095)
        inputs = [STRETCH[p] for p in ((2 * self.right[k] + 1) * 4096 // (2 * self.asked[k] + 3), order1, order0)]
        n = int(asked[k].sum())
        for last_time in (False, False, True):
            chance = SQUASH[np.clip((sum(w * s for w, s in zip(self.weights, inputs, strict=True)) >> 16) + 2048, 0, 4095)]
            if not last_time and n:
                error = (right[k] << 12) - asked[k] * chance
                self.weights = [w + int((error * s).sum()) // (32 * n) for w, s in zip(self.weights, inputs, strict=True)]
        worth = chance * (LOG[chance] - LOG[order1]) + (4096 - chance) * LOG[4096 - chance] > 0
        self.chance[k] = np.where(worth, chance, 0)


def _run(lanes: int, steps: int, ids: np.ndarray | None, words: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes ids (steps x lanes) to words (a row for each of a lane's) and their number per lane, or decodes words to ids."""
    decode = ids is None
    low, span = np.zeros(lanes, np.int64), np.full(lanes, (1 << 48) - 1, np.int64)
    code, at = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    if decode:
        ids = np.zeros((steps, lanes), np.int32)
        for k in range(3):
            code = code << 16 | words[k]
        at += 3
    else:
        # Cells are wider than the words, for their carries; five words are the most that an id can take.
        words = np.zeros((5 * steps + 8, lanes), np.uint32)

    def narrow(k: np.ndarray, part: np.ndarray, below: np.ndarray | int, own: np.ndarray | int) -> None:
        """Lanes k take the share `own` above `below` of their span; part: the span of one count."""
        if decode:
            code[k] -= part * below
        else:
            low[k] += part * below
        spans = part * own
        span[k] = spans
        ready = k[spans < _LOW]
        while len(ready):
            if decode:
                code[ready] = code[ready] << 16 | words[at[ready], ready]
            else:
                lows = low[ready]
                words[at[ready], ready] = lows >> 32
                low[ready] = (lows & _REST) << 16
            at[ready] += 1
            spans = span[ready] << 16
            span[ready] = spans
            ready = ready[spans < _LOW]

    def count(k: np.ndarray, part: np.ndarray, bits: int) -> np.ndarray:
        """What lanes k of a decoder have next, in parts of their span."""
        return np.minimum((code[k].view(np.uint64) // part.view(np.uint64)).view(np.int64), (1 << bits) - 1)

    def shared(k: np.ndarray, context: np.ndarray | int) -> np.ndarray:
        """Codes the ids of lanes k by their shares in contexts; gives those that are new there."""
        part = span[k] >> _SHARE
        if decode:
            place = model.place_of((model.number[context] << _SHARE) | count(k, part, _SHARE))
        else:
            place = model.place(context, x[k])
        narrow(k, part, model.below[place] & _OWN, model.share[place])
        symbol = model.places[place] & (1 << _SYMBOL) - 1
        if decode:
            x[k] = symbol
        return k[symbol == _NEW]

    model, every = _Model(), np.arange(lanes)
    last, before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    history = np.zeros((2, lanes), np.int64)  # the two ids before a round
    learnt, until = 0, 1
    for step in range(steps):
        if step == until:
            seen = np.concatenate([history, ids[learnt:step].astype(np.int64)])
            model.learn(seen[:-2].ravel(), seen[1:-1].ravel(), seen[2:].ravel())
            history, learnt, until = seen[-2:], step, 2 * step
        x = np.zeros(lanes, np.int64) if decode else ids[step].astype(np.int64)
        slot = model.slot(before, last)
        chance = model.chance[slot]
        k = np.flatnonzero(chance)
        k = k[model.tag[slot[k]] == (before[k] << 16 | last[k])]
        left = every
        if len(k):
            p, guess, part = chance[k], model.candidate[slot[k]], span[k] >> 12
            hit = count(k, part, 12) < p if decode else x[k] == guess
            narrow(k, part, np.where(hit, 0, p), np.where(hit, p, 4096 - p))
            if decode:
                x[k] = guess
            done = np.zeros(lanes, bool)
            done[k[hit]] = True
            left = np.flatnonzero(~done)
        context = last[left]
        met = model.number[context] >= 0
        new = left[~met]
        if met.any():
            new = np.concatenate([new, shared(left[met], context[met])])
        if len(new) and step:
            new = shared(new, _ALL)
        if len(new):
            part = span[new] >> 16
            if decode:
                x[new] = count(new, part, 16)
            narrow(new, part, x[new], 1)
        if decode:
            ids[step] = x
        before, last = last, x
    if decode:
        return ids, at
    for _ in range(3):
        words[at, every] = low >> 32
        low = (low & _REST) << 16
        at += 1
    for k in range(int(at.max(initial=0)) - 1, 0, -1):
        words[k - 1] += words[k] >> 16
    return (words[: int(at.max(initial=0))] & 0xFFFF).astype(np.uint16), at


def _shape(n: int) -> tuple[int, int]:
    """Lanes, and ids in each but the last ones, which are filled with zeros."""
    steps = -(-n // min(LANES, max(n // LANE, 1)))
    return -(-n // max(steps, 1)), steps


def encode(blocks: list[np.ndarray], indexes: list[bytes]) -> list[bytes]:
    """Each block of ids, with bytes of the caller's in front, as bytes."""
    if max((int(b.max(initial=0)) for b in blocks), default=0) > MOST_ID:
        raise ValueError(f"ids above {MOST_ID} can't be coded")
    out = []
    for block, index in zip(blocks, indexes, strict=True):
        lanes, steps = _shape(len(block))
        grid = np.zeros(lanes * steps, np.int32)
        grid[: len(block)] = block
        words, used = _run(lanes, steps, np.ascontiguousarray(grid.reshape(lanes, steps).T), None)
        head = _HEAD.pack(MAGIC, _VERSION, len(block), lanes, zlib.crc32(block.astype("<u4").tobytes()), len(index))
        ours = np.arange(len(words))[None, :] < used[:, None]
        out.append(head + index + used.astype("<u2").tobytes() + words.T[ours].astype("<u2").tobytes())
    return out


def decode(blocks: list[bytes]) -> list[tuple[np.ndarray, bytes]]:
    """Ids and the caller's bytes of each block; raises where a checksum doesn't hold."""
    found: list[tuple[np.ndarray, bytes]] = []
    for block in blocks:
        magic, version, n, lanes, crc, size = _HEAD.unpack_from(block)
        if (magic, version) != (MAGIC, _VERSION):
            raise ValueError("not a block of this format")
        start = _HEAD.size + size
        used = np.frombuffer(block, "<u2", lanes, start).astype(np.int64)
        words = np.zeros((lanes, int(used.max(initial=0)) + 8), np.int64)
        ours = np.arange(words.shape[1])[None, :] < used[:, None]
        coded = np.frombuffer(block, "<u2", offset=start + 2 * lanes)
        if (lanes, len(coded)) != (_shape(n)[0], int(used.sum())):
            raise ValueError("a block's length doesn't hold")
        words[ours] = coded
        try:
            ids, _ = _run(lanes, _shape(n)[1], None, np.ascontiguousarray(words.T))
        except IndexError:  # beyond the words, or no such place
            raise ValueError("a block's words don't hold") from None
        own = ids.T.ravel()[:n]
        if zlib.crc32(own.astype("<u4").tobytes()) != crc:
            raise ValueError("a block's checksum doesn't hold")
        found.append((own, block[_HEAD.size : start]))
    return found
