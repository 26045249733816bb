"""Token ids of texts by a byte-level BPE of the tokenizers library, inside tasks.

Such a tokenizer never merges across a single space between two other characters, nor across a single newline between two
others, so a text's ids are those of its space-led pieces in a row. Pieces repeat much more than texts: a task keeps a bounded table
of the pieces it has met, and only new ones go through the library. Strings of the tokenizer's added tokens (`<|endoftext|>`) come first, as in the library:
each is its token's id, and the text is cut there.
"""

from __future__ import annotations

import ctypes
import os
import re
import sys
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "byte_bpe_50k.json"
#: Pieces that a task remembers (some 250 bytes each); a full table is begun anew.
REMEMBERED = 400_000
#: Characters of text that are worked on at a time, and so the bound of a worker's memory beside a single long text.
CHARS_AT_A_TIME = 2_000_000

_BETWEEN = re.compile(r"(?<=\S)(?= \S)")
#: Punctuation that is an id sequence of its own behind a letter.
_BEHIND = "!#$%&()*+,-./:;<=>?@[]^_`{|}~"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class Encoder:
    """Ids as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str):
        if sys.byteorder != "little":
            raise ValueError("ids are kept in the machine's byte order, which has to be little-endian")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: (i, t) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for _, t in added.values()):
            raise ValueError("added tokens that depend on what is around them are not supported")
        self.added = {content: array("I", [i]).tobytes() for content, (i, _) in added.items()}
        self.cuts = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.known: dict[object, bytes | None] = {}
        self.ends: dict[str, bytes] = {}

    def _learn(self, missing: set) -> None:
        letters, behind, others = set(), [], []
        for p in missing:
            if type(p) is tuple:  # the first piece of a text, or one that is not split at spaces: as it is
                others.append((p, p[0]))
                continue
            core = p.rstrip(_BEHIND)
            if core.isalpha():
                if core not in self.known:
                    letters.add(core)
                if core != p:
                    behind.append((p, core, p[len(core) :]))
            elif not p or p[-1].isspace() or (p[1] if p[0] == "\n" else p[0]).isspace():
                self.known[p] = None  # white space at a bound: its text is split in the other way
            else:
                others.append((p, p if p[0] == "\n" else " " + p))
        letters = list(letters)
        if letters:
            found = self.tokenizer.encode(" " + " ".join(letters), add_special_tokens=False)
            starts = np.flatnonzero(np.diff(np.array(found.word_ids, np.int64), prepend=-1)).tolist()
            if len(starts) == len(letters):
                ids = array("I", found.ids).tobytes()
                for p, start, stop in zip(letters, starts, [*starts[1:], len(ids) // 4], strict=True):
                    self.known[p] = ids[4 * start : 4 * stop]
            else:
                others += [(p, " " + p) for p in letters]
        ends = list({x for _, _, x in behind}.difference(self.ends))
        for texts, keys, table in (([t for _, t in others], [p for p, _ in others], self.known), (ends, ends, self.ends)):
            for p, found in zip(keys, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                table[p] = array("I", found.ids).tobytes()
        for p, core, end in behind:
            self.known[p] = self.known[core] + self.ends[end]

    def _all(self, pieces: list) -> list[bytes | None]:
        new = set(pieces).difference(self.known)
        if new:
            if len(self.known) + 2 * len(new) > REMEMBERED:
                self.forget()
                new = set(pieces)
            self._learn(new)
        return list(map(self.known.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        if not self.cuts.search(text):
            return self._encode(text)
        found, done = [], 0
        for cut in self.cuts.finditer(text):
            found += [self._encode(text[done : cut.start()]), self.added[cut[0]]]
            done = cut.end()
        return b"".join([*found, self._encode(text[done:])])

    def forget(self) -> None:
        self.known.clear(), self.ends.clear()

    def _encode(self, text: str) -> bytes:
        if not text:
            return b""
        pieces = text.replace("\n", " \n").split(" ")
        first = pieces[0]
        if first and not first[0].isspace() and not first[-1].isspace():
            pieces[0] = (first,)
            found = self._all(pieces)
            if None not in found:
                return b"".join(found)
        return b"".join(self._all([(p,) for p in _BETWEEN.split(text)]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for the file; the tokenizer is kept between tasks."""
    path = path or default_path()
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


@contextmanager
def task_encoder(path: str | None = None) -> Iterator[Encoder]:
    """The worker's encoder for the length of a task: what it remembers goes with the task's end."""
    give_back()
    found = encoder(path)
    try:
        yield found
    finally:
        found.forget()
        give_back()


def give_back() -> None:
    """Memory that this worker has freed, in this task or those before it, goes back to the system: workers of an executor share its limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about CHARS_AT_A_TIME bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHARS_AT_A_TIME)))
        yield batch.slice(start, stop - start)
        start = stop
