"""Blocks of token ids: whole round trips on odd ids, documents longer than a block, and what coding costs."""

import time

import numpy as np
import pytest

from stationqc.llm import range_coder, token_files


def _prose(n, seed=3):
    """Ids that follow each other like text: some 3,000 of them, each with few likely successors, and passages that repeat."""
    rng = np.random.default_rng(seed)
    after = rng.integers(0, 3000, (3000, 32))
    ids = np.zeros(n, np.int64)
    for at, (kind, pick) in enumerate(zip(rng.random(n), rng.zipf(1.5, n), strict=True)):
        ids[at] = ids[at - 700] if kind < 0.2 and at > 700 else after[ids[at - 1], min(pick, 32) - 1]
    return ids


@pytest.mark.parametrize(
    "ids",
    [
        np.arange(1 << 16),
        np.random.default_rng(1).permutation(1 << 16),
        np.full(5000, 65_535),
        np.tile([7, 65_535, 0, 7, 9], 2000),
        np.tile([0, 0, 0, 1], 3001),
        np.repeat(np.arange(600), 9),
        _prose(40_000),
        *[np.arange(n) % 5 for n in (0, 1, 2, 255, 256, 257, 511, 512, 513, 4097)],
    ],
    ids=lambda ids: str(len(ids)),
)
def test_blocks_come_back(ids):
    coded = range_coder.encode([ids], [b"index"])
    ((found, index),) = range_coder.decode(coded)
    assert found.tolist() == ids.tolist() and index == b"index"
    assert len(coded[0]) < 3 * len(ids) + 100


def test_broken_blocks_are_refused():
    (coded,) = range_coder.encode([_prose(3000)], [b""])
    for at in range(4, len(coded), 97):
        broken = bytearray(coded)
        broken[at] ^= 0x55
        with pytest.raises(ValueError):
            range_coder.decode([bytes(broken)])
    with pytest.raises(ValueError):
        range_coder.decode([coded[:-2]])


def test_documents_longer_than_a_block_are_cut(monkeypatch):
    monkeypatch.setattr(range_coder, "BLOCK", 1000)
    ids, lengths = _prose(8000), [10, 3500, 1, 999, 1000, 1001, 400, 700]
    stream, blocks, at = token_files._Stream(), [], 0
    for n in lengths:
        stream.add(n, ids[at : at + n])
        at += n
        if stream.full():
            blocks += stream.coded()
    blocks += stream.coded()
    found = {}
    for _, n, cut, data in blocks:
        ((own, index),) = range_coder.decode([data])
        rows, end = token_files._rows(index), 0
        assert len(own) == n <= 1000 and (not cut or len(rows) == 1)
        for row in rows:
            assert row[4] == lengths[row[0]]
            found.setdefault(int(row[3]), []).extend(own[end : end + row[6]].tolist())
            end += row[6]
    starts = np.cumsum([0, *lengths])
    assert found == {int(s): ids[s : s + n].tolist() for s, n in zip(starts, lengths, strict=False)}


def test_coding_costs_little_per_id():
    n = 600_000
    ids = np.tile(_prose(100_000), 6)
    stream = token_files._Stream()
    for at in range(0, n, 500):
        stream.add(at, ids[at : at + 500])
    begun = time.process_time()
    data = [block[3] for block in stream.coded()]
    assert sum(len(own) for own, _ in range_coder.decode(data)) == n
    coding = time.process_time() - begun
    begun = time.process_time()
    sum(range(n))
    # In times of the plainest loop, so that slow machines pass too: a model for each lane took some 390, one for all lanes takes some 50.
    assert coding < 150 * (time.process_time() - begun)
